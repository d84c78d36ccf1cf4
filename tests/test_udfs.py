"""Functions in Python beside their plans."""

import re
import tracemalloc
from unicodedata import normalize

import pandas as pd

from tarnwheel.functions import udfs


def test_unaccented_holds_no_second_form_of_a_batch(monkeypatch):
    monkeypatch.setattr(udfs.F, "pandas_udf", lambda kind: lambda f: f)  # the function itself, on a Series
    odd = ["", "Ångström, naïve, ﬁ", "ȩ́", "한국어 が", "̈́", "\U0001f600 ñ", None]
    assert udfs.unaccented(pd.Series(odd)).tolist()[:-1] == [normalize("NFC", re.sub("[̀-ͯ]", "", normalize("NFD", x))) for x in odd[:-1]]
    assert pd.isna(udfs.unaccented(pd.Series(odd)).iloc[-1]) and not len(udfs.unaccented(pd.Series([], dtype=object)))
    texts = pd.Series(["é" + "a" * 4000] * 2000)  # 8 MB come out
    tracemalloc.start()
    try:
        found = udfs.unaccented(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == 2000 and peak < 12e6
