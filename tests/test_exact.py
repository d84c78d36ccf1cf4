"""Classes of equal texts, with digests that collide."""

import pytest
from pyspark.sql import functions as F

from tarnwheel.operators.exact import exact_classes

ROWS = [(5, "a"), (3, "a"), (None, "a"), (4, "b"), (9, None), (8, ""), (7, "c" * 100_000), (7, "c" * 100_000), (6, "d"), (None, "e"), (None, "e")]


@pytest.mark.parametrize("digest", [None, lambda: F.lit(1).cast("long"), lambda: F.length("text").cast("long")])
def test_classes(spark, digest):
    digest = digest and digest()
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, digest string, n int")
    got = sorted(map(tuple, exact_classes(df, digest=digest).collect()), key=repr)
    want = [(5, 3, 3), (3, 3, 3), (None, 3, 3), (4, 4, 1), (9, 8, 2), (8, 8, 2), (7, 7, 2), (7, 7, 2), (6, 6, 1), (None, None, 2), (None, None, 2)]
    assert got == sorted(want, key=repr)
    assert exact_classes(df.limit(0), digest=digest).collect() == []
