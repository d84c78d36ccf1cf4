"""Languages: held-out accuracy, and the scores against a plain version."""

import math
from collections import Counter

import pytest

from tarnwheel.functions import language as g


def plain_scores(texts, lines):
    """log probabilities by dictionaries."""
    counts = {}
    for name, text in texts:
        mine = counts.setdefault(name, Counter())
        for _, x in g.paragraphs(text):
            x = " " + x
            for k in range(len(x)):
                mine.update(x[max(0, k - n + 1) : k + 1] for n in range(1, 5) if k - n + 1 >= 0)
    out = []
    for _, x in lines:
        x = " " + x
        row = []
        for name in sorted(counts):
            mine, total = counts[name], 0.0
            singles = sum(n for gram, n in counts[name].items() if len(gram) == 1)
            for k in range(len(x)):
                p = math.log(g.FLOOR)
                for n in range(4, 0, -1):
                    gram = x[max(0, k - n + 1) : k + 1]
                    before = mine[gram[:-1]] if len(gram) > 1 else singles
                    if mine[gram] and before:
                        p = math.log(min(1, mine[gram] / before)) + (4 - n) * math.log(g.BACK_OFF)
                        break
                total += p
            row.append(total)
        out.append(row)
    return out


TEXTS = [("en", "The cat sat on the mat\nand the dog"), ("de", "Die Katze saß auf der Matte\n\n und der Hund"), ("en", None), ("fr", "le chat\tet le chien 12"), (None, "zzz"), ("de", "12 !\n")]


def test_scores_match_a_plain_version(spark):
    docs = spark.createDataFrame([(k, *x) for k, x in enumerate(TEXTS)], "doc_id int, lang string, text string")
    model = g.fit(docs)
    assert model.languages == ("de", "en", "fr")
    lines = g.paragraphs("Der Hund und the dog\n\n42\nle chien ☃𝔘𝔘 zqz\nx")
    assert [k for k, _ in lines] == [0, 3, 4]
    want = plain_scores([x for x in TEXTS if x[0]], lines)
    got = g.score(model, [x for _, x in lines])
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b, rel=1e-4)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(g, "AT_ONCE", 10)
    schema = "doc_id int, lang string, text string, found string, n long"
    docs = spark.createDataFrame([(k, *x, "f", 1) for k, x in enumerate(TEXTS)], schema)
    model = g.fit(docs)
    got = {r.doc_id: r for r in g.languages(docs, model, ["doc_id", "lang"]).collect()}
    assert [got[k].found for k in range(6)][:4] == ["en", "de", None, "fr"] and got[5].found is None
    assert [p.line for p in got[1].paragraphs] == [0, 2] and got[2].n_paragraphs == 0
    assert g.languages(docs.limit(0), model, ["doc_id"]).collect() == []
    none = g.fit(docs.where("lang is null"))
    assert {r.found for r in g.languages(docs, none, ["doc_id"]).collect()} == {None}


def test_held_out_accuracy(spark):
    from tarnwheel.plans import catalog

    rows = catalog.QUERIES["q_language_checks"](spark, "/root/testdata/sf0.01")
    from pyspark.sql import functions as F

    held = rows.where((F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1) & F.col("found").isNotNull())
    table = held.groupBy("lang", "found").count().collect()
    right, every = sum(r["count"] for r in table if r.lang == r.found), sum(r["count"] for r in table)
    print(f"held-out accuracy {right / every:.4f} of {every}:", sorted(map(tuple, table)))
    assert right / every > 0.95
    assert all(r.n_other == len(r.other_lines) <= r.n_paragraphs for r in rows.collect())
