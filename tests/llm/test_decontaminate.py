import random
from collections import Counter

import duckdb

from tarnwheel.llm import decontaminate as d

from .common import documents, empty, prose

SF = "/root/testdata/sf0.001"


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_copies_and_near_copies_are_found_and_nothing_else(spark):
    rng = random.Random(8)
    asked = [prose(rng, 60) for _ in range(5)] + ["only three words", None, "", prose(rng, 300)]
    w = asked[0].split()
    edge = " ".join(w[3:])  # 53 of 56 shingles left
    changed = " ".join(w[:30] + ["qq"] + w[31:])  # 51 of 61
    gone = " ".join(w[:15] + ["qq"] + w[16:40] + ["rr"] + w[41:])  # 46 of 66
    texts = [asked[0], prose(rng, 100) + " " + edge + " " + prose(rng, 9), changed, gone, prose(rng, 200), None, "", "x only, THREE; words y", asked[8].replace("a", "A").replace(" ", "; ") + "!", " ".join(asked[1].split()[:30])]
    found = {(r.doc_id, r.item_id): r.similarity for r in d.matches(documents(spark, texts), items(spark, asked)).collect()}
    assert set(found) == {(0, 0), (1, 0), (2, 0), (7, 5), (8, 8)}
    assert found[0, 0] == 1 and found[8, 8] == 1
    assert found[2, 0] == 51 / 61
    kept = d.clean(documents(spark, texts), items(spark, asked))
    assert kept.columns == documents(spark, texts).columns
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5, 6, 9}


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, asked = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sorted(d.matches(docs, asked).collect())
    monkeypatch.setattr(d, "MOST_ROWS", 0)
    assert sorted(d.matches(docs, asked).collect()) == want and want


def test_blocks_hold_every_fingerprint_within_the_radius(spark):
    """Flip any RADIUS bits: some block stays whole, so the index finds the pair."""
    rng = random.Random(2)
    base = [rng.getrandbits(64) - 2**63 for _ in range(20)]
    rows = []
    for k, f in enumerate(base):
        g = f & (2**64 - 1)
        for bit in rng.sample(range(64), d.RADIUS):
            g ^= 1 << bit
        rows.append((k, g - 2**64 if g >= 2**63 else g))
    a = d._blocks(spark.createDataFrame(list(enumerate(base)), "k long, fingerprint long"))
    b = d._blocks(spark.createDataFrame(rows, "k long, fingerprint long"))
    assert a.count() == 20 * (d.RADIUS + 1)
    assert a.join(b, ["k", "block", "value"]).select("k").distinct().count() == 20


def test_fingerprints_are_majorities(spark):
    df = spark.createDataFrame([(1, [5, 4, 6, -1])], "k int, hashes array<long>")
    got = d._fingerprints(df, ["k"]).first().fingerprint
    votes = Counter(bit for h in (5, 4, 6, -1) for bit in range(64) if h >> bit & 1)
    assert got == sum(1 << bit for bit, n in votes.items() if n > 2)


def test_no_python_on_the_main_path(spark, monkeypatch):
    """Neither in the result nor in any table that is written on the way."""
    plans, keep = [], d.Held.__call__

    def noted(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, name)

    monkeypatch.setattr(d.Held, "__call__", noted)
    docs, asked = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plans.append(d.matches(docs, asked)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5
    for plan in plans:
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def similarity(a, b, k=5):
    x, y = (Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for w in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def test_moved_parts_are_found(spark):
    """Halves swapped, thirds swapped, and sentences in another order."""
    rng = random.Random(31)
    w = prose(rng, 120).split()
    sentences = [w[k : k + 40] for k in (0, 40, 80)]
    moved = [w[60:] + w[:60], w[80:] + w[40:80] + w[:40], sentences[1] + sentences[2] + sentences[0], w]
    assert all(similarity(m, w) >= 0.8 for m in moved)
    texts = [" ".join(prose(rng, 30).split() + m + prose(rng, 30).split()) for m in moved]
    found = {r.doc_id: r.similarity for r in d.matches(documents(spark, texts, extra=False), items(spark, [" ".join(w)])).collect()}
    assert set(found) == {0, 1, 2, 3}
    for k, m in enumerate(moved):
        assert found[k] >= similarity(m, w) - 1e-9


def test_documents_that_begin_or_end_inside_an_item(spark):
    rng = random.Random(41)
    w = prose(rng, 100).split()
    texts = [" ".join(w[12:] + prose(rng, 50).split()), " ".join(prose(rng, 50).split() + w[:88]), " ".join(w[8:92])]
    found = {r.doc_id: (round(r.similarity, 6), r.start) for r in d.matches(documents(spark, texts, extra=False), items(spark, [" ".join(w)])).collect()}
    assert found[2][0] == round(80 / 96, 6)
    assert set(found) == {0, 1, 2} and found[0] == (round(84 / 96, 6), -12) and found[1] == (round(84 / 96, 6), 50)


def test_recall_near_the_threshold(spark):
    """Near copies whose similarity is just over 0.8: nine of ten at least are within the radius."""
    rng = random.Random(17)
    lexicon = [prose(rng, 1) + str(k % 7) for k in range(3000)]
    asked, texts = [], []
    while len(texts) < 150:
        w = [lexicon[min(2999, int(rng.paretovariate(0.6)))] for _ in range(rng.randint(40, 160))]
        copy = list(w)
        while (s := similarity(copy, w)) > 0.85:
            copy[rng.randrange(len(copy))] = rng.choice(lexicon)
        if s >= 0.8:
            asked.append(" ".join(w))
            texts.append(" ".join(rng.choices(lexicon, k=40) + copy + rng.choices(lexicon, k=40)))
    got = {(r.doc_id, r.item_id) for r in d.matches(documents(spark, texts, extra=False), items(spark, asked)).collect()}
    recall = sum((k, k) in got for k in range(150)) / 150
    print(f"recall between 0.80 and 0.85: {recall:.3f}")
    assert recall >= 0.9


def test_repetitive_items_and_texts_stay_small(spark):
    """One window for each place, whatever the number of times that a phrase is repeated on both sides."""
    item, text = "spam and eggs " * 60, "spam and eggs " * 3000
    got = d.matches(documents(spark, [text], extra=False), items(spark, [item, "spam " * 100])).collect()
    assert {r.item_id for r in got} == {0} and got[0].similarity == 1 and got[0].start == 0


def test_empty_tables(spark):
    assert d.matches(empty(spark), items(spark, ["a b c d e f"])).collect() == []
    assert d.matches(documents(spark), items(spark, [])).collect() == []
    assert d.clean(documents(spark), items(spark, [None])).count() == documents(spark).count()


def test_oracle(spark):
    for t in ("documents", "benchmark"):
        duckdb.sql(f"create or replace view {t} as select * from '{SF}/{t}.parquet'")
    want = sorted(duckdb.sql(d.ORACLE_OP3).fetchall())
    assert sorted(tuple(r) for r in d.op3_decontaminate(spark, SF).collect()) == want
