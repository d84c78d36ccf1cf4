import itertools
import random
from collections import Counter

import pytest

from tarnwheel.llm import filteraudit as f

from .common import prose, words


def plain(rows, labels):
    """Each order run over the rows, one filter after the other."""
    least = {}
    for key, text, _ in rows:
        key = (key is not None, key)
        least[text or ""] = min(least.get(text or "", key), key)

    def fails(row, name):
        key, text, _ = row
        text = text or ""
        w = words(text)
        return {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": (key is not None, key) != least[text],
        }[name]

    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    out, shapley = {}, {}
    for part in {p or "" for *_, p in rows}:
        mine = [r for r in rows if (r[2] or "") == part]
        failing = [{n for n in "ABCDE" if fails(r, n)} for r in mine]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(range(len(mine)))
            for step, name in enumerate(order, 1):
                gone = [k for k in left if name in failing[k]]
                redundant = sum(name in x for x in failing) - len(gone)
                left = [k for k in left if name not in failing[k]]
                alone = sum(x == {name} for x in failing)
                lost = [sum(mine[k][0] in some for k in gone) for some in (good, toxic)]
                out[part, order, step] = (len(left), len(gone), redundant, alone, *lost)
                shapley[part, name] = shapley.get((part, name), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def odd(seed=5):
    rng = random.Random(seed)
    long = prose(rng, 250)
    texts = [None, "", " \n", "AB CD", "a" * 300, long, long, long.upper(), long + " #", "spam ham " * 200, "spam ham " * 200, "ß ß " * 220, prose(rng, 30_000), "x & y", "x & y"]
    rows = [(k, t, (None, "", "en", "de")[k % 4]) for k, t in enumerate(texts)]
    rows += [rows[5], (3, "AB CD", "en"), (None, "AB CD", "en"), (None, long, None), (2, "", "fr")]
    labels = [(k, k % 2, k % 3 % 2) for k in range(12)] + [(1, 0, 1), (1, None, None), (None, 1, 1), (99, 1, 1)]
    return rows, labels


def tables(spark, rows, labels, id_type="long"):
    docs = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], f"doc_id {id_type}, text string, lang string, part string, mask int, id int")
    return docs, spark.createDataFrame([(*x, "q") for x in labels], f"doc_id {id_type}, quality int, toxic int, good string")


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def test_matches_each_order_run_by_itself(spark):
    rows, labels = odd()
    assert found(f.audit(*tables(spark, rows, labels))) == plain(rows, labels)


def test_chains_of_one_row_a_task_and_texts_sent_on_early(spark, monkeypatch):
    rows, labels = odd()
    docs, told = tables(spark, rows, labels)
    assert found(f.audit(docs.repartition(len(rows)), told)) == plain(rows, labels)
    # chains that hold nothing send each row on by itself
    monkeypatch.setattr(f, "HELD", -1)
    sent = list(f._local([(k, "", t or "", 7) for k, t, _ in rows]))
    assert len(sent) == len(rows)
    got = Counter()
    for x in f._routed(sent):
        got[x[2] & f.BIT["E"] > 0] += x[3]
    least = {}
    for k, t, _ in rows:
        least[t or ""] = min(least.get(t or "", (True, 10**9)), (k is not None, k or 0))
    assert got[True] == sum((k is not None, k or 0) != least[t or ""] for k, t, _ in rows)


def test_texts_that_share_a_fingerprint_stay_apart():
    chains = f.Chains()
    out = [x for key, text in ((4, "a"), (3, "b"), (2, "a"), (5, "b"), (2, "a")) for x in chains.add(1, text, key, Counter([(key, "", 0)]))]
    assert sorted(x[0][0] for x in out) == [4, 5]
    assert sorted((e[0], e[1], e[2].total()) for _, e in chains.drain()) == [("a", 2, 2), ("b", 3, 1)]


@pytest.mark.parametrize("size", [1, 7, 200])
def test_masks_in_slices(monkeypatch, size):
    texts = [t or "" for _, t, _ in odd()[0]] + ["aA " * 300, "x" * 50 + " b" * 250]
    want = [f.mask(t) for t in texts]
    monkeypatch.setattr(f, "SLICE", size)
    assert [f.mask(t) for t in texts] == want


def test_string_ids_and_empty_tables(spark):
    rows, labels = odd()
    rows = [(k if k is None else f"{k:03d}", t, p) for k, t, p in rows]
    labels = [(k if k is None else f"{k:03d}", q, t) for k, q, t in labels]
    assert found(f.audit(*tables(spark, rows, labels, "string"))) == plain(rows, labels)
    docs, told = tables(spark, rows, labels, "string")
    assert f.audit(docs.limit(0), told).collect() == []
    assert found(f.audit(docs, told.limit(0))) == plain(rows, [])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_and_its_twin(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '/root/testdata/{sf}/{t}.parquet'")
    got = f.op13_filter_audit(spark, f"/root/testdata/{sf}")
    want = con.sql(f.ORACLE_OP13)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    if sf == "sf0.001":
        rows = con.sql("select doc_id, text, lang from documents").fetchall()
        labels = con.sql("select doc_id, quality, toxic from labels").fetchall()
        assert found(got) == plain(rows, labels)
