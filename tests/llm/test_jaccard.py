import random
import re

import duckdb
import numpy as np
import pytest

from tarnwheel.llm import jaccard as j
from tarnwheel.llm.components import components
from tarnwheel.operators.components import _star
from tarnwheel.session import Held

from .common import LOWER, documents, empty, prose, words

SF = "/root/testdata/sf0.001"


def sets(text, k):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def plain(rows, k, percent):
    """All pairs."""
    found = [sets(t, k) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = found[a], found[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    ids = {}
    for (i, _), g in zip(rows, group, strict=True):
        ids.setdefault(g, []).append(i)
    return sorted((i, len(s), min((x for x in ids[g] if x is not None), default=None) if s else i) for (i, _), s, g in zip(rows, found, group, strict=True))


def near_texts(seed=4):
    """Clusters of copies with some words changed, small sets, chains of neighbours."""
    rng = random.Random(seed)
    out = []
    for size in (9, 12, 30, 120, 400):
        base = prose(rng, size).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, size // 40))):
                copy[rng.randrange(size)] = prose(rng, 1)
            out.append(" ".join(copy) if rng.random() < 0.8 else " ".join(copy).upper().replace("É", "é"))
    long = prose(rng, 150).split()
    out += [" ".join(long[4 * k : 4 * k + 100]) for k in range(10)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (3, 50)])
def test_matches_all_pairs(spark, k, percent):
    docs = documents(spark, near_texts() + [None, "", "a b", "a b", "A  B", "one", *near_texts(5)[:10]])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in j.self_join(docs, shingle=k, percent=percent).collect())
    assert got == plain(rows, k, percent)
    assert len({c for _, _, c in got}) < len(got)


def test_small_groups_and_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = documents(spark, near_texts(7))
    want = sorted(j.self_join(docs).collect())
    for name, value in (("GROUP", 2), ("MOST_ROWS", 0), ("MOST_TOKENS", 0)):
        monkeypatch.setattr(j, name, value)
    assert sorted(j.self_join(docs).collect()) == want


def test_frequent_tokens_are_counted(spark):
    texts = ["the very same words " + prose(random.Random(k), 30) for k in range(40)]
    keys, counts = j.hot_tokens(documents(spark, texts).repartition(9), "text", 3)
    assert len(keys) and counts.max() == 41 and (np.diff(keys.astype(float)) > 0).all()


def test_one_of_each(spark):
    docs = documents(spark, near_texts())
    kept, groups = j.one_of_each(docs), j.self_join(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in groups.collect()}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(150)] + [(k, k + 1) for k in range(1000, 1300)]
    group = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == g for x, g in group.items())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_cost_few_tables_and_exchanges(spark):
    """The driver plans each round anew: stars need none, and a round has a plan of its few shuffles."""
    held = Held(spark)
    stars = spark.createDataFrame([(k, -(k // 50) - 1) for k in range(1, 500)], "a long, b long")
    assert components(stars, held).count() == 499 and len(held.tables) == 1
    held.release()
    path = held(spark.createDataFrame([(k + 1, k) for k in range(60)], "a long, b long"), "links")
    assert {tuple(r) for r in components(path, held).collect()} == {(k + 1, 0) for k in range(60)}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _star(_star(path, True), False).distinct()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(re.findall(r"\bExchange\b", plan)) <= 8
    held.release()


def test_empty_and_null_ids(spark):
    assert j.self_join(empty(spark)).collect() == []
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "x"), (7, "a b c d e"), (None, None)], "doc_id long, text string")
    assert sorted(j.self_join(docs).collect(), key=repr) == sorted([(7, 1, 7), (None, 1, 7), (None, 1, None), (None, 0, None)], key=repr)


def test_oracle(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF}/documents.parquet'")
    want = sorted(duckdb.sql(j.ORACLE_OP8).fetchall())
    assert sorted(tuple(r) for r in j.op8_jaccard_join(spark, SF).collect()) == want


def test_one_row_of_each_component_whatever_the_ids(spark):
    rng = random.Random(12)
    a, b, c, d, e, clean = (prose(rng, 100) for _ in range(6))
    near = a.rsplit(" ", 1)[0] + " zz"
    rows = [(7, a), (7, a), (7, near), (3, near)]  # a repeated row, a shared id, a near copy with a lower one
    rows += [(9, clean), (9, near)]  # a clean text that shares its id with a near copy
    rows += [(None, b), (None, b), (None, b), (None, c), (5, c)]  # null ids alone, and beside another
    rows += [(4, d), (4, d), (1, e), (2, None), (2, None), (6, ""), (6, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.text) for r in j.one_of_each(docs).collect()), key=repr)
    assert got == sorted([(3, near), (9, clean), (None, b), (5, c), (4, d), (1, e), (2, None), (2, None), (6, ""), (6, "")], key=repr)
    assert j.one_of_each(docs).columns == docs.columns


def test_what_is_sent_grows_with_a_cluster_of_near_copies(spark, monkeypatch):
    """A cluster over many parts: sets are sent a few times each, not once for each part."""
    monkeypatch.setattr(j, "GROUP", 32)
    sent, plain_links = [], j._links

    def counted(texts, base, roles, *rest):
        sent[-1] += roles.count()
        return plain_links(texts, base, roles, *rest)

    monkeypatch.setattr(j, "_links", counted)
    base = prose(random.Random(21), 300).split()
    for n in (160, 640):
        texts = [" ".join([*base[: k % 290], f"w{k}", *base[k % 290 + 1 :]]) for k in range(n)]
        sent.append(0)
        got = j.self_join(documents(spark, texts)).collect()
        assert {r.component_id for r in got} == {0}
    assert sent[1] <= 5 * sent[0] and sent[1] <= 4 * 640


def test_long_sets_make_parts_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(j, "TOKENS", 500)
    docs = documents(spark, near_texts(8))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in j.self_join(docs).collect()) == plain(rows, 5, 80)


def test_null_and_equal_ids_are_not_multiplied(spark):
    rows = [(None, prose(random.Random(k), 40)) for k in range(60)] + [(None, prose(random.Random(0), 40) + " zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.component_id is None for r in j.self_join(docs).collect())
    assert j.one_of_each(docs).count() == 60


def test_prefixes_are_shuffled_once_for_each_use(spark, monkeypatch):
    plans, plain_held = {}, j.Held.__call__

    def seen(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain_held(self, df, name)

    monkeypatch.setattr(j.Held, "__call__", seen)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        monkeypatch.setattr(j, "MOST_TOKENS", 0)
        docs = documents(spark, near_texts(9))
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert sorted(tuple(r) for r in j.self_join(docs).collect()) == plain(rows, 5, 80)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plans["asked"].count("- Exchange hashpartitioning(token") == 1 and "shared-tokens" not in plans
    assert plans["open-groups"].count("- Exchange hashpartitioning(token") == 1 and "ReusedExchange" in plans["open-groups"]


def test_links_come_out_as_stars():
    assert sorted(j.forest(np.array([5, 3, 8, 7]), np.array([9, 5, 7, 8]))) == [(5, 3), (8, 7), (9, 3)]
