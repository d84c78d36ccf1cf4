"""MinHash classes against all pairs."""

import random
import re

import pytest

from tarnwheel.operators import minhash
from tarnwheel.session import Held

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sets(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def all_pairs(rows):
    """(pairs of ids at 0.8 or more among different sets, class of each row by the least id)."""
    found = [(k, sets(t)) for k, t in rows]
    root = list(range(len(found)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, (_, s) in enumerate(found):
        for x in s:
            where.setdefault(x, []).append(i)
    near, pairs = {}, set()
    for i, (_, s) in enumerate(found):
        near.clear()
        for x in s:
            for j in where[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, n in near.items():
            if 100 * n >= 80 * (len(s) + len(found[j][1]) - n):
                if s != found[j][1]:
                    pairs.add((i, j))
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return pairs, [top(i) for i in range(len(found))]


def corpus(seed=2, n=60, copies=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(800)]
    texts = [None, "", " \n", "one", "One", "two words", "a b c d e"]
    for _ in range(n):
        base = rng.choices(vocabulary, k=rng.randint(20, 300))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            less = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                less[rng.randrange(len(less))] = rng.choice(vocabulary)
            texts.append("\t".join(less))
    hot = rng.choices(vocabulary, k=150)
    for k in range(copies):  # a large group of near copies
        texts.append(" ".join(hot[:k] + ["zz"] + hot[k + 1 :]))
    return texts + [texts[8]] * 30


def judged(spark, rows, **options):
    """(recall of pairs, recall of classes' rows); classes are checked to be parts of the true ones."""
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, row int")
    got = {}
    for r in minhash.near_duplicates(docs, **options).collect():
        got.setdefault(r.doc_id, []).append((r.class_id, r.n_class, r.n_links))
    pairs, true = all_pairs(rows)
    ids = [k for k, _ in rows]
    for i, k in enumerate(ids):
        assert got[k][0][0] in {ids[j] for j in range(len(ids)) if true[j] == true[i]}
    sizes = {}
    for k in ids:
        sizes[got[k][0][0]] = sizes.get(got[k][0][0], 0) + 1
    assert all(x[1] == sizes[x[0]] for v in got.values() for x in v) and sum(map(len, got.values())) == len(rows)
    together = sum(got[ids[i]][0][0] == got[ids[j]][0][0] for i, j in pairs)
    return together / max(1, len(pairs)), got


@pytest.mark.parametrize("small", [minhash.SMALL, 2])
def test_recall_and_classes(spark, small):
    texts = corpus()
    recall, got = judged(spark, list(enumerate(texts)), small=small)
    print(f"recall with buckets of {small}: {recall:.4f}")
    assert recall >= 0.98
    assert got[0] == [(0, 1, 0)] and got[3][0][0] == got[4][0][0] == 3


def test_a_large_cluster_gives_candidates_in_proportion(spark):
    def n(copies):
        rows = [(k, t) for k, t in enumerate(corpus(5, 1, copies)) if k > 11]
        df = spark.createDataFrame(rows, "id long, text string").withColumn("found", minhash.shingles("text"))
        nodes = df.selectExpr("md5(cast(found as string)) node", "found").dropDuplicates(["node"]).select("node", minhash.signature(df.found).alias("signature"))
        return minhash.candidates(nodes, Held(spark)).count()

    few, many = n(150), n(600)
    assert many < 8 * few  # sixteen times, if all pairs were


def test_given_table(spark):
    import duckdb

    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    recall, _ = judged(spark, rows)
    print(f"recall on sf0.001: {recall:.4f}")
    assert recall >= 0.9


def test_empty_null_ids_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f g"), (7, "A b c d e f g"), (3, "x"), (3, "x"), (None, None)]
    got = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(None, 7, 2, 0), (7, 7, 2, 0), (3, 3, 2, 0), (3, 3, 2, 0), (None, None, 1, 0)], key=repr)
