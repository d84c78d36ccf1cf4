import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwheel.llm import spelling as s
from tarnwheel.session import Held

from .common import LOWER, documents, empty, odd_texts


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    forms, out = {}, {}
    for w, k in words.items():
        some = [x for x in words if near(w, x)]
        best = min(some, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * k else None
        out[w] = (k, len(some))
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, *out[w], words.get(forms[w]))
    return out


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def misspelt(seed=4, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéß×÷", k=rng.randint(4, 9))) for _ in range(8)] + ["street", "streets", "Straße", "über" * 40, "x" * 300]

    def edit(w):
        k = rng.randrange(len(w) + 1)
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abzé") + w[k:], w[:k] + rng.choice("abzé") + w[k + 1 :]])

    texts = []
    for _ in range(n):
        some = [rng.choice(base) for _ in range(40)]
        some = [edit(w) if rng.random() < 0.3 else w for w in some]
        texts.append("".join(w.upper() if rng.random() < 0.1 and "ß" not in w else w + rng.choice([" ", ", ", "-", "\n", "日"]) for w in some))
    return texts


@pytest.mark.parametrize("most", [s.PAIRS, 4])
def test_matches_all_pairs(spark, most):
    docs = documents(spark, odd_texts() + misspelt(n=200) + ["chainaa " * 4 + "chainab " * 10 + "chaincb " * 30])
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(x[0] is not None for x in want.values()) > 50
    assert any(x[0] is not None and x[0] != x[1] for x in want.values())  # chains
    assert found(s.variants(docs, most=most)) == want


def test_subdivided_blocks_find_every_pair_and_stay_small(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["st" + a + b + "et" for a in letters for b in letters] + ["st" + a + b + c + "et" for a in "ae" for b in letters for c in letters]
    table = spark.createDataFrame([(w, 3 + len(w)) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in s.near(table, Held(spark), most=500).collect()}
    short = {}
    for w in words:
        for k in range(len(w)):
            short.setdefault((k, w[:k] + w[k + 1 :]), []).append(w)
    want = {(a, b) for group in short.values() for a in group for b in group if a != b}
    for w in words:
        for k in range(len(w)):
            less = w[:k] + w[k + 1 :]
            if less in set(words):
                want |= {(w, less), (less, w)}
    assert got == want
    sizes = s.dictionary(table, Held(spark), 500).groupBy(*s.KEY).agg(F.count("*").alias("every"), F.count_if(F.col("length") == F.col("m")).alias("short")).collect()
    assert all(r.every * max(1, r.short) <= 500 or r.m - r.front - r.back < 2 for r in sizes)


def test_checksums_and_runs():
    import zlib

    text = "Äb1ÿ×÷zz éa-" + "é" * 80 + " ĀbĐc " + "日本"
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = s.runs(data, np.array([0, len(data)]))
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == re.findall("[A-Za-zÀ-ÿ]+", text)
    before = np.array([zlib.crc32(b"12:")] * len(starts), np.uint32)
    assert s.checksums(data, starts, ends, before).tolist() == [zlib.crc32(b"12:" + data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def test_a_long_text_in_slices():
    text = " ".join(misspelt(2, 40)) + "é" * 400 + "-x"
    data = np.frombuffer(text.encode(), np.uint8)
    for size in (7, 100, 10**6):
        whole, parts = Counter(), Counter()
        s.count(s.LOWER[data], np.array([0, len(data)]), ["4"], whole)
        pieces = list(s.slices(data, size))
        assert np.array_equal(np.concatenate(pieces), data)
        for x in pieces:
            s.count(s.LOWER[x], np.array([0, len(x)]), ["4"], parts)
        assert whole == parts and len(whole) > 20


def test_empty_null_ids_and_string_ids(spark):
    assert s.variants(empty(spark)).collect() == []
    rows = [(None if k % 7 == 0 else f"d{k}", t) for k, t in enumerate(misspelt(9, 20))]
    assert found(s.variants(spark.createDataFrame(rows, "doc_id string, text string"))) == plain(rows)


def test_query_and_its_twin(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    got = s.op12_spelling_variants(spark, "/root/testdata/sf0.01")
    want = con.sql(s.ORACLE_OP12)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want.fetchall()) and len(rows) > 100


def test_query_against_all_pairs(spark):
    import duckdb

    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert found(s.op12_spelling_variants(spark, "/root/testdata/sf0.001")) == plain(rows)
