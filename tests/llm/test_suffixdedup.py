import hashlib
import random

import numpy as np
import pytest

from tarnwheel.llm import suffixdedup as s

from .common import documents, empty, odd_texts, prose


def plain(rows):
    """Every 100-byte string, in order of id."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            string = data[k : k + 100]
            if string in seen:
                gone[k : k + 100] = True
            seen.add(string)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out[doc_id, text] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df, **options):
    out = {}
    for r in s.dedup(df, **options).collect():
        removed = sum(x.stop - x.start for x in r.spans)
        out.setdefault(r.doc_id, []).append((r.n_bytes, removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()))
    return out


def checked(spark, texts, **options):
    docs = documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain(rows)
    got = found(docs, **options)
    for doc_id, text in rows:
        assert want[doc_id, text] in got[doc_id], (doc_id, (text or "")[:60])
    assert sum(map(len, got.values())) == len(rows)


def mixed_texts():
    rng = random.Random(12)
    passage, other = prose(rng, 40), "é" * 30 + prose(rng, 30)
    texts = odd_texts() + ["ab" * 400, "b" + "ab" * 300, "x" * 99, "x" * 100, "y" + "x" * 100]
    texts += [prose(rng, rng.randint(0, 30)) + rng.choice([passage, other, passage[: rng.randint(90, 130)]]) + prose(rng, rng.randint(0, 30)) for _ in range(30)]
    return [t if t is None or len(t) < 40_000 else t[:40_000] for t in texts]


def test_matches_every_string_compared(spark):
    checked(spark, mixed_texts())


def test_hot_anchors_go_the_other_way_to_the_same_end(spark):
    checked(spark, mixed_texts(), hot=2)


@pytest.mark.parametrize("together", [1, 7])
def test_small_collections(spark, monkeypatch, together):
    import pyarrow as pa

    monkeypatch.setattr(s, "TOGETHER", together)
    rng = np.random.default_rng(1)
    h = np.sort(rng.integers(0, 40, 300))
    batches = [pa.RecordBatch.from_arrays([pa.array(h[a : a + 11]), pa.array(np.arange(a, min(300, a + 11))), pa.array(np.zeros(min(11, 300 - a), np.int32)), pa.array(np.arange(a, min(300, a + 11)) % 50 == 0)], ["h", "row", "at", "again"]) for a in range(0, 300, 11)]
    for most in (1, 5, 1000):
        table = pa.Table.from_batches(list(s._repeated(iter(batches), most)))
        counts = np.bincount(h[np.arange(300) % 50 > 0], minlength=40)
        assert sorted(table.column("row").to_pylist()) == [k for k in range(300) if k % 50 == 0 or counts[h[k]] > 1]
        for x, hot, again in zip(*(table.column(k).to_pylist() for k in ("h", "hot", "again")), strict=True):
            assert hot == (not again and counts[x] > most)


def test_column_wise_order_and_common_prefixes():
    rng = np.random.default_rng(9)
    symbols = rng.integers(97, 99, (60, 40), dtype=np.uint8)
    symbols[10:20, 5:] = symbols[10, 5:]
    for column, order, common in s.column_wise(symbols):
        suffixes = [symbols[k, column:].tobytes() for k in order]
        assert suffixes == sorted(suffixes)
        for a, b, n in zip(suffixes, suffixes[1:], common[1:], strict=False):
            same = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
            assert n == min(same, s.WINDOW)


def test_anchors_are_the_same_for_equal_strings():
    from tarnwheel.llm.textarrays import Block

    rng = random.Random(3)
    string = prose(rng, 60).encode()[:100]
    relative = set()
    for k in range(20):
        data = np.frombuffer(prose(rng, k).encode() + string + prose(rng, 5).encode(), np.uint8)
        start = len(data) - len(data.tobytes().split(string)[1]) - 100
        block = Block(data, np.array([0, len(data)]))
        place, h = s.anchors(block)
        # of the grams inside the string, the least is an anchor, at the same place whatever stands around the string
        grams = block.rolling(np.arange(start, start + s.SIDE + 1), np.arange(start + s.GRAM, start + s.WINDOW + 1))
        least = int(np.argmin(grams >> np.uint64(22)))
        assert start + least in place.tolist() and h[place.tolist().index(start + least)] == grams[least]
        relative.add((least, int(grams[least])))
    assert len(relative) == 1


def test_empty_null_ids_and_repeated_rows(spark):
    assert s.dedup(empty(spark)).collect() == []
    text = prose(random.Random(2), 60)
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (2, "a" + text), (None, text)], "doc_id long, text string")
    got = found(docs)
    assert [x[1] for x in got[None]] == [0, 0]  # first in order, and no copies of each other
    assert all(x[1] == len(text.encode()) for x in got[1]) and got[2][0][1] == len(text.encode())


def test_query(spark):
    import duckdb

    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    want = {k[0]: v for k, v in plain(rows).items()}
    got = {r.doc_id: tuple(r)[1:] for r in s.op6_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
