import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tarnwheel.llm import suffixtree as s

from .common import documents, empty, odd_texts, prose, words


def plain(texts):
    """Every window by itself; a row for each text, in order."""
    n = Counter()
    listed = [words(t) for t in texts]
    for w in listed:
        n.update(tuple(w[k : k + 35]) for k in range(len(w) - 34))
    out = []
    for w in listed:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 34):
            if n[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def found(df, **options):
    rows = s.dedup(df, **options).collect()
    return sorted(((r.doc_id, r.n_words, sum(x.stop - x.start for x in r.spans), hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows), key=repr)


def checked(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(k, *x) for (k, _), x in zip(rows, plain([t for _, t in rows]), strict=True)]
    assert found(docs, **options) == sorted(want, key=repr)
    return want


def mixed_texts(seed=12):
    rng = random.Random(seed)
    passage, other = prose(rng, 50), prose(rng, 36)
    texts = odd_texts() + ["ab " * 400, "b " + "ab " * 34, "x " * 35, "y " + "x " * 34, other, other.replace(" ", "\n\t "), "a b " * 100, prose(rng, 20) + " " + passage + " " + passage]
    for _ in range(30):
        some = rng.choice([passage, other, " ".join(passage.split()[: rng.randint(33, 40)]), " ".join(passage.split()[rng.randint(10, 17) :])])
        texts.append(prose(rng, rng.randint(1, 30)) + " " + some + "\n" + prose(rng, rng.randint(1, 30)))
    return texts


def test_matches_every_window_compared(spark):
    want = checked(documents(spark, mixed_texts()))
    assert sum(0 < x[2] < x[1] for x in want) > 20


@pytest.mark.parametrize("hot", [1, 4])
def test_hot_grams_take_the_longest_prefix(spark, hot):
    checked(documents(spark, mixed_texts(3)), hot=hot)


def test_groups_that_span_batches_and_tiny_groups(spark, monkeypatch):
    monkeypatch.setattr(s, "TOGETHER", 2)
    texts = mixed_texts(5)
    names = np.arange(len(texts))
    anchored = list(s._anchored([pa.RecordBatch.from_arrays([pa.array(names[a : a + 3]), pa.array([t or "" for t in texts[a : a + 3]])], ["row", "text"]) for a in range(0, len(texts), 3)]))
    rows = pa.Table.from_batches(anchored).sort_by("key").combine_chunks()
    for size in (1, 7, len(rows)):
        stay = pa.Table.from_batches(list(s._stay(rows.to_batches(max_chunksize=size))))
        n = Counter(rows.column("h").to_pylist())
        assert sorted(stay.column("h").to_pylist()) == sorted(h for h in rows.column("h").to_pylist() if n[h] > 1)
        most = Counter()
        for h, x in zip(stay.column("h").to_pylist(), stay.column("n").to_pylist(), strict=True):
            most[h] = max(most[h], x)
        assert all(most[h] == n[h] for h in most)  # the last row of a gram knows how often it is


def test_every_window_has_one_anchor_wherever_it_stands():
    rng = random.Random(8)
    passage = prose(rng, 35).split()
    places = set()
    for k in range(12):
        text = prose(rng, 40 + k).split() + passage + prose(rng, 40).split()
        data = np.frombuffer(" ".join(text).encode(), np.uint8)
        block = s.Block(data, np.array([0, len(data)]))
        starts, ends, firsts = block.words()
        start, off, n, h = s.anchors(block.hashes(starts, ends), s.owners(firsts))
        assert n.sum() == len(text) - 34 and n.max() <= 18 and off.max() <= 17
        mine = int(np.flatnonzero((start <= 40 + k) & (40 + k < start + n))[0])
        places.add((int(start[mine] + off[mine]) - 40 - k, int(h[mine])))
    assert len(places) == 1


@pytest.mark.parametrize("size", [200, 3000])
def test_pieces_hold_each_window_once(size):
    rng = random.Random(1)
    text = prose(rng, 3000) + " " + "z" * 5000 + "\n\n" + prose(rng, 100)
    data = np.frombuffer(text.encode(), np.uint8)
    got = Counter()
    for base, piece in s.pieces(data, size):
        w = words(piece.tobytes().decode())
        got.update((base + k, tuple(w[k : k + 35])) for k in range(len(w) - 34))
    w = words(text)
    assert got == Counter((k, tuple(w[k : k + 35])) for k in range(len(w) - 34))


def test_a_text_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 2000)
    rng = random.Random(6)
    part = prose(rng, 400)
    long = prose(rng, 2000) + " " + part + " " + prose(rng, 1500)
    names = pa.array([5, 6])
    rows = pa.Table.from_batches(list(s._anchored([pa.RecordBatch.from_arrays([names, pa.array([long, part])], ["row", "text"])])))
    at = np.array(rows.column("at"))
    n = {r: int((at[np.array(rows.column("row")) == r] & 255).sum()) for r in (5, 6)}
    assert n == {5: len(long.split()) - 34, 6: 400 - 34}


def test_empty_null_ids_and_repeated_rows(spark):
    assert s.dedup(empty(spark)).collect() == []
    text = prose(random.Random(2), 60)
    docs = spark.createDataFrame([(None, text), ("1", text), ("1", text), ("2", "a " + text), (None, "b c"), ("3", None)], "doc_id string, text string")
    checked(docs)


def test_query_and_its_twin(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    got = s.op11_substring_dedup(spark, "/root/testdata/sf0.01")
    want = con.sql(s.ORACLE_OP11)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want.fetchall())
    texts = con.sql("select text from documents order by doc_id").fetchall()
    assert [r[1:] for r in rows] == plain([t for (t,) in texts])
