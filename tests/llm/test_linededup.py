import random

import duckdb

from tarnwheel.llm import linededup as m

from .common import documents, empty, odd_texts, prose, words

SF = "/root/testdata/sf0.001"


def plain(rows):
    """Every run of lines, shortest that have the words."""
    docs = sorted({(r[0], r[1] or "") for r in rows})
    first, spots = {}, []
    for doc_id, text in docs:
        lines = text.split("\n")
        n = [len(words(x)) for x in lines]
        for i in range(len(lines)):
            total = 0
            for j in range(i, len(lines)):
                total += n[j]
                if total >= m.MIN_WORDS:
                    run = tuple(lines[i : j + 1])
                    spots.append((doc_id, text, i, j, run))
                    first.setdefault(run, (doc_id, i))
                    if total - n[i] >= m.MIN_WORDS and j > i + 12:
                        break
    gone = {}
    for doc_id, text, i, j, run in spots:
        if first[run] != (doc_id, i):
            gone.setdefault((doc_id, text), set()).update(range(i, j + 1))
    out = {}
    for doc_id, text in docs:
        g, lines = gone.get((doc_id, text), set()), text.split("\n")
        out[doc_id, text] = (len(lines), len(g), sum(k - 1 not in g for k in g), "\n".join(x for k, x in enumerate(lines) if k not in g))
    return out


def line_texts():
    rng = random.Random(21)
    lines = [prose(rng, rng.choice([0, 1, 3, 8, 20, 45])) for _ in range(14)]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 12))) for _ in range(25)]
    run = "\n".join(lines[:6])
    texts += [prose(rng, 5) + "\n" + run + "\n" + prose(rng, 5) for _ in range(3)] + [run, run, lines[-1], "\n\n\n"]
    return texts + [t for t in odd_texts() if len(t or "") < 20_000]


def test_matches_every_run_compared(spark):
    docs = documents(spark, line_texts())
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    rows = docs.select("doc_id", "text").collect()
    got = {}
    for r in m.dedup(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_lines, r.n_removed, r.n_runs, r.text or ""))
    for r in rows:
        assert want[r.doc_id, r.text or ""] in got[r.doc_id]
    assert sum(map(len, got.values())) == len(rows)
    assert any(x[1] for v in got.values() for x in v)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = documents(spark, line_texts())
    want = sorted(m.dedup(docs).collect(), key=repr)
    monkeypatch.setattr(m, "MOST_ROWS", 0)
    assert sorted(m.dedup(docs).collect(), key=repr) == want


def test_no_python_on_the_main_path(spark):
    plan = m.dedup(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_and_null_ids(spark):
    assert m.dedup(empty(spark)).collect() == []
    text = prose(random.Random(2), 60)
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in m.dedup(docs).collect())
    assert got == [(0, 0), (0, 0), (1, 1), (1, 1)]


def test_oracle(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF}/documents.parquet'")
    want = sorted(duckdb.sql(m.ORACLE_OP9).fetchall())
    assert sorted(tuple(r) for r in m.op9_line_dedup(spark, SF).collect()) == want


def test_many_shared_blank_lines(spark):
    blank = "\n" * 20_000 + "one two three four five six"
    docs = spark.createDataFrame([(1, "a b c d e f g\n" + blank), (2, "h\n" + blank + "\nrest"), (3, "\n" * 30_000 + "x")], "doc_id long, text string")
    got = {r.doc_id: tuple(r) for r in m.dedup(docs).collect()}
    assert got[1][2] == 0 and got[2] == (2, 20_003, 20_000 + 1, 1, "h\nrest") and got[3][2] == 0
