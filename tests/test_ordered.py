"""Two-pass windows and as-of joins against plain loops, and how evenly their rows are dealt."""

import random

import pytest
from pyspark.sql import functions as F

from tarnwheel.operators import ordered
from tarnwheel.session import Held


def test_running_numbers_and_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(20)]), k, rng.choice([None, rng.randint(-5, 5)]), "x") for k in range(500)]
    df = spark.createDataFrame(rows, "t int, id int, v long, row_number string").drop("row_number")
    got = {r.id: (r.n, r.total) for r in ordered.running(df, ["t", "id"], {"total": "v"}, "n", 7).collect()}
    total = None
    for n, (_, k, v, _) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), 1):
        total = total if v is None else v + (total or 0)
        assert got[k] == (n, total)
    assert len(got) == 500
    assert ordered.running(df.limit(0), ["t", "id"], {"total": "v"}).collect() == []


def test_no_window_over_everything(spark):
    df = spark.range(1000).selectExpr("id % 7 t", "id")
    plan = ordered.running(df, ["t", "id"], {"s": "id"}, parts=5)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def asof(left, right):
    out = {}
    for k, t, i in left:
        best = max(((u, v) for h, u, v in right if k is not None and t is not None and h == k and u is not None and u <= t), default=(None, None))
        out[i] = best
    return out


@pytest.mark.parametrize(("keys", "parts"), [(1, 6), (3, 9), (40, 4)])
def test_asof_join(spark, keys, parts):
    rng = random.Random(keys)
    key = lambda: None if rng.random() < 0.05 else rng.randrange(keys)
    time = lambda: None if rng.random() < 0.05 else rng.randrange(300)
    left = [(key(), time(), k) for k in range(400)]
    right = [(key(), time(), k) for k in range(150)]
    a = spark.createDataFrame(left, "k int, t int, id int")
    b = spark.createDataFrame(right, "k int, t int, v int")
    got = {r.id: (r.asof_t, r.asof_v) for r in ordered.asof_join(a, b, ["k"], "t", ["t", "v"], parts=parts).collect()}
    assert got == asof(left, right)
    assert len(ordered.asof_join(a, b.limit(0), ["k"], "t", ["t", "v"]).collect()) == 400
    assert ordered.asof_join(a.limit(0), b, ["k"], "t", ["t", "v"]).collect() == []


def test_one_key_with_all_rows_is_dealt_evenly(spark):
    rows = spark.range(20_000).selectExpr("1 k", "id t", "id")
    sizes = sorted(r["count"] for r in ordered.ranged(rows, ["k", "t"], Held(spark), 8).groupBy(ordered.RANGE).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[4]
    found = ordered.asof_join(rows, rows.where("t % 100 = 0"), ["k"], "t", ["id"], parts=8)
    assert found.where(F.col("asof_id") != F.col("id") - F.col("id") % 100).count() == 0 and found.count() == 20_000


def test_ranks_of_large_groups_are_many_tasks(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(k, rng.choice(["a"] * 8 + ["b", None]), rng.choice([None, 1.0, 2.5, float("nan"), -3.0]), rng.choice(["x", "y", "z", None])) for k in range(700)] + [(701, "one", 1.0, "x"), (702, "two", None, None), (703, "two", 2.0, "y")]
    df = spark.createDataFrame(rows, "k int, g string, p double, q string").repartition(5)
    monkeypatch.setattr(ordered, "ROWS", 16)
    window = "select k, row_number() over w rn, rank() over p rk, dense_rank() over p dr, ntile(4) over w nt, cume_dist() over p cd, percent_rank() over p pr from t window w as (partition by g order by p nulls last, k), p as (partition by g order by q nulls last)"
    df.createOrReplaceTempView("t")
    want = sorted(tuple(r) for r in spark.sql(window).collect())
    got = ordered.ranks(df, ["g"], ["p", "k"], ["q"], 4)
    assert sorted(tuple(r) for r in got.select("k", "rn", "rk", "dr", "nt", "cd", "pr").collect()) == want
    files = [f for f in got.inputFiles() if "/ranks-" in f]
    assert len(files) >= 40 and max(spark.read.parquet(f).count() for f in files) < 100
    assert ordered.ranks(df.where("false"), ["g"], ["p", "k"], ["q"], 4).collect() == []
