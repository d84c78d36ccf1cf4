"""Count-min sketches: bounds, roll-ups, values that were never there."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tarnwheel.operators import sketches


def test_estimates_hold_their_bounds_after_rolling_up(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(4), int(rng.paretovariate(0.8)) % 3000) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "day int, v int")
    by_day = sketches.count_min(df, [F.col("day")], F.col("v"), width=256, depth=5)
    whole = sketches.rolled_up(by_day.withColumn("all", F.lit(1)), ["all"])
    true = Counter(v for _, v in rows)
    asked = spark.createDataFrame([(1, v) for v in [*true, -1, -2]], "all int, v int")
    got = {r.v: r.estimate for r in sketches.estimates(whole, asked, "v", ["all"], 256, 5).collect()}
    assert all(got[v] >= true[v] for v in got)
    over = [v for v in got if got[v] - true[v] > math.e / 256 * len(rows)]
    assert len(over) <= math.exp(-5) * len(got) + 1
    direct = sketches.count_min(df.withColumn("all", F.lit(1)), [F.col("all")], F.col("v"), width=256, depth=5)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, whole.select(direct.columns).collect()))
    assert sketches.estimates(whole.limit(0), asked.limit(1), "v", ["all"], 256, 5).first().estimate == 0


def test_rows_are_dealt_by_group_and_large_groups_in_shares(spark, monkeypatch):
    monkeypatch.setattr(sketches, "ROWS", 50)
    rows = [("hot", 1)] * 900 + [("hot", k) for k in range(300)] + [(None, k % 7) for k in range(60)] + [(f"g{k % 40}", k) for k in range(1600)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(12)
    parts = sketches.dealt(df, ["g"], "v").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.countDistinct("g").alias("groups")).collect()
    assert sum(r.n for r in parts) == len(rows) and max(r.n for r in parts) < 400
    made = sketches.count_min(df, [F.col("g")], F.col("v"), 64, 3)
    told = {r.g: r.n for r in made.where("depth = 0").groupBy("g").agg(F.sum("n").alias("n")).collect()}
    assert told == dict(Counter(g for g, _ in rows))
    assert made.groupBy("g", "depth", "cell").count().where("count > 1").isEmpty()
    assert {(r.g, r.v): r.n for r in sketches.counts(df, ["g"], "v").collect()} == dict(Counter(rows))
