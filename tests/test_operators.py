import pytest
from pyspark.sql import functions as F

from tarnwheel.functions.vectors import cosine, inner_product, norm
from tarnwheel.operators import relational, temporal
from tarnwheel.sources import formats


def test_asof_ties_nulls_and_clashing_names(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 9, 3), (None, 5, 4), ("c", 5, 5)], "k string, t int, v int")
    right = spark.createDataFrame([("a", 5, 50), ("a", 5, 60), ("a", 2, 20), ("b", 10, 99), (None, 4, 40)], "k string, t int, v int")
    got = {r.v: r.asof_v for r in temporal.asof_join(left, right, ["k"], "t", ["v"]).collect()}
    assert got == {1: 60, 2: None, 3: None, 4: 40, 5: None}


def test_range_join_matches_all_pairs(spark):
    points = spark.createDataFrame([(k, k * 0.7 - 3) for k in range(40)] + [(99, None)], "p int, x double")
    ranges = spark.createDataFrame([(0, -2.0, -1.0), (1, 3.3, 17.0), (2, 5.0, 4.0), (3, 7.0, 7.0), (4, None, 9.0)], "r int, a double, b double")
    got = sorted((r.p, r.r) for r in temporal.range_join(points, ranges, F.col("x"), F.col("a"), F.col("b"), 2.5).collect())
    want = sorted((p.p, r.r) for p in points.collect() for r in ranges.collect() if None not in (p.x, r.a, r.b) and r.a <= p.x <= r.b)
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(spark, how):
    a = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    b = spark.createDataFrame([(0, "x"), (2, "y"), (2, "z")], "k long, w string")
    assert sorted(map(tuple, relational.salted_join(a, b, ["k"], how, 7).collect())) == sorted(map(tuple, a.join(b, "k", how).collect()))
    with pytest.raises(ValueError):
        relational.salted_join(a, b, ["k"], "full")


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0])], "a array<double>, b array<double>")
    got = df.select(inner_product(F.col("a"), F.col("b")).alias("i"), norm(F.col("a")).alias("n"), cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert [tuple(r) for r in got] == [(24.0, 5.0, 0.96), (0.0, 0.0, None), (None, None, None)]


@pytest.mark.parametrize("kind", ["parquet", "orc", "csv", "json", "xml"])
def test_formats_round_trip(spark, tmp_path, kind):
    df = spark.createDataFrame([(1, "a,\"b", 0.5), (2, "é\tö", None), (3, None, -1.0)], "k int, s string, x double")
    options = {"csv": {"multiLine": "true", "escape": '"'}, "xml": {"rowTag": "row"}}.get(kind, {})
    out = {"csv": {"escape": '"'}, "xml": {"rowTag": "row"}}.get(kind, {})
    formats.write(df, f"{tmp_path}/{kind}", kind, **out)
    assert sorted(formats.read(spark, f"{tmp_path}/{kind}", kind, df.schema, **options).collect(), key=repr) == sorted(df.collect(), key=repr)
    formats.write(df, f"{tmp_path}/by", kind, by=["k"], mode="overwrite", **out)
    assert formats.read(spark, f"{tmp_path}/by", kind, "s string, x double, k int", **options).where("k = 1").count() == 1


def test_formats_refuse_guessing(spark):
    with pytest.raises(ValueError):
        formats.read(spark, "/x", "json")
    with pytest.raises(ValueError):
        formats.read(spark, "/x", "zip")


def test_wide_ranges_touch_few_buckets(spark):
    points = spark.range(0, 2000, 7).select(F.col("id").cast("double").alias("x"))
    ranges = spark.createDataFrame([(0, 0.0, 1e9), (1, 3.0, 4.0), (2, 100.0, 900.0), (3, -1e12, 1e12), (4, 1999.0, 1999.0)], "r int, a double, b double")
    joined = temporal.range_join(points, ranges, F.col("x"), F.col("a"), F.col("b"), 1.0)
    want = sorted((p.x, r.r) for p in points.collect() for r in ranges.collect() if r.a <= p.x <= r.b)
    assert sorted((p.x, p.r) for p in joined.collect()) == want


def test_two_step_distinct(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 50).alias("v"))
    want = df.groupBy("k").agg(F.count_distinct("v").alias("n"))
    assert sorted(relational.two_step_distinct(df, ["k"], "v").collect()) == sorted(want.collect())


def test_nearest_in_blocks(spark, monkeypatch):
    rows = spark.range(60).select(F.col("id").alias("i"), F.array(F.sin("id"), F.cos("id")).alias("v"))
    ask = lambda: sorted(tuple(r)[:2] for r in relational.nearest(rows.where("i % 20 = 0"), rows, "i", inner_product(F.col("asked_v"), F.col("v")), 4).collect())
    want = ask()
    monkeypatch.setattr(relational, "BLOCK", 1)
    assert ask() == want and len(want) == 12


def test_views_of_the_user_stay(spark):
    from tarnwheel.plans import catalog

    spark.range(3).createOrReplaceTempView("orders")
    catalog.QUERIES["q_having"](spark, "/root/testdata/sf0.001").collect()
    assert spark.table("orders").count() == 3
    spark.catalog.dropTempView("orders")


def test_tables_of_an_operator_go(spark):
    import os

    from tarnwheel.session import Held

    held = Held(spark)
    a, b = held(spark.range(5).toDF("x"), "a"), held(spark.range(6).toDF("y"), "b")
    files = [f.removeprefix("file://") for df in (a, b) for f in df.inputFiles()]
    held.release(b)
    assert b.count() == 6 and [os.path.exists(f) for f in files] == [f in {x.removeprefix("file://") for x in b.inputFiles()} for f in files]
    assert not all(map(os.path.exists, files))


def test_shared_folder_has_to_be_named_on_a_cluster(spark, monkeypatch):
    from tarnwheel import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_pairs_of_a_bucket_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(temporal, "PAIRS", 1000)
    monkeypatch.setattr(temporal, "SHARES", 1)
    points = spark.range(2000).select(F.col("id").alias("p"), (F.col("id") % 50).cast("double").alias("x"))
    ranges = spark.range(60).select(F.col("id").alias("r"), F.col("id").cast("double").alias("a"), (F.col("id") + 3).cast("double").alias("b"))
    joined = temporal.range_join(points, ranges, F.col("x"), F.col("a"), F.col("b"), 100.0)  # one bucket has all
    want = sorted((p, r) for p in range(2000) for r in range(60) if r <= p % 50 <= r + 3)
    assert sorted((r.p, r.r) for r in joined.collect()) == want
    tasks = joined.select(F.spark_partition_id().alias("t")).groupBy("t").count().collect()
    assert len(tasks) > 40 and max(r["count"] for r in tasks) < len(want) / 10
