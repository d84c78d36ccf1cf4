"""Registered queries whose usual plan ends in one task, or reads rows again: split windows and joins, classes, recursion, buckets, stored sketches, state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.operators import exact, ordered, recursive, sketches
from tarnwheel.plans.registry import built
from tarnwheel.session import scratch, ship
from tarnwheel.sources import bucketed, filestream
from tarnwheel.sources.tables import table
from tarnwheel.streaming import stateful, windows

_LINES = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@built(f"SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER w AS row_number, sum(l_quantity) OVER w AS quantity_so_far FROM lineitem WINDOW w AS (ORDER BY {', '.join(_LINES)} ROWS UNBOUNDED PRECEDING)")
def q_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers and a running sum over all lines in the order of shipping."""
    lines = table(spark, sf_dir, "lineitem").select(*_LINES)
    return ordered.running(lines, _LINES, {"quantity_so_far": "l_quantity"}).select("l_orderkey", "l_linenumber", "l_quantity", "row_number", "quantity_so_far")


@built("SELECT p.event_id, v.ts AS asof_ts, v.event_id AS asof_event_id, v.value AS asof_value FROM (SELECT * FROM events WHERE event_type = 'error') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') v ON p.ts >= v.ts")
def q_asof_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last click of anybody before each error: one key for all rows."""
    events = table(spark, sf_dir, "events").withColumn("all", F.lit(1))
    found = ordered.asof_join(events.where("event_type = 'error'"), events.where("event_type = 'click'"), ["all"], "ts", ["ts", "event_id", "value"])
    return found.select("event_id", "asof_ts", "asof_event_id", "asof_value")


@built("SELECT doc_id, min(doc_id) OVER w AS class_id, count(*) OVER w AS n_class FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))")
def q_exact_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents with the same text."""
    return exact.exact_classes(table(spark, sf_dir, "documents"))


@built("""
WITH RECURSIVE l AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1),
r(node, depth) AS (SELECT p_partkey, 0 FROM part WHERE p_brand = 'Brand#11' AND p_size = 1 UNION SELECT dst, depth + 1 FROM r JOIN l ON src = node WHERE depth < 6)
SELECT node, min(depth)::INT AS depth FROM r GROUP BY node
""")
def q_reachable_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that can be reached in six steps from the smallest ones of a brand, a step being to the next line of an order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    after = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    edges = lines.join(after, ["l_orderkey", "l_linenumber"]).select(F.col("l_partkey").alias("src"), "dst")
    start = table(spark, sf_dir, "part").where("p_brand = 'Brand#11' and p_size = 1").select(F.col("p_partkey").alias("node"))
    return recursive.reach(start, edges, 6)


@built("SELECT o_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def q_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their lines from bucketed tables: neither the join nor the sums deal rows anew."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = bucketed.bucketed(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice"), ["k"], buckets, "orders")
    lines = bucketed.bucketed(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity"), ["k"], buckets, "lines")
    return bucketed.merged_join(orders, lines, ["k"]).groupBy("k").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity")).withColumnRenamed("k", "o_orderkey")


@built("""
SELECT month, l_partkey, n, true AS within FROM (SELECT date_trunc('month', l_shipdate) AS month, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY month ORDER BY n DESC, l_partkey) <= 5
""")
def q_stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month's five most shipped parts with their true counts, and whether the months' sketches, rolled up from stored ones of days, hold to their bound."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("day"))
    path, size = scratch(spark, "count-min"), (4096, 8)  # a part in 3000 may be over the bound, at the very most
    sketches.count_min(lines, [F.col("day")], F.col("l_partkey"), *size).write.parquet(path)
    month = F.date_trunc("month", "day").cast("timestamp_ntz").alias("month")
    stored = spark.read.parquet(path).select(month, "depth", "cell", "n")
    counts = sketches.counts(lines.select(month, "l_partkey"), ["month"], "l_partkey")
    top = counts.withColumn("k", F.expr("row_number() over (partition by month order by n desc, l_partkey)")).where("k <= 5")
    sizes = counts.groupBy("month").agg(F.sum("n").alias("rows"))
    found = sketches.estimates(sketches.rolled_up(stored, ["month"]), top, "l_partkey", ["month"], *size)
    told = top.join(found, ["month", "l_partkey"]).join(sizes, "month")
    within = (F.col("estimate") >= F.col("n")) & (F.col("estimate") - F.col("n") <= sketches.error_bound(F.col("rows"), size[0]))
    return told.select("month", "l_partkey", "n", within.alias("within"))


_SESSIONS = """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTES AS session_end, count(*) AS n FROM s GROUP BY user_id, k
"""


@built(_SESSIONS)
def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a stream by a processor with timers, closed ones from its output and open ones from its state."""
    ship(spark)
    found = stateful.run_sessions(windows.event_stream(spark, sf_dir), "30 minutes")
    return found.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")


@built("SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders")
def q_file_connector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders streamed through the library's own connector into files that its manifests commit, and read back."""
    ship(spark)
    kind, target = filestream.register(spark), scratch(spark, "connector")
    schema = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp"), "o_totalprice").schema
    stream = spark.readStream.format(kind).schema(schema).option("path", f"{sf_dir}/orders.parquet").load()
    query = stream.writeStream.format(kind).option("path", target).option("checkpointLocation", scratch(spark, "connector-offsets")).start()
    query.processAllAvailable()
    query.stop()
    found = spark.read.format(kind).schema(schema).option("path", target).load()
    return found.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
