"""More registered queries: dialect features, join strategies, approximate and sketch aggregates, rewrites of frames,
functions in Python, a connector, and streams run to their end; each with DuckDB text that gives the same rows.

What is approximate answers whether it is within a stated bound of the exact figure, so that it has a twin too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.functions import udfs
from tarnwheel.plans.registry import both, built
from tarnwheel.session import scratch, ship
from tarnwheel.sources import formats
from tarnwheel.sources.generated import squares
from tarnwheel.sources.tables import table
from tarnwheel.streaming import windows

# projections and dialect
both("q_except_column", "SELECT * EXCEPT (r_name) FROM region", "SELECT * EXCLUDE (r_name) FROM region")
both("q_pipe", "FROM customer |> WHERE c_acctbal > 0 |> AGGREGATE count(*) AS n GROUP BY c_nationkey |> WHERE n > 2", "SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey HAVING count(*) > 2")
both("q_lateral_alias", "SELECT l_orderkey, l_linenumber, l_quantity * 2 AS twice, twice + 1 AS more FROM lineitem")
both(
    "q_range_rows",
    "SELECT id AS hour, count(event_id) AS n FROM range(24) LEFT JOIN events ON hour(ts) = id AND event_type = 'signup' GROUP BY id",
    "SELECT range AS hour, count(event_id) AS n FROM range(24) LEFT JOIN events ON hour(ts) = range AND event_type = 'signup' GROUP BY range",
)

# forced join strategies: the same rows from each
_JOINED = "o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000"
for _name, _hint in (("broadcast", "BROADCAST(tarnwheel_customer)"), ("merge", "MERGE(tarnwheel_customer)"), ("hash", "SHUFFLE_HASH(tarnwheel_customer)")):
    both(f"q_forced_{_name}", f"SELECT /*+ {_hint} */ {_JOINED}", f"SELECT {_JOINED}")
both("q_forced_nested_loop", "SELECT /*+ SHUFFLE_REPLICATE_NL(tarnwheel_region) */ n_name, r_name FROM nation JOIN region ON n_regionkey < r_regionkey", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey < r_regionkey")

# aggregates
both("q_correlation", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS c, round(covar_pop(l_quantity, l_discount), 6) AS v FROM lineitem GROUP BY l_returnflag")
both(
    "q_moments",
    "SELECT l_returnflag, round(skewness(l_quantity), 4) AS s, round(kurtosis(l_quantity), 4) AS k FROM lineitem GROUP BY l_returnflag",
    "SELECT l_returnflag, round(skewness(l_quantity) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 4) AS s, round(kurtosis_pop(l_quantity), 4) AS k FROM lineitem GROUP BY l_returnflag",
)
both("q_mode", "SELECT o_orderstatus, mode(o_orderpriority, true) AS m FROM orders GROUP BY o_orderstatus", "SELECT o_orderstatus, arg_min(p, struct_pack(n := -n, p := p)) AS m FROM (SELECT o_orderstatus, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderstatus")
both("q_listagg", "SELECT o_custkey, listagg(CAST(o_orderkey AS STRING), ',') WITHIN GROUP (ORDER BY o_orderkey) AS orders FROM orders GROUP BY o_custkey", "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS orders FROM orders GROUP BY o_custkey")
_NEAR = "SELECT l_returnflag, abs({0} - count(DISTINCT l_partkey)) <= 0.1 * count(DISTINCT l_partkey) AS near FROM lineitem GROUP BY l_returnflag"
_TRUE = "SELECT l_returnflag, true AS near FROM lineitem GROUP BY l_returnflag"
both("q_approx_distinct", _NEAR.format("approx_count_distinct(l_partkey, 0.02)"), _TRUE)
both("q_hll_sketch", _NEAR.format("hll_sketch_estimate(hll_sketch_agg(l_partkey, 14))"), _TRUE)
both("q_theta_sketch", _NEAR.format("theta_sketch_estimate(theta_sketch_agg(l_partkey, 14))"), _TRUE)
both("q_approx_percentile", "SELECT l_returnflag, abs(approx_percentile(l_extendedprice, 0.5, 10000) - median(l_extendedprice)) <= 0.02 * median(l_extendedprice) AS near FROM lineitem GROUP BY l_returnflag", _TRUE)
both("q_kll_sketch", "SELECT l_returnflag, abs(kll_sketch_get_quantile_double(kll_sketch_agg_double(l_extendedprice), 0.5) - median(l_extendedprice)) <= 0.1 * median(l_extendedprice) AS near FROM lineitem GROUP BY l_returnflag", _TRUE)
both("q_approx_top", "SELECT t.item AS l_linenumber, t.count AS n FROM (SELECT explode(approx_top_k(l_linenumber, 3, 100)) AS t FROM lineitem)", "SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY l_linenumber ORDER BY n DESC LIMIT 3")

# frames that Spark has no words for, by rewriting
both(
    "q_groups_frame",
    "SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY d RANGE BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM (SELECT o_orderkey, o_orderstatus, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS d FROM orders)",
    "SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM orders",
)
both(
    "q_exclude_row",
    "SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS top FROM events",
    "SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW EXCLUDE CURRENT ROW) AS top FROM events",
)
both(
    "q_distinct_over",
    "SELECT o_orderkey, CAST(size(collect_set(o_orderpriority) OVER (PARTITION BY o_custkey)) AS BIGINT) AS n FROM orders",
    "SELECT o_orderkey, count(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey) AS n FROM orders",
)
both("q_nulls_first", "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS s FROM orders ORDER BY s NULLS FIRST, o_orderkey LIMIT 20")
both("q_nulls_last", "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS s FROM orders ORDER BY s DESC NULLS LAST, o_orderkey DESC LIMIT 20")

# scalar functions
both("q_exp_ln", "SELECT l_orderkey, l_linenumber, round(exp(l_discount), 9) AS e, round(ln(l_quantity), 9) AS l, round(log10(l_extendedprice), 9) AS t, CAST(sign(l_tax - l_discount) AS INT) AS s FROM lineitem")
both("q_search", "SELECT p_partkey, CAST(instr(p_name, 'a') AS BIGINT) AS i, p_name ILIKE '%A%' AS k, starts AS b FROM (SELECT *, startswith(p_type, 'S') AS starts FROM part)", "SELECT p_partkey, instr(p_name, 'a') AS i, p_name ILIKE '%A%' AS k, starts_with(p_type, 'S') AS b FROM part")
both(
    "q_map_functions",
    "SELECT p_partkey, CAST(map_keys(m)[0] AS STRING) AS k, transform_values(m, (k, v) -> v + 1)['size'] AS v, CAST(size(map_concat(m, map('more', 1))) AS BIGINT) AS n FROM (SELECT p_partkey, map_from_arrays(array('size'), array(p_size)) AS m FROM part)",
    "SELECT p_partkey, 'size' AS k, p_size + 1 AS v, 2::BIGINT AS n FROM part",
)
both("q_variant", "SELECT event_id, try_variant_get(parse_json(props), '$.k', 'bigint') AS k, try_variant_get(parse_json(props), '$.none', 'bigint') AS none FROM events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, NULL::BIGINT AS none FROM events")
both("q_from_json", "SELECT event_id, from_json(props, 'k BIGINT').k AS k FROM events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
both("q_from_csv", "SELECT p_partkey, r.a AS a, r.b AS b FROM (SELECT p_partkey, from_csv(concat_ws(',', p_size, p_type), 'a INT, b STRING') AS r FROM part)", "SELECT p_partkey, p_size AS a, p_type AS b FROM part")
both("q_from_xml", "SELECT p_partkey, from_xml(concat('<p><s>', p_size, '</s></p>'), 's INT').s AS s FROM part", "SELECT p_partkey, p_size AS s FROM part")
both("q_collate", "SELECT count(*) AS n FROM part WHERE p_type COLLATE UTF8_LCASE = 'promo'", "SELECT count(*) AS n FROM part WHERE lower(p_type) = 'promo'")


@built("SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("k"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True).select("k", "name", "balance")


@built("SELECT l_returnflag, count(*) AS n, true AS near, true AS from_table FROM lineitem GROUP BY l_returnflag")
def q_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the rows: for each flag the table's rows, whether the sample has a tenth of them within ten standard deviations, and whether it has nothing else."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    keys = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"]
    some = lines.sample(0.1, seed=7).groupBy(*keys).agg(F.count("*").alias("taken"))
    both_ = lines.groupBy(*keys).agg(F.count("*").alias("there")).join(some, keys, "full")
    sums = both_.groupBy("l_returnflag").agg(F.sum("there").alias("n"), F.sum("taken").alias("k"), F.bool_and(F.coalesce("taken", F.lit(0)) <= F.coalesce("there", F.lit(0))).alias("from_table"))
    return sums.selectExpr("l_returnflag", "n", "abs(k - 0.1 * n) <= 10 * sqrt(0.09 * n) as near", "from_table")


both("q_word_count", "SELECT w, count(*) AS n FROM (SELECT explode(split(lower(text), ' ')) AS w FROM documents) GROUP BY w", "SELECT w, count(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM documents) GROUP BY w")


# sinks and other formats, there and back
@built("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def q_partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder for each status; only that of F is read."""
    path = scratch(spark, "by-status")
    formats.write(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path, "parquet", by=["o_orderstatus"])
    return formats.read(spark, path, "parquet", "o_orderkey long, o_totalprice double, o_orderstatus string").where("o_orderstatus = 'F'")


@built("SELECT n_nationkey, n_name, count(*) AS n FROM nation, (VALUES ('csv'), ('json'), ('orc'), ('xml')) v(kind) GROUP BY ALL")
def q_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in four formats and read back, row by row the same."""
    rows, out = table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), None
    for kind in ("csv", "json", "orc", "xml"):
        path, options = scratch(spark, f"nation-{kind}"), {"rowTag": "row"} if kind == "xml" else {}
        formats.write(rows, path, kind, **options)
        back = formats.read(spark, path, kind, rows.schema, **options)
        out = back if out is None else out.union(back)
    return out.groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n"))


# functions in Python
@built("SELECT c_custkey, len(regexp_extract_all(c_mktsegment || lower(c_mktsegment), '[aeiou]'))::BIGINT AS n FROM customer")
def q_udf_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    count = udfs.vowels()
    return table(spark, sf_dir, "customer").select("c_custkey", count(F.concat("c_mktsegment", F.lower("c_mktsegment"))).alias("n"))


@built("SELECT doc_id, md5(strip_accents(text)) AS plain_md5 FROM documents")
def q_pandas_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(udfs.unaccented(F.col("text"))).alias("plain_md5"))


@built("SELECT c_custkey, len(regexp_replace(c_name, '[0-9]', '', 'g'))::BIGINT AS n FROM customer")
def q_pandas_udf_iterator(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "customer").select("c_custkey", udfs.buffered(F.col("c_name")).alias("n"))


@built("SELECT l_suppkey, mad(l_quantity) AS deviation FROM lineitem GROUP BY l_suppkey")
def q_udaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(udfs.deviation()("l_quantity").alias("deviation"))


@built("SELECT s_suppkey, place::INT AS place, substr(reverse(s_suppkey::VARCHAR), place + 1, 1)::INT AS digit FROM (SELECT s_suppkey, unnest(range(0, len(s_suppkey::VARCHAR))) AS place FROM supplier)")
def q_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows, digits = table(spark, sf_dir, "supplier").select("s_suppkey"), udfs.digits()
    return rows.lateralJoin(digits(F.col("s_suppkey").outer()))


@built("""
WITH RECURSIVE e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
s(user_id, event_id, k, smooth) AS (SELECT user_id, event_id, k, value FROM e WHERE k = 1 UNION ALL SELECT e.user_id, e.event_id, e.k, 0.8 * s.smooth + 0.2 * e.value FROM s JOIN e ON e.user_id = s.user_id AND e.k = s.k + 1)
SELECT event_id, round(smooth::DOUBLE, 6) AS smooth FROM s
""")
def q_grouped_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = udfs.smoothed(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", 0.2)
    return found.select("event_id", F.round("smooth", 6).alias("smooth"))


@built("SELECT k AS key, coalesce(a, 0)::BIGINT AS n_left, coalesce(b, 0)::BIGINT AS n_right FROM (SELECT c_nationkey AS k, count(*) AS a FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey AS k, count(*) AS b FROM supplier GROUP BY 1) USING (k)")
def q_cogrouped_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey")
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), "s_suppkey")
    return udfs.sizes(a, b, "k").withColumn("key", F.col("key").cast("int"))


@built("SELECT c_custkey, c_custkey * c_custkey AS square FROM customer")
def q_custom_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a connector, as many as the customers, beside these."""
    ship(spark)
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    made = squares(spark, customers.agg(F.max("c_custkey")).first()[0] + 1)
    return customers.join(made, F.col("c_custkey") == F.col("k")).select("c_custkey", "square")


# streams, run to their end
@built("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def q_stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windows.event_stream(spark, sf_dir).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return windows.to_files(counts.select(F.col("w.start").alias("window_start"), "event_type", "n"), "stream-tumbling", "complete").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@built("SELECT a.event_id AS view_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'purchase' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 30 MINUTES")
def q_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = windows.event_stream(spark, sf_dir)
    joined = windows.interval_join(events.where("event_type = 'view'"), events.where("event_type = 'purchase'"), "user_id", "30 minutes")
    return windows.to_files(joined.select(F.col("a.event_id").alias("view_id"), F.col("b.event_id").alias("purchase_id")), "stream-join")


@built("SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def q_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of each user's state."""
    ship(spark)
    changes = windows.to_files(windows.running_totals(windows.event_stream(spark, sf_dir)), "stream-state", "update")
    last = changes.groupBy("user_id").agg(F.max(F.struct("batch", "n", "total")).alias("s"))
    return last.select("user_id", "s.n", F.round("s.total", 2).alias("total"))


@built("SELECT time_bucket(INTERVAL 30 MINUTES, ts) - k * INTERVAL 30 MINUTES AS window_start, event_type, count(*) AS n FROM events, (VALUES (0), (1)) v(k) GROUP BY ALL")
def q_stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windows.event_stream(spark, sf_dir).groupBy(F.window("ts", "1 hour", "30 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return windows.to_files(counts.select(F.col("w.start").alias("window_start"), "event_type", "n"), "stream-sliding", "complete").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@built("SELECT DISTINCT user_id, event_type FROM events")
def q_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a stream has, deduplicated within its watermark; the table is one batch, so each key comes once."""
    seen = windows.first_seen(windows.event_stream(spark, sf_dir).select("user_id", "event_type", "ts"), ("user_id", "event_type"))
    return windows.to_files(seen.select("user_id", "event_type"), "stream-distinct")
