"""Registered relational, window, set, scalar and time queries, each with DuckDB text that gives the same rows.

Where the dialects agree one text serves both; sums of doubles are rounded, since their order isn't fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.operators import exactnearest, ordered, relational, temporal
from tarnwheel.plans.registry import ORACLE, QUERIES, both, built
from tarnwheel.session import ship
from tarnwheel.sources.tables import table
from tarnwheel.streaming import windows

# filters and projections
both("q_filter", "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem WHERE l_quantity < 10 AND l_discount >= 0.05 AND l_shipdate < TIMESTAMP '1997-01-01 00:00:00'")
both("q_case_in_between", "SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size <= 30 THEN 'middle' ELSE 'large' END AS kind FROM part WHERE p_type IN ('PROMO', 'ECONOMY', 'SMALL')")
both("q_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%a%' AND p_name NOT LIKE 'b%'")
_STATES = "(SELECT nullif(o_orderstatus, 'F') AS k, count(*) AS n FROM orders GROUP BY 1)"
both("q_null_safe", f"SELECT a.k AS k, a.n AS n_all, b.n AS n_dear FROM {_STATES} a JOIN (SELECT nullif(o_orderstatus, 'F') AS k, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k")

# joins
both("q_nation_revenue", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00' GROUP BY n_name")
both("q_left_join", "SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey")
both("q_right_join", "SELECT o_orderkey, count(l_linenumber) AS n_lines FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey")
both("q_full_join", "SELECT coalesce(s_nationkey, c_nationkey) AS nation, s_suppkey, c_custkey FROM (SELECT * FROM supplier WHERE s_acctbal > 8000) s FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 9500) c ON s_nationkey = c_nationkey")
both("q_cross_join", "SELECT r_name, n_name FROM region CROSS JOIN nation WHERE n_nationkey < 3")
both("q_semi_join", "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
both("q_anti_join", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
both("q_scalar_subquery", "SELECT o_orderkey, o_totalprice FROM orders o WHERE o_totalprice > (SELECT 1.5 * avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)")
both("q_lateral", "SELECT n_name, t.c_custkey, t.c_acctbal FROM nation, LATERAL (SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey = n_nationkey ORDER BY c_acctbal DESC, c_custkey LIMIT 2) t")
both(
    "q_recursive",
    "WITH RECURSIVE t(k, depth) AS (SELECT c_custkey, 0 FROM customer WHERE c_custkey = 1 UNION ALL SELECT c_custkey, depth + 1 FROM t JOIN customer ON c_custkey div 2 = k) SELECT k, depth FROM t",
    "WITH RECURSIVE t(k, depth) AS (SELECT c_custkey, 0 FROM customer WHERE c_custkey = 1 UNION ALL SELECT c_custkey, depth + 1 FROM t JOIN customer ON c_custkey // 2 = k) SELECT k, depth FROM t",
)

# aggregates
both("q_pricing", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 1) AS sum_base, round(avg(l_discount), 8) AS avg_disc, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus")
both("q_distincts", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderstatus) AS states FROM orders GROUP BY o_orderpriority")
both("q_agg_filter", "SELECT event_type, count(*) FILTER (WHERE value > 100) AS high, count(*) AS n FROM events GROUP BY event_type")
both("q_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15")
both("q_rollup", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
both("q_cube", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
both("q_grouping_sets", "SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS BIGINT) AS g, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
both("q_statistics", "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, median(l_quantity) AS med FROM lineitem GROUP BY l_returnflag")
both("q_percentile", "SELECT o_orderpriority, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY o_totalprice), 4) AS p25 FROM orders GROUP BY o_orderpriority")
both("q_max_by", "SELECT c_nationkey, max_by(c_custkey, c_acctbal) AS richest, max(c_acctbal) AS balance, bool_or(c_acctbal < 0) AS any_debt FROM customer GROUP BY c_nationkey")
both("q_collect", "SELECT o_custkey, array_join(sort_array(collect_list(o_orderkey)), ',') AS orders FROM orders GROUP BY o_custkey", "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS orders FROM orders GROUP BY o_custkey")
both("q_pivot", "SELECT * FROM (SELECT l_returnflag, l_linestatus FROM lineitem) PIVOT (count(*) FOR l_linestatus IN ('F' AS f, 'O' AS o))", "SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS f, count(*) FILTER (WHERE l_linestatus = 'O') AS o FROM lineitem GROUP BY l_returnflag")
both("q_unpivot", "SELECT p_partkey, k, v FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part) UNPIVOT (v FOR k IN (size, price))", "SELECT p_partkey, 'size' AS k, p_size::DOUBLE AS v FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part")

# windows


@built("SELECT o_orderkey, CAST(row_number() OVER w AS BIGINT) AS rn, CAST(rank() OVER p AS BIGINT) AS rk, CAST(dense_rank() OVER p AS BIGINT) AS dr, CAST(ntile(4) OVER w AS BIGINT) AS nt, cume_dist() OVER p AS cd, percent_rank() OVER p AS pr FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey), p AS (PARTITION BY o_orderstatus ORDER BY o_orderpriority)")
def q_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks within the states of orders, each of which is many tasks."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    found = ordered.ranks(orders, ["o_orderstatus"], ["o_totalprice", "o_orderkey"], ["o_orderpriority"], 4)
    return found.select("o_orderkey", "rn", "rk", "dr", "nt", "cd", "pr")


both("q_lag_lead", "SELECT event_id, lag(value) OVER w AS before, lead(value, 2) OVER w AS after, first_value(value) OVER w AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
both("q_rows_frame", "SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS top FROM events")
both("q_range_frame", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS n FROM events")
both("q_nth_value", "SELECT o_orderkey, nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM orders")

# sorting and sets
both("q_top", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10")
both("q_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10 OFFSET 20")
both("q_union", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
both("q_union_all", "SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation")
both("q_intersect", "SELECT l_partkey AS k FROM lineitem INTERSECT SELECT p_partkey FROM part WHERE p_size < 20")
both("q_intersect_all", "SELECT l_linenumber AS k FROM lineitem WHERE l_tax = 0.01 INTERSECT ALL SELECT l_linenumber FROM lineitem WHERE l_tax = 0.02")
both("q_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
both("q_except_all", "SELECT l_linenumber AS k FROM lineitem WHERE l_tax = 0.01 EXCEPT ALL SELECT l_linenumber FROM lineitem WHERE l_tax = 0 AND l_discount = 0.05")
both("q_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")

# scalar functions
both("q_strings", "SELECT p_partkey, upper(p_name) AS u, CAST(length(p_name) AS BIGINT) AS n, substring(p_name, 2, 3) AS s, replace(p_name, 'a', '_') AS r, reverse(p_brand) AS v, lpad(CAST(p_size AS VARCHAR(9)), 4, '0') AS l, concat_ws('-', p_brand, p_type) AS c FROM part")
both("q_regexp", "SELECT p_partkey, regexp_extract(p_brand, '([0-9])([0-9])', 2) AS d, regexp_replace(p_name, '[aeiou]', '*') AS x FROM part", "SELECT p_partkey, regexp_extract(p_brand, '([0-9])([0-9])', 2) AS d, regexp_replace(p_name, '[aeiou]', '*', 'g') AS x FROM part")
both("q_dates", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(quarter(o_orderdate) AS BIGINT) AS q, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP_NTZ) AS t, CAST(weekday(o_orderdate) + 1 AS BIGINT) AS d FROM orders", "SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS t, isodow(o_orderdate) AS d FROM orders")
both("q_math", "SELECT l_orderkey, l_linenumber, abs(l_tax - l_discount) AS a, sqrt(l_quantity) AS s, CAST(floor(l_extendedprice) AS BIGINT) AS f, round(power(l_quantity, 2), 4) AS p, greatest(l_tax, l_discount) AS g FROM lineitem")
both("q_json", "SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
both("q_hashes", "SELECT c_custkey, md5(c_name) AS m, sha2(c_name, 256) AS s, CAST(levenshtein(c_name, c_mktsegment) AS BIGINT) AS l FROM customer", "SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s, levenshtein(c_name, c_mktsegment) AS l FROM customer")
both("q_explode", "SELECT vec_id, CAST(pos AS BIGINT) AS pos, CAST(x AS DOUBLE) AS x FROM embeddings LATERAL VIEW posexplode(embedding) AS pos, x", "SELECT vec_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings")
both("q_arrays", "SELECT vec_id, CAST(size(filter(embedding, x -> x > 0)) AS BIGINT) AS n, CAST(array_max(embedding) AS DOUBLE) AS top FROM embeddings", "SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS n, list_max(embedding)::DOUBLE AS top FROM embeddings")
both("q_maps", "SELECT p_partkey, map_filter(map('size', CAST(p_size AS DOUBLE), 'price', p_retailprice), (k, v) -> v > 20)['size'] AS size FROM part", "SELECT p_partkey, CASE WHEN p_size > 20 THEN p_size::DOUBLE END AS size FROM part")

# time windows
both("q_tumbling", "SELECT CAST(window.start AS TIMESTAMP_NTZ) AS t, event_type, count(*) AS n FROM events GROUP BY window(ts, '1 hour'), event_type", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS t, event_type, count(*) AS n FROM events GROUP BY ALL")
both("q_sliding", "SELECT CAST(window.start AS TIMESTAMP_NTZ) AS t, count(*) AS n FROM events GROUP BY window(ts, '1 hour', '30 minutes')", "SELECT time_bucket(INTERVAL 30 MINUTES, ts) - k * INTERVAL 30 MINUTES AS t, count(*) AS n FROM events, (VALUES (0), (1)) v(k) GROUP BY 1")

_SESSIONS = """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTES AS session_end, count(*) AS n FROM s GROUP BY user_id, k
"""


@built(_SESSIONS)
def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", "30 minutes").withColumns({k: F.col(k).cast("timestamp_ntz") for k in ("session_start", "session_end")})


@built("SELECT p.event_id, p.user_id, v.ts AS asof_ts, v.value AS asof_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts")
def q_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    bought, seen = events.where("event_type = 'purchase'"), events.where("event_type = 'view'")
    return temporal.asof_join(bought, seen, ["user_id"], "ts", ["ts", "value"]).select("event_id", "user_id", "asof_ts", "asof_value")


@built("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_acctbal BETWEEN s_acctbal - 25 AND s_acctbal + 25")
def q_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    ranges = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return temporal.range_join(points, ranges, F.col("c_acctbal"), F.col("s_acctbal") - 25, F.col("s_acctbal") + 25, 50).select("c_custkey", "s_suppkey")


@built("SELECT a.event_id AS view_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'purchase' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 30 MINUTES")
def q_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    joined = windows.interval_join(events.where("event_type = 'view'"), events.where("event_type = 'purchase'"), "user_id", "30 minutes")
    return joined.select(F.col("a.event_id").alias("view_id"), F.col("b.event_id").alias("purchase_id"))


@built("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def q_top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return relational.top_k(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@built("SELECT l_orderkey, l_linenumber, l_quantity, p_type FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 45")
def q_salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_partkey").alias("k"))
    return relational.salted_join(lines, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_type"), ["k"]).drop("k")


@built("SELECT l_returnflag, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_returnflag")
def q_two_step_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.two_step_distinct(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_partkey")


@built("SELECT a.vec_id AS asked, b.vec_id, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id % 20 = 0 AND b.vec_id <> a.vec_id QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) <= 10")
def q_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to each whose id is divisible by 20, among all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ship(spark)
    found = exactnearest.nearest(vectors.where("vec_id % 20 = 0"), vectors, "vec_id", "embedding", 10)
    return found.select("asked", "vec_id", F.round("similarity", 6).alias("similarity"))


from tarnwheel.plans import extended, scaled, textual  # noqa: E402, F401  (they register their queries)

__all__ = ["ORACLE", "QUERIES"]
