"""Windows over a whole order, and joins along time, in two passes over range partitions: no key and no table is one task.

Both sort rows into ranges of the full order, write them with the number of their range, and look at each range by
itself. What one range has to know of those before it is one row a range, so it is bounded by the number of partitions:
those rows are summed up on the driver and sent to all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwheel.session import Held

RANGE = "_range"
#: Rows of a range in `ranks`, about: what a task sorts at once.
ROWS = 1 << 18


def ranged(df: DataFrame, order: list[str], held: Held, parts: int | None = None) -> DataFrame:
    """df written in ranges of `order` (names, ascending, nulls first), numbered in that order by the column RANGE.

    Equal rows of the order stay in one range, so the order has to have tie-breakers where rows can be alike by it.
    """
    parts = parts or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(parts, *order).withColumn(RANGE, F.spark_partition_id())
    return held(dealt, "ranges")


def running(df: DataFrame, order: list[str], sums: dict[str, str] | None = None, number: str = "row_number", parts: int | None = None) -> DataFrame:
    """df with the number of each row in the whole order, from 1, and running sums of columns: {new name: column}.

    The same as row_number() and sum() over (order by ... rows unbounded preceding), where rows that are alike in all of
    `order` are numbered in any order. A null counts for nothing in a sum; a sum of nulls alone is null.
    """
    sums, spark = sums or {}, df.sparkSession
    held = Held(spark)
    rows = ranged(df, order, held, parts)
    totals = rows.groupBy(RANGE).agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_s{k}") for k, c in enumerate(sums.values()))).collect()  # a row a range
    before, n, so_far = [], 0, [None] * len(sums)
    for r in sorted(totals, key=lambda r: r[RANGE]):
        before.append((r[RANGE], n, *so_far))
        n += r["_n"]
        so_far = [a if b is None else b if a is None else a + b for a, b in zip(so_far, r[2:], strict=True)]
    types = [rows.agg(F.sum(c)).schema[0].dataType.simpleString() for c in sums.values()]
    schema = ", ".join([f"{RANGE} int", "_n long", *(f"_s{k} {t}" for k, t in enumerate(types))])
    along = Window.partitionBy(RANGE).orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.join(F.broadcast(spark.createDataFrame(before, schema)), RANGE)
    own = own.withColumn(number, F.row_number().over(along) + F.col("_n"))
    for k, (name, c) in enumerate(sums.items()):
        here = F.sum(c).over(along)
        own = own.withColumn(name, F.coalesce(here + F.col(f"_s{k}"), here, F.col(f"_s{k}")))
    return own.select(*df.columns, number, *sums)


def ranks(df: DataFrame, by: list[str], order: list[str], peers: list[str], tiles: int) -> DataFrame:
    """df with rn and nt (row_number and ntile(tiles), by `order`) and rk, dr, cd, pr (rank, dense_rank, cume_dist and percent_rank, by `peers`) in each group `by`; a large group is many tasks.

    Nulls come last, as in DuckDB. Rows are dealt once into ranges of about ROWS rows that are written in order, so a
    row's number is where its range starts and its place there. Rows of equal peers are counted, and only the counts are
    summed along. What is told to rows are a row a group and a row of each peers; Spark broadcasts it where it is small.
    """
    spark, held = df.sparkSession, Held(df.sparkSession)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS))
    keys = [x for c in (*by, *order) for x in (F.col(c).isNull(), F.col(c))]
    at = F.monotonically_increasing_id()  # the partition's number above 33 bits for the row in it
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", at)
    rows = held(dealt.withColumn(RANGE, F.shiftright("_at", 33).cast("int")).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))), "ranks")
    starts, n = [], 0
    for r in sorted(rows.groupBy(RANGE).agg(F.count("*").alias("n")).collect(), key=lambda r: r[RANGE]):  # a row a range
        starts.append((r[RANGE], n))
        n += r["n"]
    rows = rows.join(F.broadcast(spark.createDataFrame(starts, f"{RANGE} int, _start long")), RANGE)
    rows = rows.withColumn("_at", F.col("_at") + F.col("_start") + 1)
    groups = held(rows.groupBy(*by).agg(F.min("_at").alias("_first"), F.count("*").alias("_all")), "rank-groups")

    counts = held(df.groupBy(*by, *peers).agg(F.count("*").alias("_peers")), "rank-peers")
    flags = {f"_f{k}": F.col(c).isNull() for k, c in enumerate((*by, *peers))}
    along = [x for pair in zip(flags, (*by, *peers), strict=True) for x in pair]
    summed = running(counts.withColumns(flags), along, {"_upto": "_peers"}, "_number")
    before = summed.groupBy(*by).agg(F.min("_number").alias("_low"), F.min("_upto").alias("_least"), F.min_by("_peers", "_number").alias("_own"))
    same = lambda a, b, names: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
    peer = summed.alias("a").join(before.alias("b"), same("a", "b", by)).select("a.*", (F.col("_number") - F.col("_low") + 1).alias("dr"), (F.col("_upto") - F.col("_least") + F.col("_own")).alias("_last"))
    peer = held(peer.select(*by, *peers, "dr", "_last", (F.col("_last") - F.col("_peers") + 1).alias("rk")), "rank-sums")

    told = rows.alias("a").join(groups.alias("b"), same("a", "b", by)).select("a.*", (F.col("_at") - F.col("_first") + 1).alias("rn"), "_all")
    told = told.alias("a").join(peer.alias("b"), same("a", "b", [*by, *peers])).select("a.*", "rk", "dr", "_last")
    more, size = F.expr(f"_all % {tiles}"), F.expr(f"_all div {tiles}")  # so many tiles have a row more than size
    tile = F.when(F.col("rn") <= more * (size + 1), F.floor((F.col("rn") - 1) / (size + 1))).otherwise(more + F.floor((F.col("rn") - 1 - more * (size + 1)) / F.nullif(size, F.lit(0)))) + 1
    share = F.when(F.col("_all") > 1, (F.col("rk") - 1) / (F.col("_all") - 1)).otherwise(F.lit(0.0))
    return told.select(*df.columns, "rn", "rk", "dr", tile.cast("long").alias("nt"), (F.col("_last") / F.col("_all")).alias("cd"), share.alias("pr"))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, take: list[str], prefix: str = "asof_", parts: int | None = None) -> DataFrame:
    """All rows of left with `take` of right's last row at or before their time, per key `by`; a hot key is many tasks.

    Both sides are sorted together by key and time, right's rows first at equal times; each range carries its last right
    row along, and gets the one that the ranges before it end with if the key goes on. Of several right rows at one time,
    the greatest by `take` counts; a null key or time meets nothing, and a left row with one stays without. Rows of left
    that are alike in key and time may share a range with all like them: a key with one time for all rows is one task.
    """
    spark, names = left.sparkSession, left.columns
    held = Held(spark)
    keys = [f"_k{n}" for n in range(len(by))]
    kind = {"row": left.select(F.struct(*names)).schema[0].dataType, "found": right.select(F.struct(*take)).schema[0].dataType}
    able = F.col(time).isNotNull()
    for c in by:
        able = able & F.col(c).isNotNull()

    def side(df: DataFrame, n: int, row: Column, found: Column) -> DataFrame:
        return df.where(able).select(*(F.col(c).alias(k) for c, k in zip(by, keys, strict=True)), F.col(time).alias("_t"), F.lit(n).alias("_side"), row.alias("_row"), found.alias("_found"))

    a = side(left, 1, F.struct(*names), F.lit(None).cast(kind["found"]))
    b = side(right, 0, F.lit(None).cast(kind["row"]), F.struct(*take))
    both = a.unionByName(b)
    rows = ranged(both.withColumn("_tie", F.xxhash64("_row")), [*keys, "_t", "_side", "_tie"], held, parts)
    at = F.struct("_t", "_side", "_found")
    last_right = F.max(F.when(F.col("_side") == 0, at)).alias("_last")
    # for each range: its first and last key, and the last right row of its last key
    ends = rows.groupBy(RANGE).agg(F.min(F.struct(*keys)).alias("first"), F.max(F.struct(*keys)).alias("last"))
    of_last = rows.join(F.broadcast(ends.select(RANGE, "last")), RANGE).where(F.struct(*keys) == F.col("last")).groupBy(RANGE).agg(last_right)
    known = ends.join(of_last, RANGE).collect()  # a row a range
    carried, key, value = [], None, None
    for r in sorted(known, key=lambda r: r[RANGE]):
        carried.append((r[RANGE], *r["first"], value["_found"] if value and key == r["first"] else None))
        if r["last"] != key:
            key, value = r["last"], None
        value = r["_last"] or value
    schema = rows.select(RANGE, *keys, "_found").schema.add("_before", kind["found"])
    schema = type(schema)([schema[RANGE], *(schema[k] for k in keys), schema["_before"]])
    along = Window.partitionBy(RANGE, *keys).orderBy("_t", "_side", "_found").rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("_found", F.last("_found", ignorenulls=True).over(along)).where("_side = 1")
    own = own.join(F.broadcast(spark.createDataFrame(carried, schema)), [RANGE, *keys], "left").withColumn("_found", F.coalesce("_found", "_before"))
    out = own.select("_row.*", *(F.col(f"_found.{c}").alias(prefix + c) for c in take))
    unable = left.where(~able).select(*names, *(F.lit(None).cast(kind["found"][c].dataType).alias(prefix + c) for c in take))
    return out.unionByName(unable)
