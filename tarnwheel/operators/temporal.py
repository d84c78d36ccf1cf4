"""Joins on time and on ranges, which Spark has no operator for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwheel.session import written


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, take: list[str], prefix: str = "asof_") -> DataFrame:
    """All rows of left with the columns `take` of right's last row at or before their time, per key `by`.

    Both sides are sorted together once by key and time, right's rows first at equal times, and the last right row is
    carried along; nothing is paired. A key's rows go to one task, so keys have to be finer than the cluster. Of
    several right rows at one time, the greatest by `take` counts. Columns: left's, then prefix + take.
    """
    names = left.columns
    a = left.select(F.lit(1).alias("_side"), *(F.col(k).alias(f"_k{n}") for n, k in enumerate(by)), F.col(time).alias("_t"), F.struct(*names).alias("_row"), F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("_found"))
    b = right.select(F.lit(0).alias("_side"), *(F.col(k).alias(f"_k{n}") for n, k in enumerate(by)), F.col(time).alias("_t"), F.lit(None).cast(left.select(F.struct(*names)).schema[0].dataType).alias("_row"), F.struct(*take).alias("_found"))
    along = Window.partitionBy(*(f"_k{n}" for n in range(len(by)))).orderBy("_t", "_side", "_found").rowsBetween(Window.unboundedPreceding, 0)
    carried = a.unionByName(b).withColumn("_found", F.last("_found", ignorenulls=True).over(along)).where("_side = 1")
    return carried.select("_row.*", *(F.col(f"_found.{c}").alias(prefix + c) for c in take))


#: A range touches so many buckets of its level at most, and one more.
FAN = 16
#: Pairs that a share of a bucket compares, about; shares that a task has.
PAIRS, SHARES = 1 << 22, 4


def range_join(points: DataFrame, ranges: DataFrame, point: Column, start: Column, stop: Column, width: float) -> DataFrame:
    """Pairs with start <= point <= stop, by buckets instead of a nested loop.

    A range goes to the buckets that it touches at a level of its own, where buckets are `width` * FAN**level wide, so
    that they are FAN + 1 at most; a point goes to one bucket of each level that any range has. Width should be about a
    range's usual length. A null or reversed range meets nothing. Rows of a bucket are few beside its pairs, which go with
    the square of the tables: a bucket with over PAIRS of them is cut into shares of its points, each of which meets all of
    its ranges, and tasks go by pairs and not by rows.
    """
    level = F.greatest(F.lit(0), F.ceil(F.log(float(FAN), F.greatest((stop - start) / F.lit(width * FAN), F.lit(1.0))))).cast("int")
    bucket = lambda x, at: F.floor(x / (F.lit(width) * F.pow(F.lit(float(FAN)), at))).cast("long")
    b = ranges.where(start <= stop).withColumn("_level", level)
    b = b.withColumn("_bucket", F.explode(F.sequence(bucket(start, F.col("_level")), bucket(stop, F.col("_level")))))
    levels = sorted(r[0] for r in ranges.where(start <= stop).select(level.alias("l")).distinct().collect())  # one for each power of FAN
    a = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels or [0])))).withColumn("_bucket", bucket(point, F.col("_level")))
    keys = ["_level", "_bucket"]
    sizes = a.groupBy(*keys).agg(F.count("*").alias("_a")).join(b.groupBy(*keys).agg(F.count("*").alias("_b")), keys)
    shares = F.ceil(F.col("_a").cast("double") * F.col("_b") / PAIRS).cast("int")
    sizes = written(sizes.select(*keys, shares.alias("_shares")), "range-buckets")
    n = sizes.agg(F.sum("_shares")).first()[0] or 0
    parts = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARES))
    cut = sizes.where("_shares > 1")
    share = F.coalesce("_shares", F.lit(1))
    a = a.join(cut, keys, "left").withColumn("_share", F.floor(F.rand(7) * share).cast("int")).drop("_shares")
    b = b.join(cut, keys, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), share - 1))).drop("_shares")
    keys = [*keys, "_share"]
    a, b = (df.repartition(parts, *keys) for df in (a, b))  # by number: small partitions aren't put together
    return a.join(b.hint("shuffle_hash"), keys).where((point >= start) & (point <= stop)).drop(*keys)


def sessions(df: DataFrame, by: list[str], time: str, gap: str) -> DataFrame:
    """Groups by key and session: a session ends where the next row is `gap` or more away."""
    return df.groupBy(*by, F.session_window(time, gap).alias("session")).agg(F.count("*").alias("n")).select(*by, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "n")
