"""Count-min sketches as tables: stored by group, rolled up by sums, asked without the rows that they were made of.

A sketch has DEPTH rows of WIDTH cells; a value counts in one cell of each row. The estimate of a value, the least of its
cells, is never under its count, and over it by more than E / WIDTH of all rows with a chance of E**-DEPTH at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH, DEPTH = 2048, 5
#: Rows that a task puts into cells at once, about.
ROWS = 1 << 18


def _cells(value: Column, width: int, depth: int) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth - 1)), lambda d: F.struct(d.alias("depth"), F.pmod(F.xxhash64(d, value), F.lit(width)).cast("int").alias("cell"))))


def _parts(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS))


def dealt(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """df in partitions of about ROWS rows, a group's rows together; a group of more is cut into shares by value, and by where its rows come from, so that no value is one task."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("_rows"))
    cut = sizes.where(F.col("_rows") > ROWS).select(*(F.col(c).alias(f"_{c}") for c in by), F.ceil(F.col("_rows") / ROWS).cast("int").alias("_shares"))  # a row for ROWS rows at most
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    share = F.pmod(F.xxhash64(value, F.spark_partition_id()), F.coalesce("_shares", F.lit(1)))
    return df.join(F.broadcast(cut), same, "left").withColumn("_share", share).select(*df.columns, "_share").repartition(_parts(df), *by, "_share")


def counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, n): how often each group has each value, counted in shares first and in tasks of about ROWS rows."""
    some = dealt(df, by, value).groupBy(*by, "_share", value).agg(F.count("*").alias("_c"))
    return some.repartition(_parts(df), *by, value).groupBy(*by, value).agg(F.sum("_c").alias("n"))


def count_min(df: DataFrame, by: list[Column], value: Column, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(by, depth, cell, n): a sketch of each group's values, nulls included; values are counted before they are hashed.

    Rows are dealt by group first: a task makes the cells of its own groups, and not some of each group's.
    """
    rows = df.select(*by, value.alias("_v"))
    names = rows.columns[: len(by)]
    counted = dealt(rows, names, "_v").groupBy(*names, "_share", "_v").agg(F.count("*").alias("_c"))
    return counted.select(*names, "_c", _cells(F.col("_v"), width, depth).alias("x")).groupBy(*names, "x.depth", "x.cell").agg(F.sum("_c").alias("n"))


def rolled_up(sketch: DataFrame, by: list[str]) -> DataFrame:
    """A sketch of coarser groups: cells are sums."""
    return sketch.groupBy(*by, "depth", "cell").agg(F.sum("n").alias("n"))


def estimates(sketch: DataFrame, asked: DataFrame, value: str, by: list[str], width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """asked (by, value) with the estimate of each value's count in its group; width and depth are the sketch's."""
    cells = asked.select(*by, value, _cells(F.col(value), width, depth).alias("x")).select(*by, value, "x.depth", "x.cell")
    found = cells.join(sketch, [*by, "depth", "cell"], "left")
    return found.groupBy(*by, value).agg(F.coalesce(F.min(F.coalesce("n", F.lit(0))), F.lit(0)).alias("estimate"))


def error_bound(rows: Column, width: int = WIDTH) -> Column:
    """By how much an estimate over so many rows may be too large."""
    return F.lit(math.e / width) * rows
