"""Relational helpers that Catalyst plans well but that take some writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of asked vectors; a block is broadcast.
BLOCK = 1000


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark cuts groups down before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def salted_join(large: DataFrame, other: DataFrame, on: list[str], how: str = "inner", salts: int = 16) -> DataFrame:
    """A join from the left whose hot keys are spread over `salts` tasks; other's rows of those keys are copied as often.

    Hot is a key with over a quarter of a partition's share of large's rows, so there are four a partition at most, which
    is what is broadcast. All other keys are joined as they are, once.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} can't be salted on the left")
    share = large.count() / (4 * int(large.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(large.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > share).select(*on, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.floor(F.rand(7) * salts).cast("int")).otherwise(0)
    each = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dealt = large.join(hot, on, "left").withColumn("_salt", salt).drop("_hot")
    copied = other.join(hot, on, "left").withColumn("_salt", F.explode(each)).drop("_hot")
    return dealt.join(copied, [*on, "_salt"], how).drop("_salt")


def two_step_distinct(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Distinct values of each key, as `n`: distinct pairs first, dealt by both, so that a hot key is no single task's."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.lit(1).alias("_one")).groupBy(*by).agg(F.count("*").alias("n"))


def nearest(asked: DataFrame, rows: DataFrame, id_col: str, similarity: Column, k: int) -> DataFrame:
    """(asked, id, similarity): for each asked row its k most similar others; ties by id.

    similarity: of asked's columns, which come as asked_<name>, and rows' own. The asked rows go out in blocks of BLOCK,
    each broadcast and met with all rows where these are; only k rows of an asked one leave a task.
    """
    blocks = -(-asked.count() // BLOCK)
    out = None
    for b in range(max(1, blocks)):
        some = asked.where(F.pmod(F.xxhash64(id_col), F.lit(max(1, blocks))) == b).select(*(F.col(c).alias(f"asked_{c}") for c in asked.columns))
        met = rows.crossJoin(F.broadcast(some)).where(F.col(id_col) != F.col(f"asked_{id_col}")).select(F.col(f"asked_{id_col}").alias("asked"), id_col, similarity.alias("similarity"))
        found = top_k(met, ["asked"], [F.desc("similarity"), F.asc(id_col)], k)
        out = found if out is None else out.union(found)
    return out
