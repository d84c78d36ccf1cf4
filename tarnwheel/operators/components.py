"""Connected components of a graph of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwheel.session import Held


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star method over edges (a, b), a > b; a row can come out more than once."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    if large:  # each node sends its larger neighbours to the least of its neighbourhood, which its smaller ones alone decide
        return edges.join(least.withColumnRenamed("a", "u"), F.col("b") == F.col("u"), "left").select("a", F.coalesce("m", "b").alias("b"))
    sent = F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("s")  # each node sends its smaller neighbours and itself there
    return edges.join(least, "a").select(sent).where("s.b > s.m").select(F.col("s.b").alias("a"), F.col("s.m").alias("b"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node of the distinct edges has two lesser neighbours, or a lesser and a larger one."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("n"), F.lit(0).alias("larger")), F.struct(F.col("b").alias("node"), F.lit(0).alias("n"), F.lit(1).alias("larger"))))
    nodes = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.n").alias("n"), F.max("e.larger").alias("larger"))
    return nodes.where("n > 1 or n = 1 and larger = 1").isEmpty()


def components(edges: DataFrame, held: Held | None = None) -> DataFrame:
    """Links (a, b) of comparable ids to (node, root): the least node of each node's component; roots have no row.

    Alternating large and small stars until there are only stars left; every round is written to the shared folder, and
    the rounds grow with the logarithm of the number of nodes. The rounds' tables belong to `held`.
    """
    held = held or Held(edges.sparkSession)
    now = held(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(now):
        now = held(_star(_star(now, True), False).distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
