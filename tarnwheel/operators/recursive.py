"""Recursion over tables: semi-naive evaluation, each round's new rows a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwheel.session import Held, scratch


def reach(start: DataFrame, edges: DataFrame, most: int | None = None, parts: int | None = None) -> DataFrame:
    """(node, depth): the nodes that can be reached from `start` (node) along `edges` (src, dst), and in how many steps at least.

    Each round joins only the last round's new nodes with the edges, drops what is known, and appends the rest to a table;
    the driver learns no more than whether there was any. Cycles end by themselves; `most` bounds the steps. Edges are
    written once, dealt and sorted by src, so the rounds read them as they are. A null node or end of an edge leads nowhere.
    """
    spark = start.sparkSession
    held = Held(spark)
    path = scratch(spark, "reached")
    steps = held(edges.where("src is not null and dst is not null").select("src", "dst").distinct(), "edges")
    new, depth = start.where("node is not null").select("node").distinct(), 0
    while True:
        at = f"{path}/depth={depth}"
        new.write.parquet(at)
        now = spark.read.schema(new.schema).parquet(at)
        if now.isEmpty() or (most is not None and depth >= most):
            break
        known = spark.read.option("basePath", path).schema(new.schema).parquet(*(f"{path}/depth={d}" for d in range(depth + 1)))
        further = now.join(steps, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        new, depth = further.join(known.select("node"), "node", "left_anti"), depth + 1
    held.release()
    schema = start.select("node", F.lit(0).alias("depth")).schema
    return spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/depth={d}" for d in range(depth + 1)))
