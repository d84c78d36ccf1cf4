"""Tables in buckets: written once, dealt and sorted by their keys, and joined on them without an exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tarnwheel.session import scratch


def bucketed(df: DataFrame, by: list[str], buckets: int, name: str = "bucketed") -> DataFrame:
    """df as a table of `buckets` buckets by the columns `by`, each sorted by them; files in the shared folder.

    The rows are dealt by the same hash before they are written, so each bucket is one file. The table is in the
    session's catalog under a name of its own; `drop` takes it out and deletes the files.
    """
    spark = df.sparkSession
    table = f"tarnwheel_{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).format("parquet")
    writer.option("path", scratch(spark, name)).saveAsTable(table)
    return spark.table(table)


def merged_join(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """A join of two bucketed tables by merging their buckets; no side is broadcast, none is dealt anew."""
    return left.hint("merge").join(right.hint("merge"), by, how)


def drop(spark: SparkSession, prefix: str = "tarnwheel_") -> None:
    """Takes this library's bucketed tables out of the catalog; their files are below the shared folder."""
    for t in spark.catalog.listTables():
        if t.name.startswith(prefix) and not t.isTemporary:
            spark.sql(f"DROP TABLE `{t.name}`")
