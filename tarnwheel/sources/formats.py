"""Files other than the tables: reading with a stated schema, writing partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("parquet", "orc", "csv", "json", "text", "xml", "avro")
#: Formats whose schema would be inferred by reading everything twice.
STATED = ("csv", "json", "xml")


def read(spark: SparkSession, path: str, kind: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Reads a folder; csv, json and xml (option rowTag) need a schema, since inferring one reads everything twice.

    Avro needs Spark's own module for it on the class path; Spark says so where it is missing.
    """
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind}")
    if kind in STATED and schema is None:
        raise ValueError(f"{kind} needs a schema")
    reader = spark.read.format(kind).options(**({"header": "true"} if kind == "csv" else {}) | options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write(df: DataFrame, path: str, kind: str, by: list[str] | None = None, mode: str = "error", **options) -> None:
    """Writes a folder, in one folder for each value of `by`."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind}")
    writer = df.write.format(kind).mode(mode).options(**({"header": "true"} if kind == "csv" else {}) | options)
    (writer.partitionBy(*by) if by else writer).save(path)
