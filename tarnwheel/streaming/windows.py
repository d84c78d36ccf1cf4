"""Windowed aggregates that run on a stream and on a table alike."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tarnwheel.session import scratch


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream; times as timestamps, which watermarks need."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, length: str, slide: str | None = None, late: str = "10 minutes", by: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Counts and sums by tumbling (or, with slide, hopping) windows; rows later than `late` are dropped on a stream."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    out = timed.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "total")


def session_counts(events: DataFrame, gap: str, late: str = "10 minutes", by: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Rows in each session of a key."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    out = timed.groupBy(*by, F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n"))
    return out.select(*by, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def first_seen(events: DataFrame, by: tuple[str, ...], late: str = "10 minutes") -> DataFrame:
    """One row for each key within the watermark's delay."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([*by])


def interval_join(left: DataFrame, right: DataFrame, by: str, within: str, late: str = "10 minutes") -> DataFrame:
    """Pairs of a key whose right time is at most `within` after the left one; both sides watermarked on a stream."""
    a = (left.withWatermark("ts", late) if left.isStreaming else left).alias("a")
    b = (right.withWatermark("ts", late) if right.isStreaming else right).alias("b")
    return a.join(b, F.expr(f"a.{by} = b.{by} and b.ts >= a.ts and b.ts <= a.ts + interval {within}"))


def to_memory(df: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """Runs what there is into a table in memory."""
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def running_totals(events: DataFrame) -> DataFrame:
    """State of one's own: each user's rows and sum of values so far, a row whenever they change (update mode)."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for batch in batches:
            n, total = n + len(batch), total + float(batch["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [total]})

    return events.groupBy("user_id").applyInPandasWithState(run, "user_id long, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def to_files(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs what there is into Parquet files in the shared folder, and reads them.

    Append writes rows as they are final; complete keeps the last result only; update keeps every change, with the
    number of its batch in the column `batch`.
    """
    spark = df.sparkSession
    path, offsets = scratch(spark, name), scratch(spark, f"{name}-offsets")

    def put(batch: DataFrame, number: int) -> None:
        if mode == "update":
            batch = batch.withColumn("batch", F.lit(number))
        # a batch that runs again writes over what it wrote
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}" if mode == "append" else f"{path}/n={number}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", offsets).trigger(availableNow=True)
    writer.foreachBatch(put).start().awaitTermination()
    schema = df.schema.add("batch", T.IntegerType()) if mode == "update" else df.schema
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
