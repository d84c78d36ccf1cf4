"""Stateful processors with several state variables, timers and time to live, on the RocksDB state store.

`closed_sessions` deals keys into BUCKETS, and keeps a bucket's open sessions and its keys' numbers of closed ones in lists;
an event-time timer fires when the watermark passes the earliest end in a bucket, and closes all that is over. So calls to the
state store go with the buckets of a batch, not with its sessions. `open_sessions` reads what is still open from the
checkpoint by the state data source, so a stream that was run to its end loses nothing. `first_in` keeps a mark with a time to
live for each key, in processing time, which is where Spark has it.

Late rows: one later than the watermark of the batch before is dropped by the engine; another joins or bridges sessions
that are open.
A session ends where the next row of its key is `gap` or more away, as in `operators.temporal.sessions`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tarnwheel.session import scratch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State keys of `closed_sessions`; a checkpoint goes with the number it was made with.
BUCKETS = 1024


class _Sessions(StatefulProcessor):
    """One bucket of keys. Times are whole microseconds; `open` has (id, first, last, n) of each open session, a key's apart by
    `gap` or more; `closed` has each key's number of closed ones. One timer stands, for the bucket's earliest end."""

    def __init__(self, key: str, kind: str, gap: int):
        self.key, self.kind, self.gap = key, kind, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", f"id {self.kind}, first long, last long, n long")
        self.closed = handle.getListState("closed", f"id {self.kind}, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = list(self.open.get())
        old = pd.DataFrame(found, columns=["id", "first", "last", "n"])
        seen = [pd.DataFrame({"id": batch[self.key], "first": batch["at"], "last": batch["at"], "n": 1}) for batch in rows]
        both = pd.concat([*([old] if found else []), *seen], ignore_index=True)
        code = pd.factorize(both["id"], use_na_sentinel=False)[0]
        order = np.lexsort((both["first"].to_numpy(np.int64), code))
        both, code = both.iloc[order], code[order]
        first, n = both["first"].to_numpy(np.int64), both["n"].to_numpy(np.int64)
        last = both["last"].astype(np.int64).groupby(code).cummax().to_numpy()
        new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (first[1:] - last[:-1] >= self.gap)]))
        ends = last[np.append(new[1:], len(last)) - 1]
        self.open.put(list(zip(both["id"].iloc[new].tolist(), first[new].tolist(), ends.tolist(), np.add.reduceat(n, new).tolist(), strict=True)))
        due, before = self._timer(int(ends.min())), self._timer(min(int(x[2]) for x in found)) if found else None
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(due)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        over, left = [], []
        for x in self.open.get():
            (over if x[2] + self.gap <= now else left).append(x)
        if left:
            self.open.put(left)
            self.handle.registerTimer(self._timer(min(int(x[2]) for x in left)))
        else:
            self.open.clear()
        if over:
            counts, number = dict(self.closed.get()), []
            for x in over:  # a key's sessions stand in the order of time
                counts[x[0]] = counts.get(x[0], 0) + 1
                number.append(counts[x[0]])
            self.closed.put(list(counts.items()))
            yield pd.DataFrame({self.key: [x[0] for x in over], "first": [x[1] for x in over], "last": [x[2] for x in over], "n": [x[3] for x in over], "number": number})

    def _timer(self, last: int) -> int:
        """The millisecond at or after a session's end."""
        return -(-(last + self.gap) // 1000)

    def close(self) -> None:
        pass


class _First(StatefulProcessor):
    def __init__(self, columns: list[str], ttl: int):
        self.columns, self.ttl = columns, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean", self.ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        for batch in rows:
            if not known and len(batch):
                known = True
                self.seen.update((True,))
                yield batch[self.columns].head(1)

    def close(self) -> None:
        pass


def _micros(gap: str) -> int:
    return int(pd.Timedelta(gap) / pd.Timedelta(1, "us"))


def _rocksdb(spark: SparkSession) -> None:
    """The provider that these processors need; a provider of the user's own stays."""
    if spark.conf.get(PROVIDER, "").rpartition(".")[2] in ("", "HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)


def closed_sessions(events: DataFrame, gap: str, late: str = "10 minutes", by: str = "user_id", time: str = "ts") -> DataFrame:
    """(by, first, last, n, number) of sessions as the watermark closes them; times in microseconds, number counts a key's closed ones."""
    _rocksdb(events.sparkSession)
    kind = events.schema[by].dataType.simpleString()
    timed = events.where(F.col(by).isNotNull() & F.col(time).isNotNull()).select(by, F.col(time), F.unix_micros(time).alias("at"), F.pmod(F.xxhash64(by), F.lit(BUCKETS)).alias("_bucket")).withWatermark(time, late)
    return timed.groupBy("_bucket").transformWithStateInPandas(_Sessions(by, kind, _micros(gap)), f"`{by}` {kind}, first long, last long, n long, number int", "Append", "EventTime")


def first_in(events: DataFrame, by: str, columns: list[str], ttl: str) -> DataFrame:
    """The first row of each key, and again the first one once `ttl` of processing time has passed since that.

    In processing time the engine always has another batch: run it with a trigger of its own, or with
    spark.sql.streaming.noDataMicroBatches.enabled off where it should end with the data.
    """
    _rocksdb(events.sparkSession)
    schema = ", ".join(f"`{c}` {events.schema[c].dataType.simpleString()}" for c in columns)
    return events.groupBy(by).transformWithStateInPandas(_First(columns, _micros(ttl) // 1000), schema, "Append", "ProcessingTime")


def run_sessions(events: DataFrame, gap: str, late: str = "10 minutes", by: str = "user_id", time: str = "ts") -> DataFrame:
    """All sessions of a stream that is run to what there is: (by, session_start, session_end, n, closed).

    Closed ones come from the stream's output, those that are still open from its state.
    """
    spark = events.sparkSession
    path, checkpoint = scratch(spark, "sessions"), scratch(spark, "sessions-state")
    sessions = closed_sessions(events, gap, late, by, time)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")  # a batch that runs again writes over what it wrote

    sessions.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start().awaitTermination()
    closed = spark.read.schema(sessions.schema).option("recursiveFileLookup", "true").parquet(path).select(by, "first", "last", "n", F.lit(True).alias("closed"))
    found = closed.union(open_sessions(spark, checkpoint, by).select(by, "first", "last", "n", F.lit(False)))
    return found.select(by, F.timestamp_micros("first").alias("session_start"), F.timestamp_micros(F.col("last") + _micros(gap)).alias("session_end"), "n", "closed")


def open_sessions(spark: SparkSession, checkpoint: str, by: str = "user_id") -> DataFrame:
    """(by, first, last, n) of the sessions that a checkpoint holds open."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "open").load()
    x = F.col("list_element") if "list_element" in state.columns else F.explode("list_value")
    return state.select(x.alias("x")).select(F.col("x.id").alias(by), "x.first", "x.last", "x.n")
