"""Processors with state, timers and time to live, against the batch operators."""

from pyspark.sql import functions as F

from tarnwheel.plans import catalog
from tarnwheel.session import scratch
from tarnwheel.streaming import stateful

SF = "/root/testdata/sf0.001"
#: Minutes since the epoch, where watermarks begin.
BASE = 10_000


def rows(df):
    return sorted((r.user_id, r.session_start, r.session_end, r.n) for r in df.collect())


def test_sessions_as_in_batch(spark):
    assert rows(catalog.QUERIES["q_stream_sessions"](spark, SF)) == rows(catalog.QUERIES["q_sessions"](spark, SF))


def stream(spark, batches):
    """Each batch of (user, minute) is a file of its own, taken by itself."""
    path = scratch(spark, "late")
    for k, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "user_id long, m long").select("user_id", F.timestamp_seconds((F.col("m") + BASE) * 60).alias("ts"))
        df.coalesce(1).write.parquet(f"{path}/{k}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def found(df):
    return sorted((r.user_id, int(r.session_start.timestamp()) // 60 - BASE, int(r.session_end.timestamp()) // 60 - BASE, r.n, r.closed) for r in df.collect())


def test_late_rows_join_or_bridge_or_are_dropped(spark):
    batches = [
        [(1, 0), (1, 10), (2, 0)],
        [(1, 45), (3, 60)],  # the watermark goes to 50
        [(1, 52), (2, 51)],
        [(1, 81), (1, 5), (3, 200)],  # 5 is too late, by the watermark of the batch before; it goes to 190
        [(4, 195)],
        [(2, 100), (4, 199)],  # 100 is too late
    ]
    got = found(stateful.run_sessions(stream(spark, batches), "30 minutes"))
    assert got == [(1, 0, 40, 2, True), (1, 45, 111, 3, True), (2, 0, 30, 1, True), (2, 51, 81, 1, True), (3, 60, 90, 1, True), (3, 200, 230, 1, False), (4, 195, 229, 2, False)]


def test_a_row_between_two_open_sessions_bridges_them(spark):
    got = found(stateful.run_sessions(stream(spark, [[(1, 0), (1, 40)], [(1, 20), (None, 1)]]), "30 minutes", late="2 hours"))
    assert got == [(1, 0, 70, 3, False)]


def test_first_rows_with_time_to_live(spark):
    df = stream(spark, [[(1, 5), (2, 7)], [(1, 9), (3, 1)]])
    path = scratch(spark, "first")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # in processing time there is always another batch
    try:
        query = stateful.first_in(df, "user_id", ["user_id", "ts"], "1 hour").writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch(spark, "first-state")).trigger(availableNow=True).start()
        assert query.awaitTermination(60)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    got = sorted((r.user_id, int(r.ts.timestamp()) // 60 - BASE) for r in spark.read.parquet(path).collect())
    assert [u for u, _ in got] == [1, 2, 3] and got[1:] == [(2, 7), (3, 1)] and got[0][1] in (5, 9)


class Calls:
    """A state store of one key that counts what is asked of it."""

    def __init__(self):
        self.n, self.lists, self.timers = 0, {}, set()

    def getListState(self, name, schema):
        calls = self

        class State:
            def get(self):
                calls.n += 1
                return iter(calls.lists.get(name, []))

            def put(self, rows):
                calls.n += 1
                calls.lists[name] = [tuple(x) for x in rows]

            def clear(self):
                calls.n += 1
                calls.lists[name] = []

        return State()

    def registerTimer(self, t):
        self.n += 1
        self.timers.add(t)

    def deleteTimer(self, t):
        self.n += 1
        self.timers.remove(t)


def test_calls_of_state_do_not_go_with_sessions():
    from types import SimpleNamespace

    import pandas as pd

    calls, minute = Calls(), 60_000_000
    p = stateful._Sessions("user_id", "long", 30 * minute)
    p.init(calls)
    rows = [(u, k * 60 * minute) for u in (7, 5) for k in range(500)]
    list(p.handleInputRows((1,), iter([pd.DataFrame(rows[k::3], columns=["user_id", "at"]) for k in range(3)]), None))
    mark = 400 * 3_600_000 + 1
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
    found = []
    while calls.timers and min(calls.timers) <= mark:
        due = min(calls.timers)
        calls.timers.remove(due)
        found += [tuple(r) for df in p.handleExpiredTimer((1,), times, SimpleNamespace(getExpiryTimeInMs=lambda: due)) for r in df.itertuples(index=False)]
    assert sorted(found) == [(u, k * 60 * minute, k * 60 * minute, 1, k + 1) for u in (5, 7) for k in range(400)]
    assert len(calls.lists["open"]) == 200 and calls.timers == {400 * 3_600_000 + 1_800_000}
    assert calls.n < 12
