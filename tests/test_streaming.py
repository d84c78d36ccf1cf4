from pyspark.sql import functions as F

from tarnwheel.sources.tables import table
from tarnwheel.streaming import windows

SF = "/root/testdata/sf0.001"


def test_tumbling_and_sliding_agree_with_the_table(spark):
    stream, batch = windows.event_stream(spark, SF), table(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for name, slide in (("tumbling", None), ("sliding", "30 minutes")):
        windows.to_memory(windows.windowed(stream, "1 hour", slide), name)
        got = {tuple(r)[:4] for r in spark.table(name).collect()}
        want = {tuple(r)[:4] for r in windows.windowed(batch, "1 hour", slide).collect()}
        assert got <= want and len(want) - len(got) <= 12  # windows that the watermark hasn't closed


def test_sessions_and_interval_join(spark):
    stream, batch = windows.event_stream(spark, SF), table(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    windows.to_memory(windows.session_counts(stream, "30 minutes"), "sessions_seen")
    got, want = ({tuple(r) for r in df.collect()} for df in (spark.table("sessions_seen"), windows.session_counts(batch, "30 minutes")))
    assert got <= want and len(got) > 0.9 * len(want)
    pairs = lambda e: windows.interval_join(e.where("event_type = 'view'"), e.where("event_type = 'purchase'"), "user_id", "30 minutes").selectExpr("a.event_id as x", "b.event_id as y")
    windows.to_memory(pairs(stream), "pairs_seen")
    assert {tuple(r) for r in spark.table("pairs_seen").collect()} == {tuple(r) for r in pairs(batch).collect()}


def arriving(spark, path, *batches):
    """A stream whose batches hold rows of the given minutes."""
    import datetime as d
    import os

    start, schema = d.datetime(2024, 1, 1), "user_id long, ts timestamp, event_type string, value double"
    rows = lambda minutes: spark.createDataFrame([(m, start + d.timedelta(minutes=m), "click", 1.0) for m in minutes], schema)
    os.makedirs(path)
    for k, minutes in enumerate(batches):
        rows(minutes).coalesce(1).write.parquet(f"{path}-{k}")
        (part,) = [f for f in os.listdir(f"{path}-{k}") if f.endswith(".parquet")]
        os.rename(f"{path}-{k}/{part}", f"{path}/{k}.parquet")
        os.utime(f"{path}/{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))  # files are taken in order of time
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


#: Rows are late by the watermark of the batch before, which is at 85 when minute 1 comes.
LATE = ((0, 5), (90, 95), (130,), (1,), (200,))


def counted(frame):
    """The last count of each window, by the hour that it begins with."""
    last = frame.groupBy("window_start").agg(F.max(F.struct("batch", "n")).alias("s")).collect()
    return {r.window_start.hour: r.s.n for r in last}


def test_late_rows_are_dropped_and_rows_in_time_are_kept(spark, tmp_path):
    stream = arriving(spark, f"{tmp_path}/in", *LATE)
    assert counted(windows.to_files(windows.windowed(stream, "1 hour"), "late", "update")) == {0: 2, 1: 2, 2: 1, 3: 1}
    assert counted(windows.to_files(windows.windowed(stream, "1 hour", late="5 hours"), "in-time", "update")) == {0: 3, 1: 2, 2: 1, 3: 1}


def test_append_gives_closed_windows_once(spark, tmp_path):
    stream = arriving(spark, f"{tmp_path}/in", *LATE)
    got = {r.window_start.hour: r.n for r in windows.to_files(windows.windowed(stream, "1 hour"), "closed").collect()}
    assert got == {0: 2, 1: 2, 2: 1}  # the last window stays open


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    stream = arriving(spark, f"{tmp_path}/in", *LATE)
    got = [r.user_id for r in windows.to_files(windows.first_seen(stream, ("event_type",)), "firsts").collect()]
    assert len(got) == 2 and 200 in got and got[0] in (0, 5, 200)


def test_state_is_carried_from_batch_to_batch(spark, tmp_path):
    stream = arriving(spark, f"{tmp_path}/in", (7, 7), (8,), (7,)).withColumn("user_id", F.col("user_id"))
    got = windows.to_files(windows.running_totals(stream), "totals", "update").orderBy("batch").collect()
    assert [(r.user_id, r.n, r.total) for r in got] == [(7, 2, 2.0), (8, 1, 1.0), (7, 3, 3.0)]
