"""The connector over files: batches, streams that start anew, writes that run again or are aborted."""

import os

import pytest

from tarnwheel.session import scratch
from tarnwheel.sources import filestream

SCHEMA = "id long, ts timestamp, name string, parts array<int>"


def rows(spark, a, b):
    return spark.range(a, b).selectExpr("id", "timestamp_seconds(id) ts", "cast(id as string) name", "array(cast(id as int)) parts")


@pytest.fixture
def folder(spark):
    return scratch(spark, "files").removeprefix("file://")


def run(spark, source, target, offsets):
    kind = filestream.register(spark)
    stream = spark.readStream.format(kind).schema(SCHEMA).option("path", source).load()
    query = stream.writeStream.format(kind).option("path", target).option("checkpointLocation", offsets).start()
    query.processAllAvailable()
    query.stop()


def read(spark, path):
    return sorted(map(tuple, spark.read.format(filestream.register(spark)).schema(SCHEMA).option("path", path).load().collect()))


def test_batch_there_and_back(spark, folder):
    kind = filestream.register(spark)
    rows(spark, 0, 50).repartition(3).write.format(kind).option("path", folder).mode("append").save()
    rows(spark, 50, 60).write.format(kind).option("path", f"file://{folder}").mode("append").save()
    assert read(spark, folder) == sorted(map(tuple, rows(spark, 0, 60).collect()))
    assert read(spark, folder + "-none") == []
    assert spark.read.format(kind).schema("name string, id long").option("path", folder).load().where("id = 7").collect() == [("7", 7)]


def test_a_stream_goes_on_behind_its_offsets(spark, folder):
    offsets = scratch(spark, "offsets")
    for k in range(3):
        rows(spark, 20 * k, 20 * k + 20).repartition(2).write.format(filestream.register(spark)).option("path", f"{folder}/in-{k}").mode("append").save()
    # one folder, file by file; every run is a new query that has nothing but the checkpoint
    os.makedirs(f"{folder}/all")
    for k in range(3):
        spark.range(20 * k, 20 * k + 20).selectExpr("id", "timestamp_seconds(id) ts", "cast(id as string) name", "array(cast(id as int)) parts").coalesce(1).write.parquet(f"{folder}/plain-{k}")
        (part,) = [f for f in os.listdir(f"{folder}/plain-{k}") if f.endswith(".parquet")]
        os.rename(f"{folder}/plain-{k}/{part}", f"{folder}/all/{k:03d}.parquet")
        run(spark, f"{folder}/all", f"{folder}/out", offsets)
        assert read(spark, f"{folder}/out") == sorted(map(tuple, rows(spark, 0, 20 * k + 20).collect()))
    run(spark, f"{folder}/all", f"{folder}/out", offsets)
    assert len(read(spark, f"{folder}/out")) == 60


def test_a_batch_that_runs_again_counts_once(spark, folder):
    schema = rows(spark, 0, 1).schema
    writer = filestream.FilesStreamWriter(schema, {"path": folder})
    os.makedirs(folder)

    def wrote(a, b):
        class Context:
            @staticmethod
            def partitionId():
                return 0

        import pyspark

        real, pyspark.TaskContext.get = pyspark.TaskContext.get, staticmethod(Context)
        try:
            return writer.write(iter(rows(spark, a, b).toArrow().to_batches()))
        finally:
            pyspark.TaskContext.get = real

    writer.commit([wrote(0, 5), None], 0)
    writer.commit([wrote(5, 9)], 1)
    writer.commit([wrote(5, 9)], 1)  # again, after a crash behind the first
    lost = wrote(100, 200)
    writer.abort([lost, None], 2)
    assert not os.path.exists(f"{folder}/{lost.names[0]}")
    assert [r[0] for r in read(spark, folder)] == list(range(9))
