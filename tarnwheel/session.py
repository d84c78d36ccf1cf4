"""Session helpers: building a local session, finding the folder that the whole cluster shares."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent


def local_session(cpus: int = 8, memory: str = "20g", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarnwheel")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a new temporary one where that is unset in a local run."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        path = Path(tempfile.mkdtemp(prefix="tarnwheel-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Paths that this driver has handed out, oldest first.
_handed_out: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/tarnwheel/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def marked() -> int:
    """How many paths have been handed out, for `sweep`."""
    return len(_handed_out)


def sweep(spark: SparkSession, since: int, keep: DataFrame) -> None:
    """Deletes what was written below paths handed out after `since`, but for the files of the table `keep`.

    To be called when nothing that is still to be computed reads them.
    """
    files = [Path(f).parent.name for f in keep.inputFiles()]
    for path in _handed_out[since:]:
        if path.rsplit("/", 1)[1] not in files:
            remove(spark, path)


class Held:
    """Tables of one operator: each is written to the shared folder and read back, and goes when nothing needs it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[tuple[str, DataFrame]] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((path, table))
        return table

    def release(self, *keep: DataFrame) -> None:
        """Deletes the tables, but for those that are read by `keep`."""
        files = {Path(f).parent.name for df in keep for f in df.inputFiles()}
        for path, _ in self.tables:
            if path.rsplit("/", 1)[1] not in files:
                remove(self.spark, path)
        self.tables.clear()


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, which cuts its lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path below the shared folder, by Hadoop's own file system for it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Arrow batches for Python workers, where the session has Spark's defaults (10,000 rows, 64 MB): a worker holds some
#: copies of a batch, and the JVM buffers of its size beside the heap.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors unless their PYTHONPATH or working folder has it; keeps Arrow batches small.

    BATCH holds for the session from then on, as what a query returns runs later; settings of the user's own stay.
    """
    for key, (usual, ours) in BATCH.items():
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, ours)
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")]
    if any(p and Path(p).resolve() == ROOT for p in known) or getattr(spark.sparkContext, "_tarnwheel_sent", False):
        return
    target = Path(tempfile.mkdtemp(prefix="tarnwheel-")) / "tarnwheel.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in (ROOT / "tarnwheel").rglob("*.py"):
            out.write(source, source.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(target))
    spark.sparkContext._tarnwheel_sent = True
