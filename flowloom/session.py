"""Sessions for local runs, and the shared folder that jobs write between steps."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# What a task of a scan takes of a file at most, whole row groups aside.
SCAN_BYTES = str(8 << 20)
# Rows of a file that is written, and so of a row group.
FILE_ROWS = str(100_000)


def local_session(app: str = "flowloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    width = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators are planned for; returns the session.

    Wide projections (45 columns in, 27 out) generate one method too long for the
    JVM to compile, which then runs interpreted. The limit makes Spark generate many
    short methods for those projections instead, two to three times faster.

    Flows and messages take ten times the room in a task that they take in a Parquet file, so
    scans are cut smaller than Spark's 128 MB: what a task caches or scores stays the same
    however large the table. A row group is read whole, and one of messages that look alike
    holds hundreds of thousands of them in a few MB, so the rows of a file are bounded, too.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.files.maxPartitionBytes", SCAN_BYTES)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", FILE_ROWS)
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="flowloom-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return _local_folder()


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/flowloom/{label}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete what was written below a path, on whatever store it lies; nothing there is fine."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, on whatever store; none if it is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    return [status.getPath().getName() for status in store.listStatus(place)]


def input_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table: another value once it has changed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted(
        (s.getPath().getName(), s.getLen(), s.getModificationTime())
        for s in store.listStatus(place)
    ))
