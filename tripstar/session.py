"""Spark session helpers.

The library never depends on the session time zone: wall-clock timestamps are
``timestamp_ntz`` and zone conversions name their zones explicitly.  The
settings below only tune execution (AQE, skew joins, partition sizing).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrameWriter, SparkSession

# Execution settings applied to every session the library builds.  They are
# all safe on a cluster: AQE re-plans joins from runtime sizes, coalesces small
# shuffle partitions and splits skewed ones.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}

# Parquet codec of the tables the library writes: trip ids and money take about two
# thirds of what they take with snappy.
COMPRESSION = "zstd"
# Months that one task writes at the same time; rows of further ones are sorted by month first.
MONTHS_OPEN = "24"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# A statement's shuffle files go when it ends, not when the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app: str = "tripstar",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file
    system); without it this raises, since a folder of one machine would lose
    data.  Only a local master, as in tests, gets a scratch folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tripstar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return context.getCheckpointDir().rstrip("/")


@contextmanager
def sql_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the block; it is what it was afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_unsorted(writer: DataFrameWriter, path: str) -> None:
    """Parquet by partition columns, with a file open for each of up to ``OPEN_FILES`` of a task's partitions.

    Spark sorts the rest of a task's rows as soon as that many are open, so one more is allowed here.
    """
    spark = writer._spark
    with sql_setting(spark, OPEN_FILES, str(int(spark.conf.get(OPEN_FILES)) + 1)):
        writer.parquet(path)


# --- intermediate tables ------------------------------------------------------------
_OPEN_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under :func:`checkpoint_dir` for an intermediate table.

    Inside a :func:`scratch_tables` block it is removed at the end of the block;
    outside, it stays until the caller's checkpoint folder is cleaned.
    """
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _OPEN_SCOPES:
        _OPEN_SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables made inside the block when it ends, and the shuffle
    files of each statement in it as soon as that ends.

    For code that writes its result inside the block: DataFrames that still read an
    intermediate table, or a shuffle, must not leave it.
    """
    _OPEN_SCOPES.append([])
    try:
        with sql_setting(spark, DROP_SHUFFLES, "true"):
            yield
    finally:
        for path in _OPEN_SCOPES.pop():
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it is; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
