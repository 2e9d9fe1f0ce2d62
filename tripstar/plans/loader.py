"""Raw load, a month as one commit.

The reference appends every batch and keeps a month checkpoint file, so a crash
inside a month re-appends its first batches on resume.  Here a load writes its rows
to a folder of its own, ``data/load=<id>``, and then one manifest file with a row for
every month it holds: load id, rows, files.  A month *is* what its newest manifest
row says; reads go through the manifests.

* A crash before the manifest leaves rows that nobody reads; the month stays pending
  and the next run loads it.
* Loading a month again adds a manifest; the month changes over in one step.
* Two loaders of one month write two folders; the later manifest counts, and rows of
  the two never mix.
* The load log (rows per service and month) is the manifests themselves, so log and
  rows cannot disagree.  The month plan (L1) is the planned months without one.

Folders that no month refers to any more are removed by :func:`remove_unused_loads`.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, PipelineConfig
from ..operators.loads import month_plan
from ..schemas import RAW_ZONES, raw_schema
from ..session import COMPRESSION, MONTHS_OPEN, OPEN_FILES, remove_path, sql_setting, write_unsorted
from ..sources.monthly import MonthRead, list_month_files, read_months


@dataclass
class LoadResult:
    service: str
    months_loaded: int
    dropped_columns: dict[str, list[str]]
    unplanned_files: list[str]  # month files outside the planned range, not loaded


MANIFEST_SCHEMA = ("service_type string, year int, month int, load string, rows long, run_id long, loaded_at long, "
                   "written_at long, files array<string>")
LOG_COLUMNS = ["rows", "run_id", "loaded_at", "service_type", "year", "month"]


def raw_table_path(raw_root: str, service: str) -> str:
    return f"{raw_root.rstrip('/')}/raw_{service}"


def data_path(raw_root: str, service: str) -> str:
    return f"{raw_table_path(raw_root, service)}/data"


def manifests(spark: SparkSession, raw_root: str, service: str) -> DataFrame:
    """All manifest rows of a service; empty as long as nothing was loaded.  Other errors are raised."""
    path = f"{raw_table_path(raw_root, service)}/manifest"
    try:
        return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def current_months(spark: SparkSession, raw_root: str, service: str) -> DataFrame:
    """The newest manifest row of every month."""
    rows = manifests(spark, raw_root, service)
    rest = [c for c in rows.columns if c not in ("year", "month", "written_at", "load")]
    newest = rows.groupBy("year", "month").agg(F.max(F.struct("written_at", "load", *rest)).alias("m"))
    return newest.select("year", "month", "m.*").select(*rows.columns)


def read_raw(spark: SparkSession, raw_root: str, service: str) -> DataFrame:
    """Raw table with the canonical schema: the rows of the months' current loads.

    One path per month reaches the planner (bounded by the planned months).
    """
    schema, root = raw_schema(service), data_path(raw_root, service)
    months = current_months(spark, raw_root, service).where("rows > 0").select("load", "year", "month").collect()
    paths = [f"{root}/load={m['load']}/YEAR={m['year']}/MONTH={m['month']}" for m in months]
    if not paths:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).option("basePath", root).parquet(*paths)
    return df.select(*[F.col(f.name) for f in schema.fields])


def read_log(spark: SparkSession, raw_root: str) -> DataFrame:
    """L2: what is loaded, from the manifests."""
    logs = [current_months(spark, raw_root, s).select(*LOG_COLUMNS) for s in DEFAULT.services]
    return reduce(DataFrame.unionByName, logs)


def raw_version(spark: SparkSession, raw_root: str) -> str:
    """Identity of the raw tables: the current loads and the zone rows."""
    loads = [tuple(r) for s in DEFAULT.services for r in
             current_months(spark, raw_root, s).select("service_type", "year", "month", "load").collect()]  # a row per month
    zones = spark.read.parquet(f"{raw_root.rstrip('/')}/raw_zones")
    zones = zones.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*zones.columns).cast("decimal(38,0)"))).first()
    return hashlib.md5(repr((sorted(loads), tuple(zones))).encode()).hexdigest()


def write_manifest(spark: SparkSession, raw_root: str, service: str, load: str, files: list[str], load_time_ns: int) -> None:
    """Makes a load current: one file with a row per month, counted in what was written."""
    schema = raw_schema(service)
    written = spark.read.schema(schema).parquet(f"{data_path(raw_root, service)}/load={load}")
    counts = written.groupBy(F.col("YEAR").cast("int").alias("year"), F.col("MONTH").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("RUN_ID").alias("run_id"))
    by_month: dict[tuple[int, int], list[str]] = {}
    for f in files:
        by_month.setdefault(year_month(f), []).append(f)
    months = spark.createDataFrame([(*m, sorted(fs)) for m, fs in by_month.items()], "year int, month int, files array<string>")
    rows = months.join(counts, ["year", "month"], "left").select(
        F.lit(service).alias("service_type"), "year", "month", F.lit(load).alias("load"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "run_id", F.lit(load_time_ns).cast("long").alias("loaded_at"),
        F.lit(time.time_ns()).cast("long").alias("written_at"), "files")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{raw_table_path(raw_root, service)}/manifest/{load}")


def load_files(spark: SparkSession, raw_root: str, service: str, files: list[str], cfg: PipelineConfig = DEFAULT,
               load_time_ns: int | None = None, load: str | None = None) -> tuple[MonthRead, int]:
    """One load: rows first, the manifest last.  Returns the read and the rows loaded.

    A load that is repeated under the same id (a replayed stream batch) replaces itself.
    """
    load_time_ns = load_time_ns or time.time_ns()
    load = load or f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    read = read_months(spark, files, service, cfg, load_time_ns, registry=f"{raw_root.rstrip('/')}/file_schemas")
    path = f"{data_path(raw_root, service)}/load={load}"
    observed = Observation(f"load-{load}-{time.time_ns()}")
    rows = read.frame.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", COMPRESSION)
    # a task reads few months; a file for each stays open, so rows are not sorted by month
    with sql_setting(spark, OPEN_FILES, MONTHS_OPEN):
        write_unsorted(writer.partitionBy("YEAR", "MONTH"), path)
    write_manifest(spark, raw_root, service, load, files, load_time_ns)
    return read, int(observed.get.get("rows") or 0)


def remove_unused_loads(spark: SparkSession, raw_root: str, service: str, grace_seconds: int = 86_400) -> list[str]:
    """Removes folders of loads that no month refers to: replaced ones at once, loads
    without a manifest (crashed, or still running) when they began longer ago than
    ``grace_seconds``."""
    used = {r["load"] for r in current_months(spark, raw_root, service).select("load").distinct().collect()}
    done = {r["load"] for r in manifests(spark, raw_root, service).select("load").distinct().collect()}
    root = spark._jvm.org.apache.hadoop.fs.Path(data_path(raw_root, service))
    folders = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    removed = []
    for load in sorted(f.getPath().getName().removeprefix("load=") for f in folders):
        begun = load.split("-")[0]
        stale = begun.isdigit() and int(begun) < time.time_ns() - grace_seconds * 1_000_000_000
        if load not in used and (load in done or stale):
            remove_path(spark, f"{data_path(raw_root, service)}/load={load}")
            removed.append(load)
    return removed


def load_service(
    spark: SparkSession,
    source_root: str,
    raw_root: str,
    service: str,
    cfg: PipelineConfig = DEFAULT,
    load_time_ns: int | None = None,
    only_pending: bool = True,
) -> LoadResult:
    """Load the month files of ``service``; re-running is a no-op for the data."""
    load_time_ns = load_time_ns or time.time_ns()
    files = list_month_files(spark, source_root, service)
    # Only planned months (first..last) are ever loaded.
    unplanned = [f for f in files if not cfg.first_month <= year_month(f) <= cfg.last_month]
    files = [f for f in files if f not in unplanned]
    if only_pending:
        pending = {
            (r["year"], r["month"])
            for r in month_plan(spark, read_log(spark, raw_root), [service], cfg).collect()
        }  # bounded: at most one row per planned month
        files = [f for f in files if year_month(f) in pending]
    if not files:
        return LoadResult(service, 0, {}, unplanned)
    read, _ = load_files(spark, raw_root, service, files, cfg, load_time_ns)
    return LoadResult(service, len(files), read.dropped_columns, unplanned)


def year_month(path: str) -> tuple[int, int]:
    stem = path.rsplit("/", 1)[-1].split("_tripdata_")[1].split(".")[0]
    y, m = stem.split("-")
    return int(y), int(m)


def load_zones(spark: SparkSession, csv_path: str, raw_root: str) -> DataFrame:
    """The zone lookup is replaced, never appended, so a rerun cannot double it."""
    from ..sources.samples import read_zone_csv

    zones = read_zone_csv(spark, csv_path)
    path = f"{raw_root.rstrip('/')}/raw_zones"
    zones.write.mode("overwrite").parquet(path)
    return spark.read.schema(RAW_ZONES).parquet(path)
