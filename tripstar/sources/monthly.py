"""Monthly trip files -> canonical raw rows.

Files are named ``{service}_tripdata_{yyyy}-{mm}.parquet``.  Column names and
types drift between months (a count stored as bigint one month and double the
next, ``airport_fee`` vs ``Airport_fee``, an extra ``cbd_congestion_fee``), and
one Parquet scan over files with conflicting types fails.  So files are
grouped by their schema, each group is read with **one** scan (all its months
in parallel tasks), projected onto the canonical raw schema, and the groups
are unioned by name.  Missing columns become null.  An unknown column stops a
yellow load, whose table is declared; a green load drops and reports it.

Load metadata (C1) is derived per row, without a driver loop: year and month
from the file name, the batch label from ``_metadata.row_index`` (batches of
``batch_rows`` rows counted from 1 in each file), a deterministic run id
(months since the first planned month, plus one) and the load time passed in.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, PipelineConfig
from ..functions.timecols import epoch_ntz, month_index
from ..schemas import LOAD_METADATA, raw_schema

DRIFT_COLUMNS_TO_DROP = ("cbd_congestion_fee",)
# Services whose raw table takes no column beyond its declaration.
STRICT_SERVICES = ("yellow",)
FILE_NAME_PATTERN = r"^(yellow|green)_tripdata_(\d{4})-(\d{2})\.parquet$"


class UnknownColumnsError(ValueError):
    """A month file holds columns that the declared raw table does not have."""


@dataclass
class MonthRead:
    frame: DataFrame
    dropped_columns: dict[str, list[str]]  # file -> unknown columns that were dropped
    files: list[str]


def list_month_files(spark: SparkSession, root: str, service: str) -> list[str]:
    """Month files of ``service`` directly under ``root`` (any file system).

    Listed with the ``binaryFile`` source, selecting only the path (file
    contents are not read); at most one row per month file reaches the driver.
    A folder that does not exist raises.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{service}_tripdata_*.parquet")
        .load(root)
        .select("path")
    )
    paths = [r.path for r in listing.collect()]
    pattern = re.compile(FILE_NAME_PATTERN)
    return sorted(p for p in paths if pattern.match(p.rsplit("/", 1)[-1]))


def file_schemas(spark: SparkSession, files: list[str], workers: int = 16) -> list[T.StructType]:
    """Each file's own schema (footer reads).  Every inference is a small Spark
    job; they are independent, so they are submitted concurrently."""
    if not files:
        return []
    with ThreadPoolExecutor(max_workers=min(workers, len(files))) as pool:
        return list(pool.map(lambda f: spark.read.parquet(f).schema, files))


REGISTRY_SCHEMA = "file string, length long, modified timestamp, schema string"


def schema_registry(spark: SparkSession, registry: str) -> DataFrame:
    """(file, length, modified, schema): the schemas of all month files seen so far."""
    try:
        return spark.read.schema(REGISTRY_SCHEMA).option("recursiveFileLookup", "true").parquet(registry)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def registered_schemas(spark: SparkSession, files: list[str], registry: str) -> list[T.StructType]:
    """Schemas of ``files`` from the registry; only files that are new or changed
    (by length or modification time) have their footer read, and are added."""
    if not files:
        return []
    listing = spark.read.format("binaryFile").load(files).select(
        F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    known = listing.join(schema_registry(spark, registry), ["file", "length", "modified"], "left").groupBy(
        "file", "length", "modified").agg(F.max("schema").alias("schema")).collect()  # a row per file
    new = [r for r in known if r["schema"] is None]
    found = {r["file"]: r["schema"] for r in known}
    if new:
        read = file_schemas(spark, [r["file"] for r in new])
        found.update({r["file"]: schema.json() for r, schema in zip(new, read, strict=True)})
        rows = [(r["file"], r["length"], r["modified"], found[r["file"]]) for r in new]
        spark.createDataFrame(rows, REGISTRY_SCHEMA).coalesce(1).write.parquet(f"{registry}/{uuid.uuid4().hex[:12]}")
    # the listing may spell a local path with or without its scheme
    by_path = {_plain_path(f): text for f, text in found.items()}
    return [T.StructType.fromJson(json.loads(by_path[_plain_path(f)])) for f in files]


def _plain_path(path: str) -> str:
    return path.removeprefix("file:").lstrip("/")


def schema_drift(spark: SparkSession, registry: str) -> DataFrame:
    """How many of the latest files of a service store a column as which type."""
    rows = schema_registry(spark, registry)
    latest = rows.groupBy("file").agg(F.max(F.struct("modified", "schema")).alias("r")).select("file", "r.schema")
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    fields = F.from_json("schema", "fields array<struct<name string, type string>>")["fields"]
    cells = latest.select(F.regexp_extract(name, FILE_NAME_PATTERN, 1).alias("service"), F.explode(fields).alias("f"))
    return cells.groupBy("service", F.upper("f.name").alias("column"), F.col("f.type").alias("type")).agg(F.count(F.lit(1)).alias("files"))


def _coerce(df: DataFrame, src: str, target: T.DataType) -> Column:
    c, stype = F.col(f"`{src}`"), df.schema[src].dataType
    if isinstance(target, T.LongType):
        if isinstance(stype, T.TimestampNTZType):
            return F.timestamp_diff("MICROSECOND", epoch_ntz(), c) * 1000
        if isinstance(stype, T.TimestampType):
            return F.unix_micros(c) * 1000
        if isinstance(stype, (T.DoubleType, T.FloatType, T.DecimalType)):
            # Integer codes stored as floating point are rounded, not truncated.
            return F.round(c).cast("long")
        return c.cast("long")
    return c.cast(target)


def canonical_columns(df: DataFrame, service: str) -> tuple[list[Column], list[str]]:
    """C2/C3 + B1: project ``df`` onto the raw schema (without load metadata)."""
    by_upper = {c.upper(): c for c in df.columns if c.lower() not in DRIFT_COLUMNS_TO_DROP}
    target = [f for f in raw_schema(service).fields if f.name not in LOAD_METADATA]
    names = {f.name for f in target}
    cols = []
    for f in target:
        src = by_upper.get(f.name)
        cols.append((_coerce(df, src, f.dataType) if src else F.lit(None).cast(f.dataType)).alias(f.name))
    dropped = [by_upper[u] for u in by_upper if u not in names and not u.startswith("_")]
    return cols, dropped


def load_metadata(cfg: PipelineConfig, load_time_ns: int) -> list[Column]:
    """C1 + A2 from the scan's file metadata."""
    name = F.col("_metadata.file_name")
    year = F.regexp_extract(name, FILE_NAME_PATTERN, 2).cast("long")
    month = F.regexp_extract(name, FILE_NAME_PATTERN, 3).cast("long")
    batch = F.floor(F.col("_metadata.row_index") / F.lit(cfg.batch_rows)).cast("long") + 1
    return [
        month_index(year, month, cfg.first_month).alias("RUN_ID"),
        F.lit(load_time_ns).cast("long").alias("VENTANA_TEMPORAL"),
        F.concat(batch.cast("string"), F.lit("/"), month.cast("string")).alias("LOTE_MES"),
        month.alias("MONTH"),
        year.alias("YEAR"),
    ]


def read_months(
    spark: SparkSession,
    files: list[str],
    service: str,
    cfg: PipelineConfig = DEFAULT,
    load_time_ns: int | None = None,
    registry: str | None = None,
) -> MonthRead:
    """Read month files of one service into the canonical raw schema (B1).

    With ``registry`` (a folder) the files' schemas are kept there between runs.
    """
    if load_time_ns is None:
        load_time_ns = time.time_ns()
    groups: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType] = {}
    found = registered_schemas(spark, files, registry) if registry else file_schemas(spark, files)
    for f, schema in zip(files, found, strict=True):
        key = schema.json()
        groups.setdefault(key, []).append(f)
        schemas[key] = schema
    frames, dropped = [], {}
    for key, group in groups.items():
        df = spark.read.schema(schemas[key]).parquet(*group)
        cols, unknown = canonical_columns(df, service)
        if unknown and service in STRICT_SERVICES:
            raise UnknownColumnsError(f"{service}: unknown columns {unknown} in {group}")
        for f in group if unknown else []:
            dropped[f] = unknown
        frames.append(df.select(*cols, *load_metadata(cfg, load_time_ns)))
    schema = raw_schema(service)
    if not frames:
        return MonthRead(spark.createDataFrame([], schema), dropped, files)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return MonthRead(out.select(*[F.col(x.name).cast(x.dataType) for x in schema.fields]), dropped, files)


def batch_labels(df_with_metadata: DataFrame, batch_rows: int) -> DataFrame:
    """A2 on any Parquet scan: ``lote`` per row from its position in its file."""
    batch = F.floor(F.col("_metadata.row_index") / F.lit(batch_rows)).cast("long") + 1
    return df_with_metadata.select(F.col("_metadata.file_name").alias("file_name"), batch.alias("lote"))

