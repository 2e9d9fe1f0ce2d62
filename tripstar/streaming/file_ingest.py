"""Incremental ingest of month files as a file stream (L3 alternative, B7).

What streams are the *paths* of new ``{service}_tripdata_*.parquet`` files (the
``binaryFile`` source without the contents); the stream checkpoint remembers which
were processed, so a re-run adds nothing and a new month adds only its rows.  Each
micro-batch hands its paths to the batch loader, which groups files by schema, so
months whose types drift or that carry an extra column arrive like any other.

A micro-batch is one load whose id is made of the checkpoint and the batch number: a
batch replayed after a failure replaces itself, rows and manifest.
"""

from __future__ import annotations

import hashlib
import re
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..plans.loader import load_files, year_month
from ..sources.monthly import FILE_NAME_PATTERN


@dataclass
class ExportTotals:
    batches: int = 0
    rows: int = 0
    per_batch: list[tuple[int, int]] = field(default_factory=list)

    def add(self, batch_id: int, rows: int) -> None:
        self.batches += 1
        self.rows += rows
        self.per_batch.append((batch_id, rows))


def export_batch(batch: DataFrame, path: str, totals: ExportTotals, batch_id: int) -> None:
    """Write one batch (idempotently) and add its rows to the totals."""
    obs = Observation(f"export_{batch_id}_{time.time_ns()}")
    observed = batch.observe(obs, F.count(F.lit(1)).alias("rows"))
    (observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("YEAR", "MONTH").parquet(path))
    rows = int(obs.get.get("rows", 0))
    totals.add(batch_id, rows)


def stream_month_files(
    spark: SparkSession,
    landing_dir: str,
    raw_root: str,
    service: str,
    checkpoint_location: str,
    cfg: PipelineConfig = DEFAULT,
    load_time_ns: int | None = None,
) -> ExportTotals:
    """Process every not-yet-seen month file of ``service`` and stop (availableNow).

    Files outside the planned months are left alone, like in the batch loader.
    """
    load_time_ns = load_time_ns or time.time_ns()
    totals = ExportTotals()
    own = hashlib.md5(f"{checkpoint_location}|{service}".encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.select("path").collect())  # one row per month file
        files = [f for f in files if re.match(FILE_NAME_PATTERN, f.rsplit("/", 1)[-1])
                 and cfg.first_month <= year_month(f) <= cfg.last_month]
        if files:
            _, rows = load_files(spark, raw_root, service, files, cfg, load_time_ns, load=f"stream-{own}-{batch_id:09d}")
            totals.add(batch_id, rows)

    stream = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", f"{service}_tripdata_*.parquet")
        .load(landing_dir)
        .select("path")
    )
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return totals
