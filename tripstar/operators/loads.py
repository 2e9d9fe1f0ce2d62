"""Load bookkeeping over the trips: month plan (L1), coverage matrix (F9) and
natural-key de-duplication (L4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, PipelineConfig

DEDUP_KEY = ["service_type", "pickup_datetime", "dropoff_datetime", "pulocation_id", "dolocation_id"]


def month_sequence(spark: SparkSession, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Every planned (year, month), first..last inclusive, generated by Spark."""
    (y0, m0), (y1, m1) = cfg.first_month, cfg.last_month
    n = (y1 - y0) * 12 + (m1 - m0) + 1
    start = F.make_date(F.lit(y0), F.lit(m0), F.lit(1))
    d = F.add_months(start, F.col("id").cast("int"))
    return spark.range(n).select(F.year(d).alias("year"), F.month(d).alias("month"))


def month_plan(spark: SparkSession, load_log: DataFrame, services: list[str] | tuple[str, ...],
               cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """L1: planned months of each service that the load log does not hold yet."""
    plan = month_sequence(spark, cfg).withColumn("service_type", F.explode(F.array(*[F.lit(s) for s in services])))
    loaded = load_log.select("service_type", F.col("year").cast("int"), F.col("month").cast("int")).distinct()
    return plan.join(loaded, ["service_type", "year", "month"], "left_anti").select("service_type", "year", "month")


def coverage_matrix(spark: SparkSession, trips: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """rows per planned month and service; OK when every service has rows.

    ``trips`` needs ``service_type``, ``year`` and ``month`` (the load-metadata
    columns).  Counting is a partial/final aggregation followed by a pivot with
    the service list given, so no extra pass collects the pivot values.
    """
    return _coverage(spark, trips, F.count(F.lit(1)), cfg)


def coverage_from_log(spark: SparkSession, load_log: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """F9 from the load log alone (rows per service and month): no trip is read."""
    return _coverage(spark, load_log, F.sum("rows"), cfg)


def _coverage(spark: SparkSession, rows: DataFrame, count: Column, cfg: PipelineConfig) -> DataFrame:
    services = list(cfg.services)
    counts = (
        rows.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
        .pivot("service_type", services)
        .agg(count)
    )
    out = month_sequence(spark, cfg).join(counts, ["year", "month"], "left")
    count_cols = {s: F.coalesce(F.col(s), F.lit(0)).cast("long").alias(f"{s}_count") for s in services}
    complete = None
    for s in services:
        c = F.col(f"{s}_count") > 0
        complete = c if complete is None else complete & c
    return (
        out.select("year", "month", *count_cols.values())
        .withColumn("estado_load", F.when(complete, "OK").otherwise("MISSING"))
        .orderBy("year", "month")
    )


def dedup_trips(union: DataFrame, key: list[str] | None = None) -> DataFrame:
    """L4: one row per natural key (pickup, dropoff, PU, DO) per service.

    The kept row is the smallest by the remaining columns (deterministic).
    ``min(struct)`` is an ordinary aggregate with a map-side partial step, so
    a key with millions of copies collapses before the shuffle instead of
    travelling as one group to one task.  Rows are sorted by the key for that;
    texts with few values come last in it, so that the first eight bytes decide.
    """
    key = key or DEDUP_KEY
    rest = [c for c in union.columns if c not in key]
    key = sorted(key, key=lambda c: isinstance(union.schema[c].dataType, T.StringType))
    best = union.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    return best.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*union.columns)
