"""Silver model: unify, number, enrich, standardise and clean the trips.

Steps (reference semantics, Spark-first execution):

* C7/D1/I1 — align the two services' columns, drop rows without timestamps,
  ``unionByName``.
* E1 — left join of the zone lookup on pickup id (broadcast by its size, chosen at run time).
* G1/C16 — duplicate ordinal and trip key (see :mod:`.numbering`).
* E2 — left join of the zone lookup on dropoff id.
* C8-C15, C17-C18 — times, duration, speed, casts, labels, flags.
* D2 — the quality rules, kept as a named list so the same list also yields
  the rejects report (D5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, PipelineConfig
from ..functions import labels
from ..functions.keys import key_texts, trip_key
from ..functions.timecols import convert_zone, duration_seconds, ns_to_wallclock
from .numbering import number_within_key

UNION_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "rate_code_id", "store_and_fwd_flag", "pulocation_id", "dolocation_id", "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "run_id", "ventana_temporal", "lote_mes", "month",
    "year", "service_type",
]

# Natural key of a trip: the partition of the duplicate ordinal and, with the
# ordinal, the content of the trip key (in this order).
NATURAL_KEY = [
    "pickup_datetime", "dropoff_datetime", "pulocation_id", "dolocation_id", "vendor_id",
    "rate_code_id", "payment_type", "total_amount", "trip_distance", "service_type",
    "passenger_count",
]
# The short key used to identify rows in the per-step reports.
ROW_KEY = ["pickup_datetime", "dropoff_datetime", "pulocation_id", "dolocation_id", "vendor_id"]

PICKUP_ZONE_COLUMNS = ["pickup_borough", "pickup_zone", "pickup_service_zone"]
DROPOFF_ZONE_COLUMNS = ["dropoff_borough", "dropoff_zone", "dropoff_service_zone"]

SILVER_COLUMNS = [
    "trip_id", "pickup_datetime_utc", "dropoff_datetime_utc", "pickup_datetime_nyc",
    "dropoff_datetime_nyc", "trip_duration_seconds", "avg_speed_mph", "vendor_id",
    "passenger_count", "trip_distance", "pickup_location_id", "pickup_borough", "pickup_zone",
    "pickup_service_zone", "dropoff_location_id", "dropoff_borough", "dropoff_zone",
    "dropoff_service_zone", "rate_code_id", "rate_code_description", "store_and_fwd_flag",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "payment_type_description", "run_id",
    "ventana_temporal_utc", "ventana_temporal_nyc", "lote_mes", "month", "year", "service_type",
    "duration_flag", "speed_flag",
]


# --- C7 / D1 / I1 -------------------------------------------------------------
def _aligned(bronze: DataFrame, prefix: str) -> DataFrame:
    pick, drop = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    renamed = bronze.where(F.col(pick).isNotNull() & F.col(drop).isNotNull()).withColumnsRenamed(
        {pick: "pickup_datetime", drop: "dropoff_datetime", "ratecode_id": "rate_code_id"}
    )
    return renamed.select(*UNION_COLUMNS)


def trips_union(bronze_yellow: DataFrame, bronze_green: DataFrame) -> DataFrame:
    """Rows of both services with both timestamps, 24 aligned columns."""
    return _aligned(bronze_green, "lpep").unionByName(_aligned(bronze_yellow, "tpep"))


# --- C8-C12 -------------------------------------------------------------------
def time_columns(cfg: PipelineConfig = DEFAULT) -> dict[str, Column]:
    p_nyc = ns_to_wallclock(F.col("pickup_datetime"))
    d_nyc = ns_to_wallclock(F.col("dropoff_datetime"))
    load = ns_to_wallclock(F.col("ventana_temporal"))
    return {
        "pickup_datetime_nyc": p_nyc,
        "dropoff_datetime_nyc": d_nyc,
        "pickup_datetime_utc": convert_zone(p_nyc, cfg.trip_zone, "UTC"),
        "dropoff_datetime_utc": convert_zone(d_nyc, cfg.trip_zone, "UTC"),
        "ventana_temporal_utc": convert_zone(load, cfg.load_clock_zone, "UTC"),
        "ventana_temporal_nyc": convert_zone(load, cfg.load_clock_zone, cfg.trip_zone),
    }


def metric_columns() -> dict[str, Column]:
    dur = duration_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return {
        "trip_duration_seconds": dur,
        # CASE is lazy, so the ANSI division never sees a zero denominator.
        "avg_speed_mph": F.when(dur > 0, F.col("trip_distance") * 3600 / dur),
    }


def label_columns() -> dict[str, Column]:
    return {
        "payment_type_description": labels.payment_label(F.col("payment_type")),
        "rate_code_description": labels.rate_label(F.col("rate_code_id")),
    }


# --- E1 / E2 ------------------------------------------------------------------
def _zone_side(zones: DataFrame, prefix: str) -> DataFrame:
    return zones.select(
        F.col("LOCATIONID").alias(f"_{prefix}_locid"),
        F.col("BOROUGH").alias(f"{prefix}_borough"),
        F.col("ZONE").alias(f"{prefix}_zone"),
        F.col("SERVICE_ZONE").alias(f"{prefix}_service_zone"),
    )


def with_pickup_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    z = _zone_side(zones, "pickup")
    return trips.join(z, trips["pulocation_id"] == z["_pickup_locid"], "left").drop("_pickup_locid")


def with_dropoff_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    z = _zone_side(zones, "dropoff")
    return trips.join(z, trips["dolocation_id"] == z["_dropoff_locid"], "left").drop("_dropoff_locid")


# --- G1 / C16 -----------------------------------------------------------------
def with_trip_id(trips: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Duplicate ordinal over the text of the natural key, then the MD5 trip key.

    Rows of one text are numbered by the remaining columns, then by the raw
    values of the natural key (which differ in noise only).
    """
    types = {f.name: f.dataType for f in trips.schema.fields}
    texts = {"_texts": key_texts([(F.col(c), types[c]) for c in NATURAL_KEY])}
    rest = [c for c in trips.columns if c not in NATURAL_KEY]
    numbered = number_within_key(trips, ["_texts"], [*rest, *NATURAL_KEY], ordinal_col="trip_ordinal", computed=texts)
    return numbered.withColumn("trip_id", trip_key(F.col("_texts"), F.col("trip_ordinal"))).drop("_texts")


# --- standardisation ------------------------------------------------------------
def standardized(union: DataFrame, zones: DataFrame, cfg: PipelineConfig = DEFAULT,
                 keyed: bool = True) -> DataFrame:
    """All silver columns for every unioned trip, before the quality rules.

    ``keyed=False`` leaves ``trip_id`` null and skips the duplicate ordinal
    (and its shuffle) — for reports that only evaluate the rules.
    """
    zoned = with_pickup_zone(union, zones)
    if keyed:
        rows = with_trip_id(zoned, cfg)
    else:
        rows = zoned.withColumn("trip_id", F.lit(None).cast("string"))
    enriched = with_dropoff_zone(rows, zones)
    cols = {
        **time_columns(cfg),
        **metric_columns(),
        **label_columns(),
        "pickup_location_id": F.col("pulocation_id").cast(T.LongType()),
        "dropoff_location_id": F.col("dolocation_id").cast(T.LongType()),
    }
    out = enriched.withColumns(cols).withColumns(
        {
            "vendor_id": F.col("vendor_id").cast(T.LongType()),
            "passenger_count": F.col("passenger_count").cast(T.LongType()),
            "rate_code_id": F.col("rate_code_id").cast(T.LongType()),
            "trip_distance": F.col("trip_distance").cast("double"),
            **{
                c: F.col(c).cast("double")
                for c in ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                          "improvement_surcharge", "total_amount", "congestion_surcharge"]
            },
        }
    )
    out = out.withColumns(
        {
            "duration_flag": labels.duration_flag(F.col("trip_duration_seconds")),
            "speed_flag": labels.speed_flag(F.col("avg_speed_mph")),
        }
    )
    return out.select(*SILVER_COLUMNS)


# --- D2 / D5 --------------------------------------------------------------------
def quality_rules(cfg: PipelineConfig = DEFAULT) -> list[tuple[str, Column]]:
    """Named silver rules; a row passes when every rule is TRUE (null fails)."""
    lo = F.lit(cfg.window_start).cast("timestamp_ntz")
    hi = F.lit(cfg.window_end).cast("timestamp_ntz")
    rules: list[tuple[str, Column]] = [
        ("trip_distance >= 0", F.col("trip_distance") >= 0),
        ("passenger_count > 0", F.col("passenger_count") > 0),
    ]
    for c in ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
              "improvement_surcharge", "total_amount"]:
        rules.append((f"{c} >= 0", F.col(c) >= 0))
    rules += [
        ("avg_speed_mph > 0", F.col("avg_speed_mph") > 0),
        ("pickup_datetime_utc < dropoff_datetime_utc",
         F.col("pickup_datetime_utc") < F.col("dropoff_datetime_utc")),
    ]
    for c in ["pickup_datetime_utc", "pickup_datetime_nyc", "dropoff_datetime_utc",
              "dropoff_datetime_nyc", "ventana_temporal_nyc", "ventana_temporal_utc"]:
        rules.append((f"{c} in window", (F.col(c) >= lo) & (F.col(c) < hi)))
    rules += [
        ("vendor_id is not null", F.col("vendor_id").isNotNull()),
        ("pickup_location_id > 0", F.col("pickup_location_id") > 0),
        ("dropoff_location_id > 0", F.col("dropoff_location_id") > 0),
    ]
    return rules


def passes(rules: list[tuple[str, Column]]) -> Column:
    cond = None
    for _, rule in rules:
        cond = rule if cond is None else cond & rule
    return F.coalesce(cond, F.lit(False))


def silver_from_union(union: DataFrame, zones: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return standardized(union, zones, cfg).where(passes(quality_rules(cfg)))


def reject_report(standard: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Rows failing each rule (null counts as a failure), one pass."""
    rules = quality_rules(cfg)
    aggs = [
        F.sum(F.when(F.coalesce(rule, F.lit(False)), 0).otherwise(1)).cast("long").alias(f"r{i}")
        for i, (_, rule) in enumerate(rules)
    ]
    wide = standard.agg(*aggs)
    stack = ", ".join(f"'{name}', r{i}" for i, (name, _) in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {stack}) as (rule, failing_rows)")


# --- per-step views over the union (for inspection and testing) ------------------------
def step_trip_key(union: DataFrame, zones: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return with_trip_id(with_pickup_zone(union, zones), cfg).select(*ROW_KEY, "trip_id")


def step_trip_times(union: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return union.select(*ROW_KEY, *[c.alias(n) for n, c in time_columns(cfg).items()])


def step_trip_metrics(union: DataFrame) -> DataFrame:
    return union.select(*ROW_KEY, *[c.alias(n) for n, c in metric_columns().items()])


def step_code_labels(union: DataFrame) -> DataFrame:
    return union.select(
        *ROW_KEY, "payment_type", "rate_code_id", *[c.alias(n) for n, c in label_columns().items()]
    )


def step_zone_enriched(union: DataFrame, zones: DataFrame) -> DataFrame:
    both = with_dropoff_zone(with_pickup_zone(union.select(*ROW_KEY), zones), zones)
    return both.select(*ROW_KEY, *PICKUP_ZONE_COLUMNS, *DROPOFF_ZONE_COLUMNS)


def step_trip_flags(union: DataFrame) -> DataFrame:
    m = metric_columns()
    return union.select(
        *ROW_KEY,
        labels.duration_flag(m["trip_duration_seconds"]).alias("duration_flag"),
        labels.speed_flag(m["avg_speed_mph"]).alias("speed_flag"),
    )
