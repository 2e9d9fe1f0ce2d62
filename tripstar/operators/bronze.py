"""Bronze models (C4-C6): rename raw columns and tag the service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Raw (upper-case) -> bronze column names shared by both services.  The time
# columns keep their service prefix until the silver union aligns them.
_COMMON = [
    ("VENDORID", "vendor_id"),
    ("{p}_PICKUP_DATETIME", "{q}_pickup_datetime"),
    ("{p}_DROPOFF_DATETIME", "{q}_dropoff_datetime"),
    ("PASSENGER_COUNT", "passenger_count"),
    ("TRIP_DISTANCE", "trip_distance"),
    ("RATECODEID", "ratecode_id"),
    ("STORE_AND_FWD_FLAG", "store_and_fwd_flag"),
    ("PULOCATIONID", "pulocation_id"),
    ("DOLOCATIONID", "dolocation_id"),
    ("PAYMENT_TYPE", "payment_type"),
    ("FARE_AMOUNT", "fare_amount"),
    ("EXTRA", "extra"),
    ("MTA_TAX", "mta_tax"),
    ("TIP_AMOUNT", "tip_amount"),
    ("TOLLS_AMOUNT", "tolls_amount"),
    ("IMPROVEMENT_SURCHARGE", "improvement_surcharge"),
    ("TOTAL_AMOUNT", "total_amount"),
    ("CONGESTION_SURCHARGE", "congestion_surcharge"),
    ("RUN_ID", "run_id"),
    ("VENTANA_TEMPORAL", "ventana_temporal"),
    ("LOTE_MES", "lote_mes"),
    ("MONTH", "month"),
    ("YEAR", "year"),
]


def bronze_trips(raw: DataFrame, service: str) -> DataFrame:
    """23 renamed columns + ``service_type``; airport/e-hail/trip-type fees dropped."""
    p, q = ("TPEP", "tpep") if service == "yellow" else ("LPEP", "lpep")
    cols = [F.col(src.format(p=p)).alias(dst.format(q=q)) for src, dst in _COMMON]
    return raw.select(*cols, F.lit(service).alias("service_type"))


def bronze_yellow(raw: DataFrame) -> DataFrame:
    return bronze_trips(raw, "yellow")


def bronze_green(raw: DataFrame) -> DataFrame:
    return bronze_trips(raw, "green")


def bronze_zones(raw: DataFrame) -> DataFrame:
    """Case-sensitive source names -> upper-case bronze names."""
    return raw.select(
        F.col("LocationID").alias("LOCATIONID"),
        F.col("Borough").alias("BOROUGH"),
        F.col("Zone").alias("ZONE"),
        F.col("service_zone").alias("SERVICE_ZONE"),
    )
