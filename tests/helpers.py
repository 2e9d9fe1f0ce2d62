"""Hand-made trip rows in the unioned bronze shape."""

from __future__ import annotations

import calendar
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.operators import gold

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

UNION_SCHEMA = (
    "vendor_id long, pickup_datetime long, dropoff_datetime long, passenger_count long, "
    "trip_distance double, rate_code_id long, store_and_fwd_flag string, pulocation_id long, "
    "dolocation_id long, payment_type long, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
    "congestion_surcharge double, run_id long, ventana_temporal long, lote_mes string, month long, "
    "year long, service_type string"
)
COLUMNS = [c.strip().split(" ")[0] for c in UNION_SCHEMA.split(",")]
LOAD_NS = 1_758_259_200_000_000_000


def ns(wall: str) -> int:
    """Wall-clock text -> epoch nanoseconds of that wall clock."""
    return calendar.timegm(datetime.fromisoformat(wall).timetuple()) * 1_000_000_000


def trip(pickup: str = "2020-06-01 10:00:00", seconds: int = 600, **kw) -> dict:
    row = dict(
        vendor_id=1, pickup_datetime=ns(pickup), dropoff_datetime=ns(pickup) + seconds * 1_000_000_000,
        passenger_count=1, trip_distance=2.0, rate_code_id=1, store_and_fwd_flag="N", pulocation_id=1,
        dolocation_id=2, payment_type=1, fare_amount=10.0, extra=0.5, mta_tax=0.5, tip_amount=2.0,
        tolls_amount=0.0, improvement_surcharge=0.3, total_amount=13.3, congestion_surcharge=2.5, run_id=1,
        ventana_temporal=LOAD_NS, lote_mes="1/6", month=6, year=2020, service_type="yellow",
    )
    if "dropoff" in kw:
        row["dropoff_datetime"] = ns(kw.pop("dropoff"))
    row.update(kw)
    return row


def union_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], UNION_SCHEMA)


def zones_df(spark: SparkSession, rows=None) -> DataFrame:
    rows = rows or [(1, "Manhattan", "Zone A", "Yellow Zone"), (2, "Queens", "Zone B", "Boro Zone")]
    return spark.createDataFrame(rows, "LOCATIONID int, BOROUGH string, ZONE string, SERVICE_ZONE string")


def fct_trips_joined_time_keys(silver: DataFrame, dims) -> DataFrame:
    """Literal form of E3/E4 (date and time keys by join) — used to test the shortcut."""
    f = gold.fct_trips(silver, dims).drop("pickup_date_sk", "dropoff_date_sk", "pickup_time_sk", "dropoff_time_sk")
    s = silver.select(
        "trip_id",
        F.to_date("pickup_datetime_nyc").alias("pickup_date"),
        F.to_date("dropoff_datetime_nyc").alias("dropoff_date"),
        F.hour("pickup_datetime_nyc").alias("p_h"), F.minute("pickup_datetime_nyc").alias("p_m"),
        F.second("pickup_datetime_nyc").alias("p_s"),
        F.hour("dropoff_datetime_nyc").alias("d_h"), F.minute("dropoff_datetime_nyc").alias("d_m"),
        F.second("dropoff_datetime_nyc").alias("d_s"),
    )
    s = s.join(dims.date_pickup.select("pickup_date_sk", "pickup_date"), "pickup_date", "left")
    s = s.join(dims.date_dropoff.select("dropoff_date_sk", "dropoff_date"), "dropoff_date", "left")
    tp = dims.time_pickup.select("pickup_time_sk", F.col("hour").alias("p_h"), F.col("minute").alias("p_m"),
                                 F.col("second").alias("p_s"))
    td = dims.time_dropoff.select("dropoff_time_sk", F.col("hour").alias("d_h"), F.col("minute").alias("d_m"),
                                  F.col("second").alias("d_s"))
    s = s.join(tp, ["p_h", "p_m", "p_s"], "left").join(td, ["d_h", "d_m", "d_s"], "left")
    s = s.select("trip_id", "pickup_date_sk", "dropoff_date_sk", "pickup_time_sk", "dropoff_time_sk")
    return f.join(s, "trip_id", "left").select(*gold.FACT_COLUMNS)
