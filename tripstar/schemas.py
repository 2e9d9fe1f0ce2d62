"""Canonical schemas of the raw layer (B1) and of the sample inputs."""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S = T.LongType(), T.DoubleType(), T.StringType()


def _raw_trip_schema(prefix: str, green: bool) -> T.StructType:
    fields = [
        ("VENDORID", L),
        (f"{prefix}_PICKUP_DATETIME", L),
        (f"{prefix}_DROPOFF_DATETIME", L),
        ("PASSENGER_COUNT", L),
        ("TRIP_DISTANCE", D),
        ("RATECODEID", L),
        ("STORE_AND_FWD_FLAG", S),
        ("PULOCATIONID", L),
        ("DOLOCATIONID", L),
        ("PAYMENT_TYPE", L),
        ("FARE_AMOUNT", D),
        ("EXTRA", D),
        ("MTA_TAX", D),
        ("TIP_AMOUNT", D),
        ("TOLLS_AMOUNT", D),
    ]
    if green:
        fields.append(("EHAIL_FEE", D))
    fields += [("IMPROVEMENT_SURCHARGE", D), ("TOTAL_AMOUNT", D)]
    if green:
        fields.append(("TRIP_TYPE", L))
    fields += [
        ("CONGESTION_SURCHARGE", D),
        ("AIRPORT_FEE", D),
        ("RUN_ID", L),
        ("VENTANA_TEMPORAL", L),
        ("LOTE_MES", S),
        ("MONTH", L),
        ("YEAR", L),
    ]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_YELLOW = _raw_trip_schema("TPEP", green=False)
RAW_GREEN = _raw_trip_schema("LPEP", green=True)

# Load metadata columns appended by the loader.
LOAD_METADATA = ("RUN_ID", "VENTANA_TEMPORAL", "LOTE_MES", "MONTH", "YEAR")

RAW_ZONES = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType(), True),
        T.StructField("Borough", S, True),
        T.StructField("Zone", S, True),
        T.StructField("service_zone", S, True),
    ]
)

PASSENGERS = T.StructType(
    [
        T.StructField("PassengerId", T.IntegerType(), True),
        T.StructField("Survived", T.IntegerType(), True),
        T.StructField("Pclass", T.IntegerType(), True),
        T.StructField("Name", S, True),
        T.StructField("Sex", S, True),
        T.StructField("Age", D, True),
        T.StructField("SibSp", T.IntegerType(), True),
        T.StructField("Parch", T.IntegerType(), True),
        T.StructField("Ticket", S, True),
        T.StructField("Fare", D, True),
        T.StructField("Cabin", S, True),
        T.StructField("Embarked", S, True),
    ]
)


def raw_schema(service: str) -> T.StructType:
    return RAW_YELLOW if service == "yellow" else RAW_GREEN

