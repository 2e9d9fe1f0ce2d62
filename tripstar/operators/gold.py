"""Gold star schema: eleven dimensions and the trip fact.

Dimensions are ``distinct`` / ``group by`` over silver (map-side partial
aggregation) followed by a surrogate key, numbered without moving all members
to one task (see ``number_members``).  Sizes are bounded by construction — dates
by the validity window (< 4,100), times by the clock (86,400), labels by their
fixed value lists — or by the zone lookup and the code domains.

The fact computes the date and time surrogate keys arithmetically: they are
pure functions of the timestamp (``YYYYMMDD`` / ``HHMMSS``) and every fact
date/time is a member of its dimension, so four of the eleven dimension joins
disappear.  The other joins are to small dimensions; the ones with a proven
bound are broadcast explicitly, the rest are left to AQE's runtime size check.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, PipelineConfig
from ..functions import labels
from ..functions.timecols import date_key, time_key
from .ranges import running_sum

ROLES = ("pickup", "dropoff")


def number_members(members: dict[str, tuple[DataFrame, str, list[str]]], pin=None) -> dict[str, DataFrame]:
    """``row_number()`` over the natural key (nulls last) as a long, for many dimensions at once.

    ``members`` maps a dimension to (members, surrogate key, natural key): at most one
    whole-number column, then up to three texts.  All members are stacked, cut into
    ranges of (dimension, key) order, numbered inside each and offset by the sizes of
    the ranges before (:func:`.ranges.running_sum`): one written copy for all of them,
    and no dimension is gathered in one task, however many members it has.
    """
    stacked, shapes = [], {}
    for i, (name, (df, _, keys)) in enumerate(members.items()):
        whole = [k for k in keys if isinstance(df.schema[k].dataType, T.IntegralType)]
        if whole not in ([], keys[:1]) or len(keys) - len(whole) > 3:
            raise ValueError(f"{name}: a key is one whole number at most, then up to three texts")
        slots = ["k0"] * len(whole) + [f"k{j + 1}" for j in range(len(keys) - len(whole))]
        shapes[name] = (i, slots)
        held = dict(zip(slots, keys, strict=True))
        stacked.append(df.select(F.lit(i).alias("dimension"), *[
            (F.col(held[s]) if s in held else F.lit(None)).cast("long" if s == "k0" else "string").alias(s) for s in ("k0", "k1", "k2", "k3")],
            F.lit(1).cast("long").alias("one")))
    order = [F.col(s).asc_nulls_last() for s in ("k0", "k1", "k2", "k3")]
    placed = running_sum(reduce(DataFrame.unionByName, stacked), ["dimension"], order, "one", "place")
    placed = pin(placed, "members_numbered") if pin else placed
    out = {}
    for name, (df, sk, keys) in members.items():
        i, slots = shapes[name]
        out[name] = placed.where(F.col("dimension") == i).select(F.col("place").cast("long").alias(sk), *[
            F.col(s).cast(df.schema[k].dataType).alias(k) for s, k in zip(slots, keys, strict=True)])
    return out


# --- date / time ------------------------------------------------------------------
def _date_rows(days: DataFrame, role: str) -> DataFrame:
    cal = F.col("day")
    return days.select(
        date_key(cal).alias(f"{role}_date_sk"),
        cal.alias(f"{role}_date"),
        F.year(cal).alias("year"),
        F.month(cal).alias("month"),
        F.dayofmonth(cal).alias("day"),
        labels.day_name(cal).alias("day_of_week"),
    )


def _time_rows(times: DataFrame, role: str) -> DataFrame:
    sk = (F.col("hour") * 10000 + F.col("minute") * 100 + F.col("second")).cast("int")
    text = F.format_string("%02d:%02d:%02d", "hour", "minute", "second")
    return times.select(sk.alias(f"{role}_time_sk"), "hour", "minute", "second", text.alias(f"{role}_time_formatted"))


@dataclass
class Dimensions:
    date_pickup: DataFrame
    date_dropoff: DataFrame
    time_pickup: DataFrame
    time_dropoff: DataFrame
    zone_pickup: DataFrame
    zone_dropoff: DataFrame
    vendor: DataFrame
    rate_code: DataFrame
    payment_type: DataFrame
    service_type: DataFrame
    trip_type: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "dim_date_pickup": self.date_pickup,
            "dim_date_dropoff": self.date_dropoff,
            "dim_time_pickup": self.time_pickup,
            "dim_time_dropoff": self.time_dropoff,
            "dim_zone_pickup": self.zone_pickup,
            "dim_zone_dropoff": self.zone_dropoff,
            "dim_vendor": self.vendor,
            "dim_rate_code": self.rate_code,
            "dim_payment_type": self.payment_type,
            "dim_service_type": self.service_type,
            "dim_trip_type": self.trip_type,
        }


CODE_COLUMNS = ["vendor_id", "rate_code_id", "rate_code_description", "payment_type_description", "service_type",
                "duration_flag", "speed_flag"]


def dimension_members(silver: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What the dimensions are made of: (codes, zones, dates, times).

    Silver is read four times instead of once per dimension: one grouped pass
    over the code columns, and one each for zones, dates and times of both roles.
    """

    def roles(fields) -> DataFrame:
        both = F.array(*[F.struct(F.lit(r).alias("role"), *fields(r)) for r in ROLES])
        return silver.select(F.explode(both).alias("x")).select("x.*").distinct()

    def zone(r: str) -> list[Column]:
        return [F.col(f"{r}_{c}").alias(c) for c in ("location_id", "borough", "zone", "service_zone")]

    def clock(r: str) -> list[Column]:
        ts = F.col(f"{r}_datetime_nyc")
        return [F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), F.second(ts).alias("second")]

    return (
        silver.select(*CODE_COLUMNS).distinct(),
        roles(zone),
        roles(lambda r: [F.to_date(f"{r}_datetime_nyc").alias("day")]),
        roles(clock),
    )


def build_dimensions(silver: DataFrame, pin=None) -> Dimensions:
    """All dimensions.  ``pin`` (DataFrame, name -> DataFrame) may write the member
    tables and read them back, so that silver is not read once per dimension."""
    keep = pin or (lambda df, name: df)
    codes, zones, dates, times = (keep(df, f"members_{n}") for df, n in zip(
        dimension_members(silver), ("codes", "zones", "dates", "times"), strict=True))

    def zone(r: str) -> tuple[DataFrame, str, list[str]]:
        cols = ["location_id", "borough", "zone", "service_zone"]
        own = zones.where(F.col("role") == r).select(*[F.col(c).alias(f"{r}_{c}") for c in cols])
        return own, f"{r}_zone_sk", own.columns

    def code(sk: str, *keys: str) -> tuple[DataFrame, str, list[str]]:
        return codes.select(*keys).distinct(), sk, list(keys)

    numbered = number_members({
        **{f"zone_{r}": zone(r) for r in ROLES},
        "vendor": code("vendor_sk", "vendor_id"),
        "rate_code": code("rate_code_sk", "rate_code_id", "rate_code_description"),
        "payment_type": code("payment_type_sk", "payment_type_description"),
        "service_type": code("service_type_sk", "service_type"),
        "trip_type": code("trip_type_sk", "duration_flag", "speed_flag"),
    }, pin)
    label = labels.trip_type_label(F.col("duration_flag"), F.col("speed_flag"))
    numbered["trip_type"] = numbered["trip_type"].withColumn("trip_type_description", label)

    def date(r: str) -> DataFrame:
        return _date_rows(dates.where(F.col("role") == r).select("day"), r)

    def time(r: str) -> DataFrame:
        return _time_rows(times.where(F.col("role") == r).select("hour", "minute", "second"), r)

    return Dimensions(**{f"date_{r}": date(r) for r in ROLES}, **{f"time_{r}": time(r) for r in ROLES}, **numbered)


# --- fact -----------------------------------------------------------------------------
FACT_COLUMNS = [
    "trip_id", "pickup_date_sk", "dropoff_date_sk", "pickup_time_sk", "dropoff_time_sk",
    "pickup_zone_sk", "dropoff_zone_sk", "vendor_sk", "rate_code_sk", "payment_type_sk",
    "service_type_sk", "trip_type_sk", "trip_duration_seconds", "avg_speed_mph", "passenger_count",
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "tip_percentage",
    "store_and_fwd_flag", "run_id", "ventana_temporal_utc", "ventana_temporal_nyc", "lote_mes",
]

MONEY_COLUMNS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "improvement_surcharge", "total_amount"]


def fact_rules(cfg: PipelineConfig = DEFAULT) -> list[tuple[str, Column]]:
    """D3: the silver numeric rules again, trip id present, and a speed cap."""
    rules = [
        ("trip_distance >= 0", F.col("trip_distance") >= 0),
        ("trip_id is not null", F.col("trip_id").isNotNull()),
        ("passenger_count > 0", F.col("passenger_count") > 0),
    ]
    rules += [(f"{c} >= 0", F.col(c) >= 0) for c in MONEY_COLUMNS]
    rules += [
        ("avg_speed_mph > 0", F.col("avg_speed_mph") > 0),
        (f"avg_speed_mph <= {cfg.max_fact_speed_mph:g}", F.col("avg_speed_mph") <= cfg.max_fact_speed_mph),
    ]
    return rules


def tip_percentage() -> Column:
    """Tip as a percentage of the fare; 0 when there is no positive fare."""
    return F.when(F.col("fare_amount") > 0, (F.col("tip_amount") / F.col("fare_amount")) * 100).otherwise(F.lit(0.0))


def usual_speed() -> Column:
    """C12 from the fact's own columns: what its speed is, unless silver says otherwise."""
    seconds = F.col("trip_duration_seconds")
    return F.when(seconds > 0, F.col("trip_distance") * 3600 / seconds)


# Bits of the fact's numbers while its rows move to their files; amounts are hundredths.
# A row with a larger number moves as it is.
FACT_WORDS = [
    {"pickup_time_sk": 18, "dropoff_time_sk": 18, "dropoff_date_sk": 25},
    {"dropoff_zone_sk": 12, "vendor_sk": 7, "rate_code_sk": 7, "payment_type_sk": 4, "trip_type_sk": 4, "passenger_count": 6,
     "trip_duration_seconds": 22},
    {"fare_amount": 24, "total_amount": 24, "improvement_surcharge": 7, "run_id": 8},
    {"trip_distance": 17, "tip_amount": 17, "extra": 10, "mta_tax": 8, "congestion_surcharge": 11},
]


def cluster_weights(silver: DataFrame, dims: Dimensions) -> DataFrame:
    """The fact's cluster keys of every silver row (a superset of the fact), without the other joins."""
    t = silver.select(date_key(F.to_date("pickup_datetime_nyc")).alias("pickup_date_sk"), "pickup_location_id", "service_type")
    t = t.join(dims.zone_pickup.select("pickup_zone_sk", "pickup_location_id"), "pickup_location_id", "left")
    return t.join(F.broadcast(dims.service_type.select("service_type_sk", "service_type")), "service_type", "left").select(
        "pickup_date_sk", "pickup_zone_sk", "service_type_sk")


def fct_trips(silver: DataFrame, dims: Dimensions, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    cond = None
    for _, rule in fact_rules(cfg):
        cond = rule if cond is None else cond & rule
    t = silver.where(cond)
    t = t.withColumns(
        {
            "pickup_date_sk": date_key(F.to_date("pickup_datetime_nyc")),
            "dropoff_date_sk": date_key(F.to_date("dropoff_datetime_nyc")),
            "pickup_time_sk": time_key(F.col("pickup_datetime_nyc")),
            "dropoff_time_sk": time_key(F.col("dropoff_datetime_nyc")),
            "tip_percentage": tip_percentage(),
        }
    )
    # Equi left joins; null natural keys never match.
    t = t.join(dims.zone_pickup.select("pickup_zone_sk", "pickup_location_id"), "pickup_location_id", "left")
    t = t.join(dims.zone_dropoff.select("dropoff_zone_sk", "dropoff_location_id"), "dropoff_location_id", "left")
    t = t.join(dims.vendor.select("vendor_sk", "vendor_id"), "vendor_id", "left")
    t = t.join(dims.rate_code.select("rate_code_sk", "rate_code_id"), "rate_code_id", "left")
    # Label dimensions: at most 7 payment labels, one row per service, 3 x 3 trip types.
    t = t.join(F.broadcast(dims.payment_type.select("payment_type_sk", "payment_type_description")),
               "payment_type_description", "left")
    t = t.join(F.broadcast(dims.service_type.select("service_type_sk", "service_type")), "service_type", "left")
    t = t.join(F.broadcast(dims.trip_type.select("trip_type_sk", "duration_flag", "speed_flag")),
               ["duration_flag", "speed_flag"], "left")
    return t.select(*FACT_COLUMNS)
