"""Business questions over the star schema.

Each function takes the fact and the dimensions it needs and returns a lazy
DataFrame.  Star joins are inner ``USING`` joins as in the reference; the date
and time dimensions are bounded (validity window, clock) and broadcast; the
zone dimension is bounded by the zone lookup and left to AQE's runtime check.
All aggregations are partial/final (map-side combine), so one hot zone or one
hot month never moves as a group.  Results are ordered as the reference orders
them (H1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from .percentiles import percentile_cont

TOP_ZONES = 10
PEAK_HOURS_PER_DAY = 2


def _star(fact: DataFrame, *dims: tuple[DataFrame, str, bool]) -> DataFrame:
    out = fact
    for dim, key, bounded in dims:
        out = out.join(F.broadcast(dim) if bounded else dim, key)
    return out


def top_zones(fact: DataFrame, zone_dim: DataFrame, date_dim: DataFrame, role: str) -> DataFrame:
    """F3 + G3: the ten busiest zones of every calendar month, ties included.

    "Fewer than ten zones with strictly more trips in the same month" is
    exactly ``rank() <= 10``; Catalyst plans it with a partial window group
    limit instead of the nested-loop join a correlated count would need.
    """
    zone_sk, zone, date_sk = f"{role}_zone_sk", f"{role}_zone", f"{role}_date_sk"
    star = _star(
        fact.select(zone_sk, date_sk),
        (zone_dim.select(zone_sk, zone), zone_sk, False),
        (date_dim.select(date_sk, F.col("month").alias("mes")), date_sk, True),
    )
    counts = star.groupBy(zone_sk, zone, "mes").agg(F.count(F.lit(1)).alias("total_de_viajes"))
    w = Window.partitionBy("mes").orderBy(F.col("total_de_viajes").desc())
    ranked = counts.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= TOP_ZONES).drop("_rank")
    return ranked.orderBy("mes", F.col("total_de_viajes").desc())


def revenue_tips(fact: DataFrame, zone_dim: DataFrame, date_dim: DataFrame, role: str) -> DataFrame:
    """fare revenue and mean tip percentage per borough and month."""
    zone_sk, borough, date_sk = f"{role}_zone_sk", f"{role}_borough", f"{role}_date_sk"
    star = _star(
        fact.select(zone_sk, date_sk, "fare_amount", "tip_percentage"),
        (zone_dim.select(zone_sk, borough), zone_sk, False),
        (date_dim.select(date_sk, F.col("month").alias("mes")), date_sk, True),
    ).where((F.col("fare_amount") >= 0) & F.col(borough).isNotNull())
    return (
        star.groupBy(borough, "mes")
        .agg(
            F.sum("fare_amount").alias("ingresos_totales"),
            F.avg("tip_percentage").alias("tip_porcentaje_promedio"),
        )
        .orderBy(borough, "mes")
    )


def speed_by_band(fact: DataFrame, zone_dim: DataFrame, time_dim: DataFrame, role: str) -> DataFrame:
    """F5 + C24: mean speed per borough, day (6-18 h) vs night."""
    zone_sk, borough, time_sk = f"{role}_zone_sk", f"{role}_borough", f"{role}_time_sk"
    star = _star(
        fact.select(zone_sk, time_sk, "avg_speed_mph"),
        (zone_dim.select(zone_sk, borough), zone_sk, False),
        (time_dim.select(time_sk, "hour"), time_sk, True),
    ).where((F.col("avg_speed_mph") > 0) & F.col(borough).isNotNull())
    return (
        star.withColumn("franja", labels.day_band(F.col("hour")))
        .groupBy(borough, "franja")
        .agg(F.avg("avg_speed_mph").alias("avg_speed_mph_franja"))
        .orderBy(borough, "franja")
    )


def duration_percentiles(fact: DataFrame, zone_dim: DataFrame, approximate: bool = False,
                         accuracy: int = 10_000) -> DataFrame:
    """p50 / p90 trip duration per pickup location.

    Exact by default (``percentile_cont``).  With ``approximate`` the
    quantile sketch ``percentile_approx`` is used (bounded memory per group,
    rank error about 1/``accuracy``; values are always observed durations, so
    they can differ from the interpolated exact ones).

    Two counts of the fact select the durations (:mod:`.percentiles`); a location
    with a third of all trips is combined map-side like any other.
    """
    if approximate:
        star = _star(
            fact.select("pickup_zone_sk", "trip_duration_seconds"),
            (zone_dim.select("pickup_zone_sk", "pickup_location_id", "pickup_borough", "pickup_zone"),
             "pickup_zone_sk", False),
        )
        d = F.col("trip_duration_seconds")
        return (
            star.groupBy("pickup_location_id", "pickup_borough", "pickup_zone")
            .agg(F.percentile_approx(d, 0.5, accuracy).cast("double").alias("p50_duration_sec"),
                 F.percentile_approx(d, 0.9, accuracy).cast("double").alias("p90_duration_sec"))
            .orderBy("pickup_location_id")
        )
    # The location stands for its rows by its smallest zone key, so the fact is
    # counted by numbers; the names are joined to the result.
    names = ["pickup_location_id", "pickup_borough", "pickup_zone"]
    zones = zone_dim.select("pickup_zone_sk", *names, F.min("pickup_zone_sk").over(Window.partitionBy(*names)).alias("_group"))
    trips = _star(fact.select("pickup_zone_sk", "trip_duration_seconds"), (zones.select("pickup_zone_sk", "_group"), "pickup_zone_sk", False))
    found = percentile_cont(trips, ["_group"], "trip_duration_seconds", {"p50_duration_sec": 0.5, "p90_duration_sec": 0.9})
    return (
        found.join(zones.where("pickup_zone_sk = _group"), "_group")
        .select(*names, "p50_duration_sec", "p90_duration_sec").orderBy("pickup_location_id")
    )


def demand_dow_hour(fact: DataFrame, date_dim: DataFrame, time_dim: DataFrame) -> DataFrame:
    """trips per weekday name and pickup hour (weekday names sort alphabetically)."""
    star = _star(
        fact.select("pickup_date_sk", "pickup_time_sk"),
        (date_dim.select("pickup_date_sk", "day_of_week"), "pickup_date_sk", True),
        (time_dim.select("pickup_time_sk", "hour"), "pickup_time_sk", True),
    )
    return (
        star.groupBy("day_of_week", F.col("hour").alias("pickup_hour"))
        .agg(F.count(F.lit(1)).alias("total_viajes"))
        .orderBy("day_of_week", F.col("total_viajes").desc())
    )


def peak_hours(demand: DataFrame, per_day: int = PEAK_HOURS_PER_DAY) -> DataFrame:
    """The busiest hours of each weekday (ties broken by the earlier hour)."""
    w = Window.partitionBy("day_of_week").orderBy(F.col("total_viajes").desc(), F.col("pickup_hour").asc())
    return (
        demand.withColumn("peak_rank", F.row_number().over(w))
        .where(F.col("peak_rank") <= per_day)
        .orderBy("day_of_week", "peak_rank")
    )
