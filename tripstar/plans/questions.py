"""The business questions as Spark SQL over the registered gold tables.

For users who run SQL text: register the layers with
:func:`tripstar.plans.layers.register` and pass the statements to ``spark.sql``.
They match the DataFrame versions in :mod:`tripstar.operators.analytics` (tested).

Every statement reduces the fact by its narrow surrogate keys first and joins the
names to the few rows that are left.  ``gold`` is what stands before a table name:
``taxis_gold.`` for tables, ``taxis_gold_`` for the temporary views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _top_zones(role: str, gold: str) -> str:
    zone, date = f"{role}_zone_sk", f"{role}_date_sk"
    return f"""
WITH per_day AS (SELECT {zone}, {date}, count(*) AS trips FROM {gold}fct_trips GROUP BY ALL),
per_month AS (
  SELECT {zone}, d.month AS mes, sum(trips) AS total_de_viajes
  FROM per_day JOIN {gold}dim_date_{role} d USING ({date}) GROUP BY ALL),
placed AS (
  SELECT z.{zone}, z.{role}_zone, mes, total_de_viajes, rank() OVER (PARTITION BY mes ORDER BY total_de_viajes DESC) AS place
  FROM per_month JOIN {gold}dim_zone_{role} z USING ({zone}))
SELECT {zone}, {role}_zone, mes, total_de_viajes FROM placed WHERE place <= 10 ORDER BY mes, total_de_viajes DESC"""


def _revenue(role: str, gold: str) -> str:
    zone, date = f"{role}_zone_sk", f"{role}_date_sk"
    return f"""
WITH per_day AS (
  SELECT {zone}, {date}, sum(fare_amount) AS fares, sum(tip_percentage) AS tips, count(tip_percentage) AS tipped
  FROM {gold}fct_trips WHERE fare_amount >= 0 GROUP BY ALL)
SELECT {role}_borough, month AS mes, sum(fares) AS ingresos_totales, sum(tips) / sum(tipped) AS tip_porcentaje_promedio
FROM per_day JOIN {gold}dim_zone_{role} USING ({zone}) JOIN {gold}dim_date_{role} USING ({date})
WHERE {role}_borough IS NOT NULL
GROUP BY {role}_borough, month ORDER BY {role}_borough, mes"""


def _speed(role: str, gold: str) -> str:
    zone, time = f"{role}_zone_sk", f"{role}_time_sk"
    return f"""
WITH per_hour AS (
  SELECT {zone}, {time} DIV 10000 AS hour, sum(avg_speed_mph) AS speeds, count(*) AS trips
  FROM {gold}fct_trips WHERE avg_speed_mph > 0 GROUP BY ALL)
SELECT {role}_borough, if(hour >= 6 AND hour <= 18, 'diurno', 'nocturno') AS franja, sum(speeds) / sum(trips) AS avg_speed_mph_franja
FROM per_hour JOIN {gold}dim_zone_{role} USING ({zone})
WHERE {role}_borough IS NOT NULL
GROUP BY ALL ORDER BY {role}_borough, franja"""


def _percentiles(gold: str) -> str:
    """Exact percentiles from counts: a task holds a zone's distinct durations, not its trips."""
    def at(p: float) -> str:
        place = f"{p}D * (trips - 1)"
        low, high = (f"min(CASE WHEN upto > {side}({place}) THEN seconds END)" for side in ("floor", "ceil"))
        return f"{low} + ({high} - {low}) * (max({place}) - floor(max({place})))"

    return f"""
WITH per_value AS (
  SELECT pickup_zone_sk, CAST(trip_duration_seconds AS DOUBLE) AS seconds, count(*) AS n
  FROM {gold}fct_trips WHERE trip_duration_seconds IS NOT NULL GROUP BY ALL),
running AS (
  SELECT pickup_zone_sk, seconds, sum(n) OVER (PARTITION BY pickup_zone_sk ORDER BY seconds) AS upto,
    sum(n) OVER (PARTITION BY pickup_zone_sk) AS trips
  FROM per_value),
spread AS (
  SELECT pickup_zone_sk, {at(0.5)} AS p50_duration_sec, {at(0.9)} AS p90_duration_sec
  FROM running GROUP BY pickup_zone_sk)
SELECT pickup_location_id, pickup_borough, pickup_zone, p50_duration_sec, p90_duration_sec
FROM spread JOIN {gold}dim_zone_pickup USING (pickup_zone_sk) ORDER BY pickup_location_id"""


def _demand(gold: str) -> str:
    return f"""
WITH per_slot AS (
  SELECT pickup_date_sk, pickup_time_sk DIV 10000 AS pickup_hour, count(*) AS trips FROM {gold}fct_trips GROUP BY ALL)
SELECT day_of_week, pickup_hour, sum(trips) AS total_viajes
FROM per_slot JOIN {gold}dim_date_pickup USING (pickup_date_sk)
GROUP BY ALL ORDER BY day_of_week, total_viajes DESC"""


def statements(gold: str = "taxis_gold.") -> dict[str, str]:
    return {
        "top_zones_pickup": _top_zones("pickup", gold),
        "top_zones_dropoff": _top_zones("dropoff", gold),
        "revenue_tips_pickup": _revenue("pickup", gold),
        "revenue_tips_dropoff": _revenue("dropoff", gold),
        "speed_by_band_pickup": _speed("pickup", gold),
        "speed_by_band_dropoff": _speed("dropoff", gold),
        "duration_percentiles": _percentiles(gold),
        "demand_dow_hour": _demand(gold),
    }


def run(spark: SparkSession, name: str, gold: str = "taxis_gold.") -> DataFrame:
    return spark.sql(statements(gold)[name])
