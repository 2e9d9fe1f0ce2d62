"""Time columns.

Raw trip times are epoch-nanosecond integers that encode the *wall clock* of
the trip zone.  They become ``timestamp_ntz`` without consulting the session
time zone, so results do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ns_to_wallclock(ns: Column) -> Column:
    """Epoch nanoseconds -> timestamp_ntz (microsecond precision)."""
    ns = ns.cast("long")
    # floor division in long arithmetic: also right before 1970
    micros = F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000))
    return F.timestamp_add("MICROSECOND", micros, epoch_ntz())


def convert_zone(ts: Column, source_zone: str, target_zone: str) -> Column:
    """Wall clock in ``source_zone`` -> wall clock in ``target_zone``.

    In the repeated autumn hour Spark picks the earlier (daylight) offset.
    """
    return F.convert_timezone(F.lit(source_zone), F.lit(target_zone), ts)


def duration_seconds(pickup_ns: Column, dropoff_ns: Column) -> Column:
    """C11: wall-clock difference in seconds (ignores DST, as the reference)."""
    return (dropoff_ns - pickup_ns) / F.lit(1e9)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Epoch seconds of a timestamp column of either timestamp type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", epoch_ntz(), F.col(name))
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(F.col(name))
    return F.timestamp_diff("SECOND", epoch_ntz(), F.col(name).cast("timestamp_ntz"))


def date_key(date: Column) -> Column:
    """C20: YYYYMMDD as an integer, computed arithmetically."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def time_key(ts: Column) -> Column:
    """HHMMSS as an integer."""
    return (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).cast("int")


def month_index(year: Column, month: Column, first: tuple[int, int]) -> Column:
    """Months since ``first`` plus one (the deterministic run id of C1)."""
    return ((year - first[0]) * 12 + (month - first[1]) + 1).cast("long")
