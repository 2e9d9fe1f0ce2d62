"""Code labels, flags and bands.

FIXED VALUES — these texts, codes and bounds must equal the reference's so
that labels, dimension members and query results are identical.  Listed in
natural order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Other"

RATE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
RATE_DEFAULT = "Unknown"

# Day names indexed by day of week with Sunday = 0.
DAY_NAMES = ["domingo", "lunes", "martes", "miércoles", "jueves", "viernes", "sábado"]

SHORT_TRIP_SECONDS = 60
LONG_TRIP_SECONDS = 3600
DURATION_SHORT = "Very short trip (<1min)"
DURATION_LONG = "Very long trip (>1h)"
DURATION_NORMAL = "Normal trip"

HIGH_SPEED_MPH = 80
LOW_SPEED_MPH = 5
SPEED_HIGH = "High speed"
SPEED_LOW = "Low speed"
SPEED_NORMAL = "Normal speed"

TRIP_TYPE_SEPARATOR = " | "

DAY_BAND_FIRST_HOUR = 6
DAY_BAND_LAST_HOUR = 18
BAND_DAY = "diurno"
BAND_NIGHT = "nocturno"
# ---------------------------------------------------------------------------


def _lookup(code: Column, labels: dict[int, str], default: str) -> Column:
    expr = None
    for value, text in labels.items():
        expr = (F.when(code == value, text) if expr is None else expr.when(code == value, text))
    return expr.otherwise(default)


def payment_label(code: Column) -> Column:
    """C14: payment code -> text; null and unknown codes -> 'Other'."""
    return _lookup(code, PAYMENT_LABELS, PAYMENT_DEFAULT)


def rate_label(code: Column) -> Column:
    """Rate code -> text; null and unknown codes -> 'Unknown'."""
    return _lookup(code, RATE_LABELS, RATE_DEFAULT)


def duration_flag(seconds: Column) -> Column:
    """C17: both bounds (60 s and 3600 s) count as normal."""
    return (
        F.when(seconds < SHORT_TRIP_SECONDS, DURATION_SHORT)
        .when(seconds > LONG_TRIP_SECONDS, DURATION_LONG)
        .otherwise(DURATION_NORMAL)
    )


def speed_flag(mph: Column) -> Column:
    """A null speed is 'Normal speed', as in a searched CASE."""
    return (
        F.when(mph > HIGH_SPEED_MPH, SPEED_HIGH)
        .when(mph < LOW_SPEED_MPH, SPEED_LOW)
        .otherwise(SPEED_NORMAL)
    )


def day_name(date: Column) -> Column:
    """Spanish weekday name; Spark's dayofweek is 1 for Sunday."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.dayofweek(date))


def day_band(hour: Column) -> Column:
    """Hours 6..18 inclusive are daytime."""
    return F.when(hour.between(DAY_BAND_FIRST_HOUR, DAY_BAND_LAST_HOUR), BAND_DAY).otherwise(BAND_NIGHT)


def trip_type_label(duration: Column, speed: Column) -> Column:
    """Null-propagating concatenation."""
    return F.concat(duration, F.lit(TRIP_TYPE_SEPARATOR), speed)
