"""Median imputation (F8, the sample transformer; C25 column subset).

Each column's nulls are replaced by the element at index ``floor(n / 2)`` of
its sorted non-null values — the upper median for even ``n`` — which is
``percentile_disc(0.5)`` over the values in *descending* order.

All columns go through the same two counts (:func:`.percentiles.values_at`), so no
task holds the values of a column.  The medians are one row, used as a scalar of the
plan.  A column with no values stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .percentiles import values_at

SAMPLE_NUMERIC_COLUMNS = ["Age", "Fare", "Parch", "Pclass", "SibSp", "Survived"]


def upper_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the upper median of every column, in the columns' types."""
    types = {f.name: f.dataType for f in df.schema.fields}
    # integers travel as longs and the rest as doubles, so no value is rounded
    whole = {c: isinstance(types[c], T.IntegralType) for c in columns}
    cells = [F.struct(
        F.lit(i).alias("i"),
        (F.col(f"`{c}`").cast("long") if whole[c] else F.lit(None).cast("long")).alias("l"),
        (F.lit(None).cast("double") if whole[c] else F.col(f"`{c}`").cast("double")).alias("d")) for i, c in enumerate(columns)]
    values = df.select(F.explode(F.array(*cells)).alias("x")).select("x.*").where("l is not null or d is not null")
    values = values.select("i", F.struct("l", "d").alias("v"))
    number = F.coalesce(F.col("v.l").cast("double"), F.col("v.d"))
    found = values_at(values, ["i"], "v", {"m": lambda n: F.floor(n / 2)}, number=number)
    picks = [F.max(F.when(F.col("i") == i, F.col("m.l") if whole[c] else F.col("m.d"))).cast(types[c]).alias(c)
             for i, c in enumerate(columns)]
    return found.agg(*picks)


def fill_with_median(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    medians = upper_medians(df, columns)
    row = medians.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("m")).scalar()
    return df.select(*[F.coalesce(F.col(f"`{c}`"), row[c]).alias(c) for c in columns])


def sample_transform(passengers: DataFrame) -> DataFrame:
    """The reference's sample block: numeric subset, then median fill."""
    return fill_with_median(passengers.select(*SAMPLE_NUMERIC_COLUMNS))
