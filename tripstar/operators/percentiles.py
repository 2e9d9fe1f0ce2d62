"""Exact values at given ranks by histogram selection.

Sorting a group to find two of its values moves everything and puts a hot group in
one task.  Here the rows are counted twice, both times with map-side combine:

1. rows per (group, bucket), where a bucket is a monotone function of the value:
   its sign and the logarithm of its size, ``PER_OCTAVE`` buckets for every doubling.
   The buckets of a group are a bounded number of rows; their running sum tells
   which bucket holds each wanted rank, and the rank inside it.
2. rows per (group, bucket, value), for those buckets only.  The running sum inside
   a bucket gives the value.

Nothing is sorted but the distinct values of the wanted buckets (a thousandth of the
value's size wide), and nothing is written.

:func:`percentile_cont` is exactly SQL's: ``(ceil - pos) * lower + (pos - floor) *
upper`` at ``pos = p * (n - 1)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_OCTAVE = 1024


def bucket_of(number: Column) -> Column:
    """A whole number that never falls as ``number`` rises; NaN stands above all numbers."""
    x = number.cast("double")
    size = F.floor(F.log2(F.abs(x) + 1) * PER_OCTAVE)
    top = F.lit(1 << 40).cast("long")
    finite = F.when(F.abs(x) == float("inf"), top).otherwise(size)
    return F.when(F.isnan(x), top + 1).when(x < 0, -1 - finite).otherwise(finite)


def values_at(df: DataFrame, group_cols: list[str], value_col: str, ranks: dict[str, Callable[[Column], Column]],
              number: Column | None = None, weight_col: str | None = None) -> DataFrame:
    """One row per group: ``_all`` (its rows with a value) and, per entry of ``ranks``,
    the value at that position (from 0) of its ascending order.

    An entry is a function of the number of rows.  ``number`` is a numeric column in
    the order of ``value_col`` (default: that column).  With ``weight_col`` a row
    stands for that many rows.  Groups compare null-safely.
    """
    bucket = bucket_of(F.col(value_col) if number is None else number)
    groups = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)]
    own = [f"_g{i}" for i in range(len(group_cols))]
    weight = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    rows = df.where(F.col(value_col).isNotNull()).select(*groups, bucket.alias("_b"), F.col(value_col).alias("_v"), weight.alias("_w"))

    counts = rows.groupBy(*own, "_b").agg(F.sum("_w").alias("_n"))
    inside = Window.partitionBy(*own, F.lit(0))
    upto = counts.withColumns({
        "_end": F.sum("_n").over(inside.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_all": F.sum("_n").over(inside)})
    names = list(ranks)
    wanted = upto.withColumn("_r", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), ranks[n](F.col("_all")).cast("long").alias("at")) for i, n in enumerate(names)])))
    held = (F.col("_r.at") >= F.col("_end") - F.col("_n")) & (F.col("_r.at") < F.col("_end"))
    wanted = wanted.where(held).select(*own, "_b", "_all", F.col("_r.i").alias("_i"), (F.col("_r.at") - F.col("_end") + F.col("_n")).alias("_at"))
    # a row per group and bucket that is wanted, with the ranks in it
    buckets = wanted.groupBy(*own, "_b", "_all").agg(F.collect_list(F.struct("_i", "_at")).alias("_ranks"))
    buckets = buckets.toDF(*[f"_h{i}" for i in range(len(own))], "_hb", "_all", "_ranks")
    match = reduce(lambda a, b: a & b, [F.col(f"_g{i}").eqNullSafe(F.col(f"_h{i}")) for i in range(len(own))], F.col("_b") == F.col("_hb"))
    values = rows.join(buckets.select(*[f"_h{i}" for i in range(len(own))], "_hb"), match, "left_semi").groupBy(*own, "_b", "_v").agg(
        F.sum("_w").alias("_n"))
    by_value = Window.partitionBy(*own, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("_end", F.sum("_n").over(by_value)).join(buckets, match)
    hit = values.select(*own, "_all", "_v", "_n", "_end", F.explode("_ranks").alias("_r"))
    hit = hit.where((F.col("_r._at") >= F.col("_end") - F.col("_n")) & (F.col("_r._at") < F.col("_end")))
    picked = hit.groupBy(*own, "_all").agg(*[F.max(F.when(F.col("_r._i") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])
    return picked.select(*[F.col(g).alias(c) for g, c in zip(own, group_cols, strict=True)], "_all", *names)


def percentile_cont(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: dict[str, float], weight_col: str | None = None) -> DataFrame:
    """One row per group with a column per entry of ``probs`` (name -> p).

    With ``weight_col`` each input row stands for that many rows (input that
    is already reduced to value counts); a value may appear in several rows.
    """
    def at(p: float, side: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda n: side(F.lit(float(p)) * (n - 1))

    ranks = {f"_lo_{n}": at(p, F.floor) for n, p in probs.items()} | {f"_hi_{n}": at(p, F.ceil) for n, p in probs.items()}
    edges = values_at(df, group_cols, value_col, ranks, weight_col=weight_col)
    cols = []
    for name, p in probs.items():
        x = F.lit(float(p)) * (F.col("_all") - 1)
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        mixed = (F.ceil(x) - x) * lo + (x - F.floor(x)) * hi
        cols.append(F.when(F.ceil(x) == F.floor(x), lo).otherwise(mixed).alias(name))
    return edges.select(*group_cols, *cols)
