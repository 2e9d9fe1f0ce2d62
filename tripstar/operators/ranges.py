"""Work over a total order, cut into ranges of equal size.

A window without a partition, or over one hot group, is a single task.  These
helpers range-partition the rows, pin the ranges with one write to the shared
folder (so every later pass, and a retry after a lost executor, sees the same
ranges), work inside the ranges and carry what crosses a border in a table of
one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import COMPRESSION, scratch_path

RANGE = "_range"


def pinned_ranges(df: DataFrame, order: list[Column], ranges: int | None = None, computed: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with ``_range``: a written copy, range-partitioned by ``order``; ``computed`` columns are added behind the shuffle."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(ranges, *order).withColumns({**(computed or {}), RANGE: F.spark_partition_id()}).write.option("compression", COMPRESSION).parquet(path)
    return spark.read.parquet(path)


def running_sum(df: DataFrame, groups: list[str], order: list[Column], weight: str, name: str,
                ranges: int | None = None) -> DataFrame:
    """``df`` plus ``name``: the sum of ``weight`` up to this row within its group.

    ``order`` must be total within a group.  Inside a range the sum is a window
    over (range, group); the sums of earlier ranges come from a table with one row
    per (range, group), which has at most #ranges + #groups rows.
    """
    keys = [F.col(g).asc_nulls_last() for g in groups]
    pinned = pinned_ranges(df, [*keys, *order], ranges)
    parts = [F.coalesce(F.col(g).cast("string"), F.lit("")) for g in groups]
    nulls = [F.col(g).isNull() for g in groups]
    tagged = pinned.withColumn("_group", F.struct(*[x.alias(f"g{i}") for i, x in enumerate([F.lit(0), *parts, *nulls])]))
    inside = Window.partitionBy(RANGE, "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.withColumn(name, F.sum(weight).over(inside))
    sums = tagged.groupBy(RANGE, "_group").agg(F.sum(weight).alias("_sum"))
    earlier = Window.partitionBy("_group").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(RANGE, "_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    out = local.join(offsets, [RANGE, "_group"])
    return out.select(*df.columns, (F.col(name) + F.col("_before")).alias(name))


def numbered(df: DataFrame, order: list[Column], name: str, ranges: int | None = None) -> DataFrame:
    """``row_number()`` over the whole of ``df`` as a long in front of its columns."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return running_sum(ones, [], order, "_one", name, ranges).select(F.col(name).cast("long").alias(name), *df.columns)
