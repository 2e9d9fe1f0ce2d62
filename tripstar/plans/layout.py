"""Clustered layout of the fact table.

The reference clusters the fact by (pickup_date_sk, pickup_zone_sk,
service_type_sk) so that filters on those keys scan few micro-partitions.  The
Spark equivalent is a range-partitioned, sorted Parquet write: every file and
row group then covers a narrow key range, and Parquet min/max statistics let
the scan skip row groups (``PushedFilters``).  Range boundaries come from
sampling, so a hot key range is split across files instead of landing in one.

Sorting by the keys one after the other only helps filters on the first of them.
With a curve, rows are sorted by an index whose bits are taken from the keys in
turn (:func:`curve_index`): each key's values are ranked into 2**bits buckets of
about equal numbers of rows, and the schedule names the key that gives the next
bit.  The schedule may favour a key at the coarse end, where the row groups of a
small table are, and still give the others their bits as the table grows.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..operators.packing import own_stage, pack
from ..operators.ranges import running_sum
from ..session import COMPRESSION, scratch_path

CURVE = "_curve"
_PACKED = "_packed"


def curve_buckets(weights: DataFrame, schedule: tuple[str, ...]) -> DataFrame:
    """(key, value, bucket) of every value of the keys: its rank among the rows of ``weights``.

    One pass counts all keys (whole numbers, null allowed) together; the running
    sums are cut into ranges, so a key may have any number of values.
    """
    bits = Counter(schedule)
    keys = list(bits)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("key"), F.col(k).cast("long").alias("value")) for i, k in enumerate(keys)]))
    counts = weights.select(cells.alias("c")).groupBy("c.key", "c.value").agg(F.count(F.lit(1)).alias("n"))
    upto = running_sum(counts, ["key"], [F.col("value").asc_nulls_first()], "n", "upto")
    rows = counts.groupBy("key").agg(F.sum("n").alias("rows"))
    width = F.element_at(F.array(*[F.lit(1 << bits[k]) for k in keys]), F.col("key") + 1)
    return upto.join(rows, "key").select("key", "value", F.floor((F.col("upto") - F.col("n")) * width / F.col("rows")).cast("long").alias("bucket"))


def curve_index(df: DataFrame, schedule: tuple[str, ...], weights: DataFrame | None = None, name: str = CURVE) -> DataFrame:
    """``df`` with ``name``: the keys' bucket bits, interleaved as ``schedule`` says, most significant first.

    ``weights`` (default ``df``) is what the buckets are ranked by; it must hold every
    key value of ``df`` or the value goes to the first bucket.
    """
    if len(schedule) > 62:
        raise ValueError("a curve index has 62 bits at most")
    # written, so that the planner knows how small it is before it moves any row of df
    path = scratch_path(df.sparkSession, "curve-buckets")
    curve_buckets(df if weights is None else weights, schedule).write.parquet(path)
    buckets = df.sparkSession.read.parquet(path)
    left = Counter(schedule)
    keys = list(left)
    out = df
    for i, k in enumerate(keys):
        own = buckets.where(F.col("key") == i).select(F.col("value").alias(f"_v{i}"), F.col("bucket").alias(f"_b{i}"))
        out = out.join(own, F.col(k).cast("long").eqNullSafe(F.col(f"_v{i}")), "left").drop(f"_v{i}")
    index: Column = F.lit(0).cast("long")
    for k in schedule:
        left[k] -= 1
        bit = F.shiftright(F.coalesce(F.col(f"_b{keys.index(k)}"), F.lit(0).cast("long")), left[k]).bitwiseAND(F.lit(1).cast("long"))
        index = F.shiftleft(index, 1).bitwiseOR(bit)
    return out.withColumn(name, index).drop(*[f"_b{i}" for i in range(len(keys))])


def clustered(df: DataFrame, keys: list[str] | tuple[str, ...], files: int,
              tiebreak: str | None = None) -> DataFrame:
    """Range-partition and sort by ``keys``.

    Range partitioning never splits one key value, so a single (date, zone,
    service) holding a third of all rows would be one task and one file.  A
    well-spread ``tiebreak`` column (the trip id, an MD5) as the last range key
    lets such a value span several files; each file still covers a narrow,
    sorted key range.
    """
    keys, columns = list(keys), df.columns
    if not tiebreak or tiebreak not in columns:
        return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    # lower-case hexadecimal moves as half as many bytes, in the same order; other text as it is
    text = F.col(tiebreak)
    if dict(df.dtypes)[tiebreak] != "string":
        return df.repartitionByRange(files, *keys, tiebreak).sortWithinPartitions(*keys, tiebreak)
    packed = df.withColumn(_PACKED, F.when(F.lower(F.hex(F.unhex(text))) == text, F.unhex(text)))
    packed = packed.withColumn(tiebreak, F.when(F.col(_PACKED).isNull(), text))
    ranged = packed.repartitionByRange(files, *keys, _PACKED, tiebreak).sortWithinPartitions(*keys, _PACKED, tiebreak)
    return ranged.withColumn(tiebreak, F.coalesce(text, F.lower(F.hex(_PACKED)))).select(*columns)


# Input bytes (compressed) per clustered output file: a task sorts one in memory.
BYTES_PER_FILE = 48 * 1024 * 1024


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the Parquet files under ``path`` (binaryFile listing;
    only the ``length`` column is read, not the contents)."""
    sizes = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(path)
        .agg(F.sum("length").alias("bytes"))
    )
    return int(sizes.first()["bytes"] or 0)


def files_for(spark: SparkSession, input_path: str, bytes_per_file: int = BYTES_PER_FILE) -> int:
    """Output files for a table derived from ``input_path``: one per
    ``bytes_per_file`` of input, and at least one per core so that the range
    partitioning still spreads the sort."""
    by_size = -(-path_bytes(spark, input_path) // bytes_per_file)
    return max(int(by_size), spark.sparkContext.defaultParallelism, 1)


def write_clustered(
    df: DataFrame,
    path: str,
    cfg: PipelineConfig = DEFAULT,
    files: int | None = None,
    keys: list[str] | tuple[str, ...] | None = None,
    row_group_bytes: int | None = None,
    tiebreak: str | None = "trip_id",
    weights: DataFrame | None = None,
    derived: dict[str, Column] | None = None,
    usual: dict[str, Column] | None = None,
    words: list[dict[str, int]] | None = None,
) -> None:
    """Overwrite ``path`` with ``df`` clustered by ``keys``; by default by the fact's
    curve and, inside its cells, by the fact's keys.

    Columns that follow from others of their row (``derived``) are computed again where
    the row is written instead of being moved; those that nearly always do (``usual``) are moved
    where they differ.  ``words`` names numbers that are moved together
    (:mod:`..operators.packing`).  None of these are keys."""
    if files is None:
        files = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    columns, derived, usual = df.columns, derived or {}, usual or {}
    df = df.drop(*derived)
    # a null struct where the value is the usual one
    df = df.withColumns({c: F.when(~F.col(c).eqNullSafe(v), F.struct(F.col(c).alias("as_is"))) for c, v in usual.items()})
    if keys:
        packed = pack(df, words or [])
        rows = clustered(packed.rows, keys, files, tiebreak)
    else:
        packed = pack(curve_index(df, cfg.cluster_curve, weights), words or [])
        rows = clustered(packed.rows, [CURVE, *cfg.cluster_keys], files, tiebreak).drop(CURVE)
    if words:
        rows = own_stage(packed.unpack(own_stage(rows)))
    rows = rows.withColumns({c: F.when(F.col(c).isNotNull(), F.col(c)["as_is"]).otherwise(v) for c, v in usual.items()})
    rows = rows.withColumns(derived).select(*columns)
    writer = rows.write.mode("overwrite").option("compression", COMPRESSION)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)

