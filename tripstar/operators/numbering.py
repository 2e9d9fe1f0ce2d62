"""Duplicate ordinal (G1): ``row_number`` per natural key, balanced for any key.

The reference numbers trips with ``row_number() over (partition by <natural
key> order by ...)``.  Written literally, all rows are shuffled and sorted, and every
row of one natural key lands in one task, though nearly every key is unique.

First the rows are split.  Keys are reduced to 40-bit hashes and counted; the hashes
that occur more than once are written as a table.  A row whose hash is not in it is
alone: its ordinal is 1, without a window and without moving it.  A collision only
sends two more rows to the exact path.  The table of shared hashes is broadcast if its
counted size is at most ``BROADCAST_ROWS``.  Beyond that it is sent as bits
(:mod:`.bitmaps`), which let a few rows through that are alone; these are numbered with
the others.  Either way no full row is shuffled for the split.

The shared rows are cut into ranges of equal size of the total order

    natural key, remaining columns, position

so a key with any share of the rows, copies included, spreads over as many
ranges as it needs.  There is no sample, threshold or cap in a result.

1. ``repartitionByRange`` on that order, written once to the shared folder, so
   that everything below sees the same ranges, also after a lost executor.
2. ``row_number`` inside (range, key): a group is never larger than its range.
3. A key can continue only from the last key of a range into the first keys of
   the next ones.  One row per range (first key, last key, rows of the last key)
   gives the offset of each range's first key; that table, one row per range, is
   broadcast and added.

The ordinal follows the remaining columns, ascending with nulls last.  The
position only settles the order of *identical* rows, which are interchangeable:
the mapping from row content to ordinals is the same in every run, whatever the
files or partitions.  Signed zeros compare equal, as they do in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .bitmaps import flag_members, write_bitmaps
from .ranges import RANGE, pinned_ranges

_TIE, _KEY, _RN, _HASH, _SEVERAL = "_tie", "_key", "_rn", "_key_hash", "_several"
# Bits of a key's hash: fewer bytes move, and the few collisions are settled with the shared rows.
_HASH_MASK = (1 << 40) - 1
# Shared key hashes (8 bytes each) that are broadcast at most.
BROADCAST_ROWS = 4_000_000


def number_within_key(
    df: DataFrame,
    key_cols: list[str],
    order_cols: list[str] | None = None,
    ordinal_col: str = "ordinal",
    ranges: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    *,
    computed: dict[str, Column] | None = None,
) -> DataFrame:
    """Return ``df`` with ``ordinal_col`` = 1..n inside each group of ``key_cols``.

    ``order_cols`` defaults to all other columns; keys compare null-safely.
    ``computed`` are key columns that follow from the columns of ``df``: they are added,
    and computed again behind the ranges' shuffle instead of being moved there.
    ``ranges`` (default ``spark.sql.shuffle.partitions``) only sets how finely the
    work is cut, ``broadcast_rows`` how the shared rows are found.  ``df`` is read
    several times, so it should be a written table or a cheap plan over one.
    """
    computed = computed or {}
    df = df.withColumns(computed)
    if order_cols is None:
        order_cols = [c for c in df.columns if c not in key_cols]
    types = {f.name: f.dataType for f in df.schema.fields}
    alone, shared = split_by_key(df, key_cols, broadcast_rows)
    several = _number_shared(shared, types, key_cols, order_cols, ordinal_col, ranges, computed)
    return alone.withColumn(ordinal_col, F.lit(1).cast("long")).unionByName(several)


def split_by_key(df: DataFrame, key_cols: list[str], broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows whose key certainly occurs once, all other rows); no row is moved."""
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    keyed = df.withColumn(_HASH, F.xxhash64(*[_plain(F.col(c), types[c]) for c in key_cols]).bitwiseAND(F.lit(_HASH_MASK)))
    path = scratch_path(spark, "shared-keys")
    counts = keyed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("_n"))
    counts.where(F.col("_n") > 1).select(_HASH).write.parquet(path)
    shared = spark.read.parquet(path)
    several = shared.count()
    if several <= broadcast_rows:
        shared = F.broadcast(shared)
        return keyed.join(shared, _HASH, "left_anti").drop(_HASH), keyed.join(shared, _HASH, "left_semi").drop(_HASH)
    flagged = flag_members(keyed, F.col(_HASH), write_bitmaps(shared, _HASH, several), _SEVERAL).drop(_HASH)
    return flagged.where(~F.col(_SEVERAL)).drop(_SEVERAL), flagged.where(_SEVERAL).drop(_SEVERAL)


def _number_shared(df: DataFrame, types: dict[str, T.DataType], key_cols: list[str], order_cols: list[str],
                   ordinal_col: str, ranges: int | None, computed: dict[str, Column]) -> DataFrame:
    content = df.columns
    order = [_plain(F.col(c), types[c]).asc_nulls_last() for c in [*key_cols, *order_cols]]

    # 1. the ranges, pinned by one write
    moved = df.drop(*computed).withColumn(_TIE, F.monotonically_increasing_id())
    by = [_plain(computed.get(c, F.col(c)), types[c]).asc_nulls_last() for c in [*key_cols, *order_cols]]
    pinned = pinned_ranges(moved, [*by, F.col(_TIE)], ranges, computed)

    # 2. numbers inside (range, key)
    keys = [_plain(F.col(c), types[c]) for c in key_cols]
    inside = Window.partitionBy(RANGE, *keys).orderBy(*order[len(key_cols):], F.col(_TIE))
    numbered = pinned.withColumns({_RN: F.row_number().over(inside), _KEY: _sortable(keys)})

    # 3. where each range's first key starts
    edges = _edges(pinned.select(RANGE, _sortable(keys).alias(_KEY)))
    out = numbered.join(F.broadcast(edges), RANGE)
    offset = F.when(F.col(_KEY) == F.col("_first"), F.col("_before")).otherwise(F.lit(0))
    return out.select(*content, (F.col(_RN) + offset).cast("long").alias(ordinal_col))


def _plain(c: Column, dtype: T.DataType) -> Column:
    """Column with one zero: -0.0 and 0.0 are equal in SQL but not in a range."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(c == 0, F.lit(0.0).cast(dtype)).otherwise(c)
    return c


def _sortable(keys: list[Column]) -> Column:
    """The key as one struct that is never null and sorts nulls last."""
    return F.struct(*[x for i, k in enumerate(keys) for x in (k.isNull().alias(f"n{i}"), k.alias(f"k{i}"))])


def _edges(keyed: DataFrame) -> DataFrame:
    """Per range: its first key and how many rows of it lie in earlier ranges."""
    ends = keyed.groupBy(RANGE).agg(F.min(_KEY).alias("_first"), F.max(_KEY).alias("_last"))
    # rows of each range's last key: at most one group per range survives the join
    last = keyed.join(F.broadcast(ends.select(RANGE, "_last")), RANGE).where(F.col(_KEY) == F.col("_last"))
    last = last.groupBy(RANGE, "_last").agg(F.count(F.lit(1)).alias("_rows"))
    # a running sum over the ranges that end with the same key; a range's first key
    # can only continue the last key of the range just before it
    run = Window.partitionBy("_last").orderBy(RANGE)
    sums = last.select(RANGE, F.sum("_rows").over(run).alias("_sum"))
    one_row_per_range = Window.orderBy(RANGE)
    before = ends.join(sums, RANGE).withColumns({
        "_left": F.lag("_last").over(one_row_per_range), "_carried": F.lag("_sum").over(one_row_per_range)})
    return before.select(RANGE, "_first", F.when(F.col("_left") == F.col("_first"), F.col("_carried")).otherwise(F.lit(0)).alias("_before"))
