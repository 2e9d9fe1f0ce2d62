"""Which rows may hold one of many 64-bit hashes, without moving a row.

A set of hashes that is too large to be sent everywhere is sent as bits: every hash
sets one bit of a table with ``BITS_PER_HASH`` bits or more for each.  A row whose bit is not
set certainly holds none of them; of the others at most one in ``BITS_PER_HASH`` is let through
by chance, which an exact step behind it sorts out.  The table has ``MOST_BITS`` at most
(some 100 MB as a broadcast): with more hashes a greater share is let through, and the
result stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

BITS_PER_HASH = 32
MOST_BITS = 1 << 29
# 64-bit words in a row of the table: read in place, and few rows to look up.
_WORDS = 16
_BUCKET_BITS = 10  # of a place: 64 bits in a word, _WORDS words in a row


def write_bitmaps(hashes: DataFrame, column: str, count: int, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """(rows of bits, number of bits) for the ``count`` hashes in ``column``; repeats do no harm.

    ``most_bits`` is a power of two.
    """
    bits = min(1 << max(_BUCKET_BITS, (count * BITS_PER_HASH - 1).bit_length()), most_bits)
    bucket, word, bit = _place(F.col(column), bits)
    placed = hashes.select(bucket.alias("_bucket"), word.alias("_word"), bit.alias("_bit")).repartition("_bucket")
    words = [F.coalesce(F.bit_or(F.when(F.col("_word") == i, F.col("_bit"))), F.lit(0).cast("long")) for i in range(_WORDS)]
    path = scratch_path(hashes.sparkSession, "bitmaps")
    placed.groupBy("_bucket").agg(F.array(*words).alias("_words")).write.parquet(path)
    return hashes.sparkSession.read.parquet(path), bits


def flag_members(df: DataFrame, value: Column, bitmaps: tuple[DataFrame, int], flag: str) -> DataFrame:
    """``df`` with ``flag``: false where the hash ``value`` certainly is not in the set of ``bitmaps``."""
    table, bits = bitmaps
    bucket, word, bit = _place(value, bits)
    # each use has its own columns, so one table may be looked up for several values
    own = table.select(F.col("_bucket").alias(f"{flag}_bucket"), F.col("_words").alias(f"{flag}_words"))
    found = df.join(F.broadcast(own), bucket == F.col(f"{flag}_bucket"), "left")
    held = F.get(F.col(f"{flag}_words"), word.cast("int")).bitwiseAND(bit) != 0
    return found.withColumn(flag, F.coalesce(held, F.lit(False))).drop(f"{flag}_bucket", f"{flag}_words")


def _place(value: Column, bits: int) -> tuple[Column, Column, Column]:
    """(row of the table, word in it, bit in that) of a hash."""
    place = value.bitwiseAND(F.lit(bits - 1).cast("long"))
    word = F.shiftright(place, 6).bitwiseAND(F.lit(_WORDS - 1).cast("long"))
    return F.shiftright(place, _BUCKET_BITS), word, F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))
