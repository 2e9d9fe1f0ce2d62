"""Several small numbers of a row in one word, for as long as the row moves.

A shuffled row has eight bytes for every column, and its compression saves little of
them where neighbours differ.  :func:`pack` puts the named columns of a row into words of
63 bits: whole numbers and booleans as they are, doubles as hundredths where these give
back the very same double.  A row with a number that is negative, too large for its
bits or no number of hundredths moves that word's columns as they are, so any row comes
back unchanged from :meth:`Packed.unpack`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BITS = 63
_PARTITIONS = 1 << 20  # more than any table has
_KINDS = (T.IntegerType, T.LongType, T.BooleanType, T.DoubleType)


@dataclass(frozen=True)
class Packed:
    rows: DataFrame
    words: list[dict[str, int]]
    columns: list[str]
    types: dict[str, T.DataType]

    def unpack(self, df: DataFrame) -> DataFrame:
        """``df``, which has the columns of ``rows``, with the packed ones in their place."""
        if not self.words:
            return df
        out = {c: F.col(c) for c in df.columns if not c.startswith("_word")}
        for i, word in enumerate(self.words):
            offset = 0
            for c, bits in word.items():
                held = F.shiftright(F.col(f"_word_{i}"), offset).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) - 1
                value = held / F.lit(100.0) if isinstance(self.types[c], T.DoubleType) else held
                out[c] = F.coalesce(F.when(held >= 0, value.cast(self.types[c])), F.col(f"_word_{i}_as_is.{c}")).alias(c)
                offset += bits
        front = [c for c in self.columns if c in out]
        return df.select(*[out[c] for c in front], *[out[c] for c in out if c not in front])


def pack(df: DataFrame, words: list[dict[str, int]]) -> Packed:
    """``df`` with the columns of each word (name -> bits, null takes one of the numbers) packed.

    Columns that ``df`` does not have, or of another type, are left as they are.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    words = [w for w in ({c: b for c, b in word.items() if isinstance(types.get(c), _KINDS)} for word in words) if w]
    if any(sum(w.values()) > WORD_BITS for w in words):
        raise ValueError(f"a word has {WORD_BITS} bits")
    rows = df
    for i, word in enumerate(words):
        rows = own_stage(rows)
        rows = rows.withColumns({f"_number_{c}": _number(F.col(c), types[c], (1 << b) - 1) for c, b in word.items()})
        held, value, offset = [F.col(f"_number_{c}") for c in word], F.lit(0).cast("long"), 0
        for n, bits in zip(held, word.values(), strict=True):
            value = value.bitwiseOR(F.shiftleft(n, offset))
            offset += bits
        fits = reduce(Column.bitwiseOR, held) >= 0
        # nulls next to nulls compress to nothing, so all structs come first
        others = [c for c in rows.columns if c not in word and not c.startswith("_number_")]
        at = next((k for k, c in enumerate(others) if c == "_word_0"), len(others))
        as_is = F.when(~fits, F.struct(*word)).alias(f"_word_{i}_as_is")
        rows = rows.select(*others[:at], as_is, *others[at:], F.when(fits, value).alias(f"_word_{i}"))
    return Packed(rows, words, df.columns, types)


def own_stage(df: DataFrame) -> DataFrame:
    """``df`` as it is, with the work above it compiled apart from the work below.

    Spark fuses a chain of projections and lookups into one method; past some length the JVM
    interprets it instead of compiling it.  Merging partitions ends a method, and so many are not merged.
    """
    return df.coalesce(_PARTITIONS)


def _number(c: Column, dtype: T.DataType, most: int) -> Column:
    """What stands for ``c`` in a word: from 1 to ``most``, 0 for null, -1 if it does not fit."""
    if isinstance(dtype, T.DoubleType):
        # the first two also keep NaN from becoming a whole number; -0.0 equals 0.0, but its text does not
        near = F.floor(c * 100 + 0.5)
        fits = (c >= 0) & (c < (most - 1) / 100) & (near / F.lit(100.0) == c) & ((c > 0) | (c.cast("string") == "0.0"))
    else:
        near = c.cast("long")
        fits = (near >= 0) & (near < most)
    return F.when(fits, near + 1).when(c.isNull(), F.lit(0).cast("long")).otherwise(F.lit(-1).cast("long"))
