"""Trip identity.

The trip key is an MD5 over the natural key rendered as text plus the
duplicate ordinal (G1).  Numbers are rendered canonically — integers as plain
digits, fractional values with four decimals — so that any engine that follows
the same rule produces the same digest (plain double-to-text differs between
engines, e.g. ``1.0E7`` vs ``10000000.0``).  Fields are joined with a separator
so that different tuples cannot concatenate to the same text.

The ordinal must count rows of equal *text*: two amounts that differ only by
floating-point noise share their text, so numbering by the raw value would give
both ordinal 1 and one id.  :func:`key_texts` is therefore both what is numbered
and what is hashed.  Values outside decimal(38,4) — NaN, infinities, overflow —
keep their own text instead of becoming empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_SEPARATOR = "|"


def canonical_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a key part; null becomes the empty text, which no value has."""
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        fixed = c.try_cast("decimal(38,4)")
        # -0.0000 and 0.0000 are one amount
        text = F.when(fixed == 0, F.lit("0.0000")).otherwise(fixed.cast("string"))
        return F.coalesce(text, c.cast("string"), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def key_texts(parts: list[tuple[Column, T.DataType]]) -> Column:
    """The natural key as one text."""
    return F.concat_ws(KEY_SEPARATOR, *[canonical_text(c, t) for c, t in parts])


def trip_key(texts: Column, ordinal: Column) -> Column:
    return F.md5(F.concat_ws(KEY_SEPARATOR, texts, ordinal.cast("string")))
