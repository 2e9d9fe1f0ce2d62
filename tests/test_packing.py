"""Numbers that move in one word come back as they were, whatever they are."""

import math

import pytest
from pyspark.sql import functions as F

from tripstar.operators.packing import pack

WORDS = [{"i": 4, "b": 2, "d": 12}, {"l": 20, "missing": 3, "e": 30, "text": 5}]
SCHEMA = "k long, i int, b boolean, d double, l long, e double, text string"
DOUBLES = [0.0, -0.0, 0.01, 0.07 * 10, 0.1 + 0.2, 1e-9, 12.34, 12.340000000001, 39.94, 39.95, 40.95, 1e300, -1.25, math.nan, math.inf, -math.inf, None]
WHOLE = [0, 1, -1, 13, 14, 15, 16, 2**20 - 2, 2**20 - 1, 2**31 - 1, -(2**31), None]


def _text(rows):
    return sorted(repr(tuple(r)) for r in rows)


def test_any_row_comes_back(spark):
    n = max(len(DOUBLES), len(WHOLE))
    rows = [(i, WHOLE[i % len(WHOLE)], [True, False, None][i % 3], d, WHOLE[(i + j) % len(WHOLE)], DOUBLES[(i * 5 + j) % len(DOUBLES)], f"t{i}")
            for j in range(3) for i, d in ((i, DOUBLES[i % len(DOUBLES)]) for i in range(n))]
    rows += [(99, 1, True, 0.5, 2**63 - 1, 0.25, None), (99, 1, True, 0.5, -(2**63), 0.25, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    packed = pack(df, WORDS)
    back = packed.unpack(packed.rows.repartition(3))
    assert back.schema.simpleString() == df.schema.simpleString()
    assert _text(back.collect()) == _text(df.collect())
    for other in packed.unpack(packed.rows.withColumn("added", F.lit(1))).columns[:7], df.columns:
        assert other == df.columns


def test_small_numbers_move_in_words_and_nothing_else(spark):
    df = spark.createDataFrame([(1, 3, True, 4.05, 500, 104949.5, "t"), (2, None, None, None, None, None, None)], SCHEMA)
    packed = pack(df, WORDS)
    assert packed.rows.columns == ["k", "text", "_word_0_as_is", "_word_1_as_is", "_word_0", "_word_1"]
    assert packed.rows.where("_word_0 is null or _word_1 is null or _word_0_as_is is not null or _word_1_as_is is not null").count() == 0


def test_no_words_and_words_that_are_too_long(spark):
    df = spark.range(3)
    packed = pack(df, [{"other": 5}])
    assert packed.unpack(packed.rows).columns == ["id"] and packed.rows.columns == ["id"]
    with pytest.raises(ValueError):
        pack(df, [{"id": 64}])
