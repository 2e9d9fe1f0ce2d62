"""Rows that may hold one of many hashes are found without moving a row."""

import os

import pytest
from pyspark.sql import functions as F

from tripstar.operators import numbering, quality
from tripstar.operators.bitmaps import flag_members, write_bitmaps
from tripstar.operators.numbering import split_by_key
from tripstar.session import checkpoint_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most_bits", [1 << 29, 1 << 12])
def test_every_member_is_let_through_and_few_others(spark, most_bits):
    df = spark.range(-6_000, 6_000).select("id", F.xxhash64("id").alias("h"))
    members = df.where("id % 40 = 0").select("h")
    flagged = flag_members(df, F.col("h"), write_bitmaps(members, "h", members.count(), most_bits), "held")
    assert flagged.columns == ["id", "h", "held"]
    got = {(r["member"], r["held"]): r["n"] for r in
           flagged.groupBy((F.col("id") % 40 == 0).alias("member"), "held").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(got.values()) == 12_000 and got[True, True] == 300 and (True, False) not in got
    assert got[False, True] <= 11_700 // 32 * 1.5 or most_bits < 300 * 32


def test_raw_numbers_zero_and_none_are_places_too(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,), (2**63 - 1,), (-(2**63),), (77,)], "h long")
    members = df.where("h <> 77")
    assert {r["h"]: r["held"] for r in flag_members(df, F.col("h"), write_bitmaps(members, "h", 5), "held").collect()} == {
        0: True, 1: True, -1: True, 2**63 - 1: True, -(2**63): True, 77: False}
    none = write_bitmaps(df.where("h is null"), "h", 0)
    assert flag_members(df, F.col("h"), none, "held").where("held").count() == 0


def test_a_split_beyond_the_broadcast_moves_and_writes_no_row(spark, tmp_path):
    rows = [(f"k{i}", i) for i in range(500)] + [(f"k{i}", -i) for i in range(60)] + [(None, 1), (None, 2)]
    spark.createDataFrame(rows, "k string, v long").write.parquet(str(tmp_path / "t"))
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    alone, shared = split_by_key(spark.read.parquet(str(tmp_path / "t")), ["k"], broadcast_rows=10)
    new = {n.rsplit("-", 1)[0] for n in set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) - before}
    assert new == {"shared-keys", "bitmaps"}  # hashes and bits, no copy of the rows
    for part in (alone, shared):
        assert "Exchange hashpartitioning" not in plan(part) and "BroadcastHashJoin" in plan(part)
    twice = {f"k{i}" for i in range(60)} | {None}
    assert sorted(map(repr, alone.union(shared).collect())) == sorted(repr(r) for r in spark.createDataFrame(rows, "k string, v long").collect())
    assert twice.isdisjoint({r["k"] for r in alone.collect()}) and shared.count() <= 122 + 440 // 16


def test_values_that_occur_once_are_not_counted_again(spark, monkeypatch):
    rows = [(f"a{i}", f"b{i}") for i in range(600)] + [(f"a{i}", None) for i in range(40)] + [(None, f"b{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "a string, b string")
    checks = [quality.Check("t", "a", "unique"), quality.Check("t", "b", "unique")]
    seen = []
    original = quality._duplicated
    monkeypatch.setattr(quality, "_duplicated", lambda t, k, twice: seen.append(t["t"].count()) or original(t, k, twice))
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 10)
    assert {r["column"]: r["failing_rows"] for r in quality.run_checks(df, checks).collect()} == {"a": 40, "b": 30}
    assert 110 <= seen[0] <= 250  # 670 rows before


def test_computed_keys_are_numbered_and_do_not_move(spark, monkeypatch):
    rows = [(i % 4, float(i % 3), i % 5) for i in range(90)] + [(100 + i, -0.0, 1) for i in range(15)] + [(None, None, 2)] * 3
    df = spark.createDataFrame(rows, "a int, w double, v int")
    text = F.concat_ws("|", F.col("a").cast("string"), F.round("w", 1).cast("string"))
    moved = []
    original = numbering.pinned_ranges
    monkeypatch.setattr(numbering, "pinned_ranges", lambda rows, *a: moved.append(rows.columns) or original(rows, *a))
    for ranges, broadcast_rows in ((1, 1000), (6, 1000), (6, 0)):
        got = numbering.number_within_key(df, ["t"], ["v", "a", "w"], ranges=ranges, broadcast_rows=broadcast_rows, computed={"t": text})
        plain = numbering.number_within_key(df.withColumn("t", text), ["t"], ["v", "a", "w"], ranges=ranges)
        assert got.columns == plain.columns and sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    assert "t" not in moved[0] and "t" in moved[1]
