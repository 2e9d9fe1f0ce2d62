"""The range-cut duplicate ordinal equals a plain row_number, whatever the key sizes."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripstar.operators.numbering import number_within_key, split_by_key
from tripstar.operators.ranges import numbered, running_sum
from tripstar.session import scratch_tables

SCHEMA = "k1 string, k2 int, v string, w double"


def _rows():
    rows = [("hot", 1, f"v{i % 7}", float(i % 3)) for i in range(60)]  # hot key with copies
    rows += [("hot", 1, "v0", 0.0)] * 25  # a large group of identical copies
    rows += [(None, 2, "a", None), (None, 2, "a", None), (None, 2, "b", 1.0)]  # null key part
    rows += [(f"k{i}", i, "x", 1.0) for i in range(20)]  # unique keys
    return rows


def _expected(df):
    w = Window.partitionBy("k1", "k2").orderBy(F.col("v").asc_nulls_last(), F.col("w").asc_nulls_last())
    return df.withColumn("ordinal", F.row_number().over(w))


def _multiset(df):
    return sorted((r.k1 or "", r.k2, r.v if r.v is not None else "\x00", r.w if r.w is not None else -1.0, r.ordinal)
                  for r in df.collect())


def test_equals_row_number_for_any_number_of_ranges(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    expected = _multiset(_expected(df))
    for ranges in (1, 2, 7, 40):  # with 40 ranges the hot key spans many of them
        for broadcast_rows in (0, 1000):  # joined once and written, or broadcast
            got = number_within_key(df, ["k1", "k2"], ranges=ranges, broadcast_rows=broadcast_rows)
            assert _multiset(got) == expected, (ranges, broadcast_rows)


def test_only_shared_keys_are_numbered_and_nothing_is_shuffled_for_the_split(spark, tmp_path):
    spark.createDataFrame(_rows(), SCHEMA).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    alone, shared = split_by_key(df, ["k1", "k2"])
    assert alone.count() == 20 and shared.count() == 88
    for part in (alone, shared):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_scratch_tables_are_removed(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    with scratch_tables(spark):
        out = number_within_key(df, ["k1", "k2"])
        assert out.count() == 108
        used = {os.path.dirname(f).removeprefix("file:").replace("//", "") for f in out.inputFiles()}
        assert used and all(os.path.isdir(p) for p in used)
    assert not any(os.path.exists(p) for p in used)


def test_a_key_that_spans_all_ranges_is_spread(spark):
    df = spark.range(20_000).select(F.lit("one").alias("k1"), F.lit(1).alias("k2"), (F.col("id") % 5).cast("string").alias("v"))
    out = number_within_key(df, ["k1", "k2"], ranges=16)
    assert out.agg(F.countDistinct("ordinal"), F.min("ordinal"), F.max("ordinal")).first()[:] == (20_000, 1, 20_000)
    by_value = {r.v: (r.lo, r.hi) for r in out.groupBy("v").agg(F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi")).collect()}
    assert by_value == {str(i): (i * 4000 + 1, (i + 1) * 4000) for i in range(5)}


def test_mapping_survives_other_files_and_partitions(spark, tmp_path):
    df = spark.createDataFrame(_rows(), SCHEMA)
    first = _multiset(number_within_key(df, ["k1", "k2"], ranges=5))
    for n in (1, 3, 8):
        df.repartition(n, F.rand(seed=n)).write.mode("overwrite").parquet(str(tmp_path / f"p{n}"))
        again = spark.read.parquet(str(tmp_path / f"p{n}"))
        assert _multiset(number_within_key(again, ["k1", "k2"], ranges=n + 1)) == first


_row = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2),
                 st.sampled_from(["x", "y", None]), st.sampled_from([0.0, 1.5, None]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(_row, min_size=1, max_size=40), ranges=st.integers(1, 12))
def test_property_equals_row_number(spark, rows, ranges):
    df = spark.createDataFrame(rows, SCHEMA)
    assert _multiset(number_within_key(df, ["k1", "k2"], ranges=ranges)) == _multiset(_expected(df))


def test_signed_zero_keys_are_one_key(spark):
    df = spark.createDataFrame([("a", 1, "x", 0.0), ("a", 1, "y", -0.0)], SCHEMA)
    for ranges in (1, 4):
        got = number_within_key(df, ["k1", "k2", "w"], ranges=ranges)
        assert sorted((r.v, r.ordinal) for r in got.collect()) == [("x", 1), ("y", 2)]


def test_empty_input(spark):
    assert number_within_key(spark.createDataFrame([], SCHEMA), ["k1"]).count() == 0


def test_numbers_over_the_whole_table_are_dense_and_ordered(spark):
    vals = [(i * 7 % 1000,) for i in range(1000)] + [(None,)]
    df = spark.createDataFrame(vals, "v int").repartition(7)
    out = numbered(df, [F.col("v").asc_nulls_last()], "sk").collect()
    by_sk = sorted((r.sk, r.v) for r in out)
    assert [sk for sk, _ in by_sk] == list(range(1, 1002))
    assert [v for _, v in by_sk[:-1]] == sorted(v for (v,) in vals if v is not None)
    assert by_sk[-1][1] is None  # nulls last


def test_running_sum_over_a_group_that_spans_ranges(spark):
    rows = [("a", i, i % 4) for i in range(300)] + [(None, i, 1) for i in range(9)] + [("", 1, 5), ("", 2, 7)]
    df = spark.createDataFrame(rows, "g string, v int, n long")
    got = {(r.g, r.v): r.s for r in running_sum(df, ["g"], [F.col("v")], "n", "s", ranges=11).collect()}
    expected, total = {}, {}
    for g, v, n in rows:
        total[g] = total.get(g, 0) + n
        expected[g, v] = total[g]
    assert got == expected
