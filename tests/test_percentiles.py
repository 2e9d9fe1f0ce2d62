"""Skew-balanced percentile_cont equals Spark's exact percentile."""

import random

from pyspark.sql import functions as F

from tripstar.operators.percentiles import bucket_of, percentile_cont, values_at


def test_matches_builtin_percentile(spark):
    rows = [("hot", float(v % 97)) for v in range(5000)] + [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0)]
    rows += [("one", 7.0), ("b", None), ("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p50, r.p90) for r in percentile_cont(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}).collect()}
    exp = {r.g: (r.p50, r.p90) for r in df.groupBy("g").agg(
        F.percentile("v", F.lit(0.5)).alias("p50"), F.percentile("v", F.lit(0.9)).alias("p90")).collect()}
    assert got.keys() == exp.keys()
    for g in exp:
        assert abs(got[g][0] - exp[g][0]) < 1e-9 and abs(got[g][1] - exp[g][1]) < 1e-9, g
    assert got["a"] == (2.5, 3.7)


def test_weighted_counts_equal_rows(spark):
    rows = [("g", float(v % 13)) for v in range(400)] + [("h", 1.0), ("h", 9.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("w"))
    a = {r.g: r.p for r in percentile_cont(df, ["g"], "v", {"p": 0.9}).collect()}
    b = {r.g: r.p for r in percentile_cont(counts, ["g"], "v", {"p": 0.9}, weight_col="w").collect()}
    assert a == b


def test_weighted_rows_may_repeat_values(spark):
    # the same value counted in two rows of one group (two zone keys, same attributes)
    w = spark.createDataFrame([("g", 1.0, 2), ("g", 2.0, 1), ("g", 1.0, 3), ("g", 5.0, 4)], "g string, v double, w long")
    rows = spark.createDataFrame([("g", 1.0)] * 5 + [("g", 2.0)] + [("g", 5.0)] * 4, "g string, v double")
    a = percentile_cont(w, ["g"], "v", {"p": 0.5, "q": 0.9}, weight_col="w").first()
    b = percentile_cont(rows, ["g"], "v", {"p": 0.5, "q": 0.9}).first()
    assert (a.p, a.q) == (b.p, b.q)


def test_signs_sizes_and_null_groups(spark):
    rng = random.Random(3)
    rows = []
    for g, h in (("a", 1), (None, 1), ("a", None), ("", 2)):
        for _ in range(301):
            rows.append((g, h, rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 12)))
    rows += [("inf", 0, v) for v in (float("-inf"), -1.0, -0.0, 0.0, 1e308, float("inf"))]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    probs = {"p0": 0.0, "p1": 0.013, "p5": 0.5, "p9": 0.9, "p10": 1.0}
    got = {(r.g, r.h): tuple(r[n] for n in probs) for r in percentile_cont(df, ["g", "h"], "v", probs).collect()}
    exp = {(r.g, r.h): tuple(r[n] for n in probs) for r in df.groupBy("g", "h").agg(
        *[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()]).collect()}
    assert got.keys() == exp.keys()
    for k, values in exp.items():
        assert all(a == b or abs(a - b) <= 1e-9 * abs(b) for a, b in zip(got[k], values)), k


def test_values_at_ranks_without_a_sort_or_a_written_copy(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("v"), F.lit(1).alias("g"))
    out = values_at(df, ["g"], "v", {"first": lambda n: n * 0, "middle": lambda n: F.floor(n / 2), "last": lambda n: n - 1})
    values = sorted(i * 7919 % 10_007 for i in range(10_000))
    assert tuple(out.first()) == (1, 10_000, values[0], values[5000], values[-1])
    assert "RangePartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert not out.inputFiles()


def test_buckets_never_fall(spark):
    values = sorted([-1e300, -5.5, -5.4999, -1.0, -1e-12, 0.0, 1e-12, 0.001, 1.0, 1.0005, 2.0, 1e9, 1e300, float("inf"), float("-inf")])
    got = [r.b for r in spark.createDataFrame([(v,) for v in [*values, float("nan")]], "v double").select(bucket_of(F.col("v")).alias("b")).collect()]
    assert got == sorted(got) and got[-1] > got[-2]
