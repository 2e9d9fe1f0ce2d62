"""Data tests K1-K5 (+K8 gate): each has a passing and a failing frame."""

import pytest

from tripstar.operators.quality import Check, DataQualityError, assert_quality, run_checks, run_table_checks


def _report(df, checks, parents=None):
    return {(r.column, r.test): r.failing_rows for r in run_checks(df, checks, parents).collect()}


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    rep = _report(df, [Check("t", "id", "not_null"), Check("t", "id", "unique")])
    assert rep == {("id", "not_null"): 1, ("id", "unique"): 1}
    ok = spark.createDataFrame([(1,), (2,)], "id int")
    assert set(_report(ok, [Check("t", "id", "not_null"), Check("t", "id", "unique")]).values()) == {0}


def test_expression_null_passes(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    assert _report(df, [Check("t", "x", "expression_is_true", ">= 0")]) == {("x", "expression_is_true(>= 0)"): 1}


def test_cross_column_expression(spark):
    df = spark.createDataFrame([(1, 2), (3, 2)], "a int, b int")
    assert _report(df, [Check("t", "b", "expression_is_true", "> a")]) == {("b", "expression_is_true(> a)"): 1}


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "sk int")
    parent = spark.createDataFrame([(1,), (2,)], "sk int")
    rep = _report(child, [Check("f", "sk", "relationships", "dim.sk")], {"dim": parent})
    assert rep == {("sk", "relationships(dim.sk)"): 1}


def test_accepted_values(spark):
    df = spark.createDataFrame([("Cash",), ("Bitcoin",), (None,)], "p string")
    assert _report(df, [Check("t", "p", "accepted_values", ("Cash", "Credit card"))]) == {("p", "accepted_values"): 1}


def test_gate_raises_or_warns(spark):
    df = spark.createDataFrame([(None,)], "id int")
    report = run_checks(df, [Check("t", "id", "not_null")])
    with pytest.raises(DataQualityError):
        assert_quality(report)
    assert assert_quality(report, on_fail="warn") == [("t", "id", "not_null", 1)]


def test_duplicated_values_exact(spark):
    from tripstar.operators.quality import duplicated_values

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("c",), ("c",), ("c",)], "id string")
    got = sorted((r.id, r.occurrences) for r in duplicated_values(df, "id").collect())
    assert got == [("a", 2), ("c", 3)]


def test_doubled_zone_lookup_fires_unique(spark):
    from tripstar.operators.quality import zone_checks

    zones = spark.createDataFrame([(1, "A"), (2, "B")], "LOCATIONID int, BOROUGH string")
    doubled = zones.unionAll(zones)
    ok = {r.test: r.failing_rows for r in run_checks(zones, zone_checks()).collect()}
    bad = {r.test: r.failing_rows for r in run_checks(doubled, zone_checks()).collect()}
    assert ok == {"not_null": 0, "unique": 0} and bad == {"not_null": 0, "unique": 2}
    with pytest.raises(DataQualityError):
        assert_quality(run_checks(doubled, zone_checks()))


def test_many_tables_and_checks_share_one_shuffle(spark):
    a = spark.createDataFrame([(i, i % 3, None if i == 4 else "x") for i in range(9)] + [(0, 7, "y")], "id int, g int, t string")
    b = spark.createDataFrame([("k",), ("k",), ("k",), ("l",), (None,)], "name string")
    checks = [Check("a", "g", "expression_is_true", f"< {n}") for n in range(70)]  # more than one number holds
    checks += [Check("a", "id", "unique"), Check("a", "t", "not_null"), Check("b", "name", "unique"), Check("a", "t", "unique"),
               Check("b", "name", "not_null"), Check("c", "x", "not_null")]
    report = run_table_checks({"a": a, "b": b}, checks)
    got = {(r.table, r.column, r.test): r.failing_rows for r in report.collect()}
    assert len(got) == 75 and ("c", "x", "not_null") not in got
    for n in range(70):
        assert got["a", "g", f"expression_is_true(< {n})"] == sum(1 for i in range(9) if i % 3 >= n) + (7 >= n)
    assert got["a", "id", "unique"] == 1 and got["a", "t", "unique"] == 1 and got["b", "name", "unique"] == 1
    assert got["a", "t", "not_null"] == 1 and got["b", "name", "not_null"] == 1
    assert run_table_checks({"a": a}, [Check("b", "name", "unique")]) is None


def test_no_second_scan_without_repeated_hashes(spark, tmp_path):
    spark.range(1000).selectExpr("id", "cast(id as string) s", "id % 900 as d").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    checks = [Check("t", "id", "unique"), Check("t", "s", "unique"), Check("t", "s", "not_null")]
    report = run_checks(t, checks)
    assert {r.failing_rows for r in report.collect()} == {0}
    assert not [f for f in report.inputFiles() if str(tmp_path) in f]  # only the scan's small result is read
    report = run_checks(t, [*checks, Check("t", "d", "unique")])
    assert {r.column: r.failing_rows for r in report.collect() if r.test == "unique"} == {"id": 0, "s": 0, "d": 100}
    assert [f for f in report.inputFiles() if str(tmp_path) in f]
