"""Plans that must not move more rows when tables outgrow what Spark broadcasts."""

import re

from helpers import SF001, trip, union_df
from pyspark.sql import functions as F

from tripstar.operators import gold, loads, quality
from tripstar.plans import layout, loader
from tripstar.plans.layers import Lakehouse, Tables, build_bronze, build_gold, build_silver
from tripstar.session import sql_setting
from tripstar.sources import fixture


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_customers_meet_the_orders_before_the_line_items(spark):
    lines = plan(fixture.trip_rows(spark, SF001), "optimizedPlan").splitlines()
    depth = {k: next(line.index("Join") for line in lines if "Join" in line and k in line) for k in ("c_custkey", "l_orderkey")}
    assert depth["c_custkey"] > depth["l_orderkey"]


def test_the_curve_moves_no_row_of_the_table(spark):
    df = spark.range(5000).select((F.col("id") % 50).alias("a"), (F.col("id") % 7).alias("b"), F.col("id").alias("trip_id"))
    weights = df.repartition(4)
    curved = plan(layout.curve_index(df, ("a", "b", "a"), weights))
    assert "SortMergeJoin" not in curved and "hashpartitioning" not in curved and curved.count("BroadcastHashJoin") == 2


def test_many_repeated_values_are_counted_without_a_join(spark, monkeypatch):
    rows = [(f"v{i}",) for i in range(40)] + [(f"v{i}",) for i in range(15)] + [(None,), (None,)]
    df = spark.createDataFrame(rows, "id string")
    checks = [quality.Check("t", "id", "unique"), quality.Check("t", "id", "not_null")]
    found, seen = [], []
    original = quality._duplicated
    monkeypatch.setattr(quality, "_duplicated", lambda t, k, twice: seen.append(twice) or original(t, k, twice))
    for most in (1_000_000, 14):
        monkeypatch.setattr(quality, "BROADCAST_ROWS", most)
        found.append({r["test"]: r["failing_rows"] for r in quality.run_checks(df, checks).collect()})
    assert found == [{"unique": 15, "not_null": 2}] * 2
    assert seen[0] is not None and seen[1] is None


def test_dedup_sorts_by_numbers_before_texts(spark):
    rows = [trip(tip_amount=float(i % 3), service_type=s) for s in ("yellow", "green") for i in range(6)] + [trip(pulocation_id=9)]
    df = union_df(spark, rows)
    out = loads.dedup_trips(df)
    assert out.columns == df.columns
    assert sorted((r["service_type"], r["pulocation_id"], r["tip_amount"]) for r in out.collect()) == [
        ("green", 1, 0.0), ("yellow", 1, 0.0), ("yellow", 9, 2.0)]
    assert all(s.startswith("pickup_datetime") for s in re.findall(r"Sort \[(\w+)", plan(out)))


def test_raw_rows_are_not_sorted_by_service(spark, tmp_path, monkeypatch):
    seen = []
    tables = Tables(spark, str(tmp_path))
    writer = type(spark.range(1).write)
    original = writer.partitionBy
    monkeypatch.setattr(writer, "partitionBy", lambda self, *c: seen.append((c, spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))) or original(self, *c))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    build_bronze(Lakehouse.from_fixture(spark, SF001), tables)
    assert seen == [(("SERVICE",), "2")] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    raw = tables.read("raw_trips")
    assert raw.count() == fixture.trip_rows(spark, SF001).count()
    with sql_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "5"):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "5"


def test_months_and_services_are_written_with_files_to_spare(spark, tmp_path, monkeypatch):
    seen = []
    writer = type(spark.range(1).write)
    original = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, **k: seen.append(
        (path, int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))) or original(self, path, *a, **k))
    tables = Tables(spark, str(tmp_path / "lake"))
    build_bronze(Lakehouse.from_fixture(spark, SF001), tables)
    fixture.write_month_files(spark, tables.read("raw_trips"), str(tmp_path / "months"))
    loaded = loader.load_service(spark, str(tmp_path / "months"), str(tmp_path / "raw"), "green", load_time_ns=1)
    files = {kind: min(n for path, n in seen if kind in path) for kind in ("/raw_trips", "/_staged/", "/load=")}
    # with as many files open as allowed, Spark begins to sort
    assert files["/raw_trips"] > 2 and files["/_staged/"] > 12 and files["/load="] > 12
    green = tables.read("raw_trips").where("SERVICE = 'green'")
    read = loader.read_raw(spark, str(tmp_path / "raw"), "green")
    assert loaded.months_loaded and read.count() == green.count()
    assert read.agg(F.sum("PASSENGER_COUNT"), F.sum("PAYMENT_TYPE")).first() == green.agg(F.sum("PASSENGER_COUNT"), F.sum("PAYMENT_TYPE")).first()


def test_clustered_rows_move_packed_ids_and_no_derived_columns(spark, tmp_path, monkeypatch):
    odd = ["", "0", "A0", "a0", "00ff", "zz", "0 f", None]
    rows = [(i % 5, "%032x" % (i * 7919), float(i)) for i in range(40)] + [(9, x, 1.5) for x in odd]
    df = spark.createDataFrame(rows, "k int, trip_id string, v double").withColumn("twice", F.col("v") * 2)
    moved = plan(layout.clustered(df.drop("twice"), ["k"], 4, "trip_id"), "optimizedPlan").split("RepartitionByExpression")[0]
    assert "unhex" not in moved  # packed below the shuffle, text again above it
    layout.write_clustered(df, str(tmp_path / "f"), files=4, keys=["k"], derived={"twice": F.col("v") * 2})
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.columns == df.columns and sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)
    ids = [r["trip_id"] for r in layout.clustered(df, ["k"], 1, "trip_id").where("k < 9").collect()]
    assert ids == [r[1] for r in sorted(rows[:40])]


def test_line_items_keep_their_service_and_flag(spark, tmp_path):
    """Null return flags and line states are yellow and Y, as in the SQL."""
    for name in ("orders", "customer", "supplier"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    n = F.col("l_linenumber") % 3
    lines.withColumns({"l_returnflag": F.when(n == 0, F.lit("A")).when(n == 1, F.lit("R")),
                       "l_linestatus": F.when(n == 1, F.lit("O")).when(n == 2, F.lit("F"))}).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {tuple(r) for r in fixture.trip_rows(spark, str(tmp_path)).select(
        F.col("PAYMENT_TYPE") % 3, "SERVICE", "STORE_AND_FWD_FLAG").distinct().collect()}
    assert got == {(0, "green", "Y"), (1, "yellow", "N"), (2, "yellow", "Y")}


def test_the_fact_moves_in_words_and_keeps_its_values(spark, tmp_path):
    n = F.col("id")
    df = spark.range(300).select(
        "id", (n % 7).cast("int").alias("k"), F.md5(n.cast("string")).alias("trip_id"), (n % 86400).cast("int").alias("pickup_time_sk"),
        (n % 5 - 1).alias("vendor_sk"), (n / 10).alias("trip_distance"), F.when(n % 9 != 0, n * 1.5).alias("trip_duration_seconds"),
        (F.lit(0.1) * n).alias("fare_amount"), (F.lit(1e-9) + n).alias("total_amount"))
    speed = F.when(F.col("trip_duration_seconds") > 0, F.col("trip_distance") * 3600 / F.col("trip_duration_seconds"))
    # the usual speed, another one, or none
    df = df.withColumn("avg_speed_mph", F.when(n % 11 == 0, F.lit(3.5)).when(n % 13 != 0, speed)).drop("id")
    layout.write_clustered(df, str(tmp_path / "f"), files=4, keys=["k"], usual={"avg_speed_mph": gold.usual_speed()}, words=gold.FACT_WORDS)
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.dtypes == df.dtypes and sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_a_fact_row_takes_half_the_columns_on_its_way(spark, tmp_path, monkeypatch):
    moved = []
    original = layout.clustered
    monkeypatch.setattr(layout, "clustered", lambda df, *a: moved.append(df) or original(df, *a))
    tables = Tables(spark, str(tmp_path))
    build_bronze(Lakehouse.from_fixture(spark, SF001), tables)
    build_silver(tables, "warn")
    build_gold(tables, "warn")
    rows = moved[0]
    assert {"avg_speed_mph", "trip_id", "_word_0"} <= set(rows.columns) and not {"tip_percentage", "fare_amount"} & set(rows.columns)
    assert len([c for c in rows.columns if not c.endswith("_as_is")]) <= len(gold.FACT_COLUMNS) // 2 + 1
    assert sorted(tables.fact.collect(), key=repr) == sorted(gold.fct_trips(tables.silver, tables.dims).collect(), key=repr)
    assert dict(rows.dtypes)["avg_speed_mph"].startswith("struct")  # null where it follows from the row


def test_shuffle_files_are_dropped_while_layers_are_built(spark, monkeypatch, tmp_path):
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    writer = type(spark.range(1).write)
    original = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, **k: seen.append((path, spark.conf.get(name, "false"))) or original(self, path, *a, **k))
    before = spark.conf.get(name, None)
    build_bronze(Lakehouse.from_fixture(spark, SF001), Tables(spark, str(tmp_path)))
    assert {on for path, on in seen if "/bronze_" in path or "/raw_trips" in path} == {"true"}
    assert spark.conf.get(name, None) == before
