"""Month files with schema drift, batch labels, idempotent reload, month plan."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripstar.config import PipelineConfig
from tripstar.operators.loads import coverage_from_log, month_plan
from tripstar.plans import loader
from tripstar.sources import monthly
from tripstar.sources.monthly import UnknownColumnsError, list_month_files, read_months

CFG = PipelineConfig(batch_rows=2, first_month=(2015, 1), last_month=(2015, 4))


def _month_table(month: int, n: int, drift: bool, unknown: bool = False) -> pa.Table:
    start = datetime(2015, month, 1, 8, 0, 0)
    pick = [start + timedelta(minutes=i) for i in range(n)]
    cols = {
        "VendorID": pa.array([1] * n, pa.int64()),
        "tpep_pickup_datetime": pa.array(pick, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([p + timedelta(minutes=9) for p in pick], pa.timestamp("us")),
        "passenger_count": pa.array([1.0 + (i % 2) for i in range(n)] if drift else [1] * n,
                                    pa.float64() if drift else pa.int64()),
        "trip_distance": pa.array([1.5] * n, pa.float64()),
        "RatecodeID": pa.array([2.5] * n if drift else [1] * n, pa.float64() if drift else pa.int64()),
        "store_and_fwd_flag": pa.array(["N"] * n),
        "PULocationID": pa.array([1] * n, pa.int64()),
        "DOLocationID": pa.array([2] * n, pa.int64()),
        "payment_type": pa.array([1] * n, pa.int64()),
    }
    for c in ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
              "total_amount", "congestion_surcharge"]:
        cols[c] = pa.array([1.0] * n, pa.float64())
    if drift:
        cols["airport_fee"] = pa.array([0.0] * n, pa.float64())
        cols["cbd_congestion_fee"] = pa.array([0.75] * n, pa.float64())
    else:
        cols["Airport_fee"] = pa.array([0.0] * n, pa.float64())
    if unknown:
        cols["new_unknown_column"] = pa.array(["x"] * n)
    return pa.table(cols)


def _green(table: pa.Table) -> pa.Table:
    return table.rename_columns([c.replace("tpep_", "lpep_") for c in table.column_names])


def _landing(tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    pq.write_table(_month_table(1, 5, drift=False), land / "yellow_tripdata_2015-01.parquet")
    pq.write_table(_month_table(2, 3, drift=True), land / "yellow_tripdata_2015-02.parquet")
    return land


def test_read_months_handles_drift_and_batches(spark, tmp_path):
    land = _landing(tmp_path)
    files = list_month_files(spark, str(land), "yellow")
    assert len(files) == 2 and list_month_files(spark, str(land), "green") == []
    read = read_months(spark, files, "yellow", CFG, load_time_ns=123)
    rows = read.frame.orderBy("YEAR", "MONTH", "TPEP_PICKUP_DATETIME").collect()
    assert len(rows) == 8
    jan = [r for r in rows if r.MONTH == 1]
    assert [r.LOTE_MES for r in jan] == ["1/1", "1/1", "2/1", "2/1", "3/1"]
    feb = [r for r in rows if r.MONTH == 2]
    assert [r.PASSENGER_COUNT for r in feb] == [1, 2, 1]
    assert {r.RATECODEID for r in feb} == {3}  # 2.5 rounds half up, not truncated
    assert {r.RUN_ID for r in jan} == {1} and {r.RUN_ID for r in feb} == {2}
    assert jan[0].TPEP_PICKUP_DATETIME == int(datetime(2015, 1, 1, 8).timestamp() - datetime(1970, 1, 1).timestamp()) * 10**9
    assert all(r.AIRPORT_FEE == 0.0 for r in rows) and all(r.VENTANA_TEMPORAL == 123 for r in rows)
    assert read.dropped_columns == {}


def test_unknown_columns_stop_yellow_and_are_dropped_from_green(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    table = _month_table(1, 3, drift=True, unknown=True)
    pq.write_table(table, land / "yellow_tripdata_2015-01.parquet")
    pq.write_table(_green(table), land / "green_tripdata_2015-01.parquet")
    raw = str(tmp_path / "raw")
    with pytest.raises(UnknownColumnsError, match="new_unknown_column"):
        loader.load_service(spark, str(land), raw, "yellow", CFG)
    assert loader.read_log(spark, raw).count() == 0  # nothing was loaded
    result = loader.load_service(spark, str(land), raw, "green", CFG)
    assert list(result.dropped_columns.values()) == [["new_unknown_column"]]
    assert loader.read_raw(spark, raw, "green").count() == 3


def test_missing_folder_and_broken_log_raise(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        loader.load_service(spark, str(tmp_path / "nowhere"), str(tmp_path / "raw"), "yellow", CFG)
    (tmp_path / "raw2" / "raw_yellow" / "manifest" / "some").mkdir(parents=True)
    (tmp_path / "raw2" / "raw_yellow" / "manifest" / "some" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        loader.read_log(spark, str(tmp_path / "raw2")).collect()


def test_reload_is_idempotent_and_plan_shrinks(spark, tmp_path):
    land = _landing(tmp_path)
    raw = str(tmp_path / "raw")
    first = loader.load_service(spark, str(land), raw, "yellow", CFG, load_time_ns=1)
    assert first.months_loaded == 2
    assert loader.read_raw(spark, raw, "yellow").count() == 8
    # a second run finds nothing pending; a forced reload leaves the same rows
    assert loader.load_service(spark, str(land), raw, "yellow", CFG).months_loaded == 0
    loader.load_service(spark, str(land), raw, "yellow", CFG, load_time_ns=2, only_pending=False)
    assert loader.read_raw(spark, raw, "yellow").count() == 8
    log = loader.read_log(spark, raw)
    assert sorted((r.year, r.month, r.rows) for r in log.collect()) == [(2015, 1, 5), (2015, 2, 3)]
    plan = month_plan(spark, log, ["yellow"], CFG)
    assert sorted((r.year, r.month) for r in plan.collect()) == [(2015, 3), (2015, 4)]
    coverage = coverage_from_log(spark, log, CFG)
    assert [(r.month, r.yellow_count, r.green_count, r.estado_load) for r in coverage.collect()] == [
        (1, 5, 0, "MISSING"), (2, 3, 0, "MISSING"), (3, 0, 0, "MISSING"), (4, 0, 0, "MISSING")]
    assert "raw_yellow/data" not in coverage._jdf.queryExecution().executedPlan().toString()


def test_zone_csv_na_and_overwrite(spark, tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
                   '264,"Unknown","N/A","N/A"\n265,"N/A","Outside of NYC","N/A"\n')
    raw = str(tmp_path / "raw")
    z = loader.load_zones(spark, str(csv), raw)
    z = loader.load_zones(spark, str(csv), raw)  # rerun replaces, never doubles
    got = sorted(tuple(r) for r in z.collect())
    assert got == [(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", None, None),
                   (265, None, "Outside of NYC", None)]
    assert z.where(F.col("Borough").isNotNull()).count() == 2


def test_cli_load_build_query(spark, tmp_path, capsys):
    from tripstar.__main__ import main

    land = _landing(tmp_path)
    # a green month too, so both services exist
    pq.write_table(_green(_month_table(1, 4, drift=False)), land / "green_tripdata_2015-01.parquet")
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n1,Manhattan,A,Yellow Zone\n2,Queens,B,Boro Zone\n")
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    main(["load", "--source", str(land), "--raw", raw, "--zones", str(zones)])
    main(["build", "--raw", raw, "--lake", lake])
    main(["query", "--lake", lake, "top_zones_pickup"])
    out = capsys.readouterr().out
    assert "yellow: 2 month(s) loaded" in out and "green: 1 month(s) loaded" in out
    assert "total_de_viajes" in out


def test_months_outside_the_plan_are_not_loaded(spark, tmp_path):
    land = _landing(tmp_path)
    pq.write_table(_month_table(5, 2, drift=False), land / "yellow_tripdata_2015-05.parquet")  # after last month
    raw = str(tmp_path / "raw")
    r = loader.load_service(spark, str(land), raw, "yellow", CFG, only_pending=False)
    assert r.months_loaded == 2
    assert [f.rsplit("/", 1)[-1] for f in r.unplanned_files] == ["yellow_tripdata_2015-05.parquet"]
    assert sorted({row.MONTH for row in loader.read_raw(spark, raw, "yellow").collect()}) == [1, 2]


def _rows(spark, raw):
    return sorted(tuple(r) for r in loader.read_raw(spark, raw, "yellow").collect())


def test_a_crash_before_the_manifest_leaves_the_month_pending(spark, tmp_path, monkeypatch):
    land, raw = _landing(tmp_path), str(tmp_path / "raw")

    def crash(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(loader, "write_manifest", crash)
        with pytest.raises(RuntimeError, match="killed"):
            loader.load_service(spark, str(land), raw, "yellow", CFG, load_time_ns=1)
    # rows were written, but they belong to no month
    assert spark.read.parquet(loader.data_path(raw, "yellow")).count() == 8
    assert _rows(spark, raw) == [] and loader.read_log(spark, raw).count() == 0
    assert month_plan(spark, loader.read_log(spark, raw), ["yellow"], CFG).count() == 4
    assert loader.load_service(spark, str(land), raw, "yellow", CFG, load_time_ns=2).months_loaded == 2
    before = _rows(spark, raw)
    assert len(before) == 8
    # a reload that dies leaves the loaded month as it was
    with monkeypatch.context() as m:
        m.setattr(loader, "write_manifest", crash)
        with pytest.raises(RuntimeError, match="killed"):
            loader.load_service(spark, str(land), raw, "yellow", CFG, load_time_ns=3, only_pending=False)
    assert _rows(spark, raw) == before
    assert len(loader.remove_unused_loads(spark, raw, "yellow")) == 0  # could still be running
    assert len(loader.remove_unused_loads(spark, raw, "yellow", grace_seconds=0)) == 2
    assert _rows(spark, raw) == before


def test_two_loaders_of_one_month_never_mix(spark, tmp_path):
    land, raw = _landing(tmp_path), str(tmp_path / "raw")
    with ThreadPoolExecutor(4) as pool:
        loads = [pool.submit(loader.load_service, spark, str(land), raw, "yellow", CFG, t, False) for t in (1, 2, 3, 4)]
        assert [x.result().months_loaded for x in loads] == [2] * 4
    rows = loader.read_raw(spark, raw, "yellow")
    assert rows.count() == 8
    assert [r[0] for r in rows.groupBy("MONTH").agg(F.countDistinct("VENTANA_TEMPORAL")).select(F.col("count(DISTINCT VENTANA_TEMPORAL)")).collect()] == [1, 1]
    assert sorted((r.month, r.rows) for r in loader.read_log(spark, raw).collect()) == [(1, 5), (2, 3)]
    assert loader.manifests(spark, raw, "yellow").count() == 8
    before = _rows(spark, raw)
    assert len(loader.remove_unused_loads(spark, raw, "yellow")) == 3
    assert _rows(spark, raw) == before


def test_an_empty_month_counts_as_loaded(spark, tmp_path):
    land, raw = _landing(tmp_path), str(tmp_path / "raw")
    pq.write_table(_month_table(3, 0, drift=False), land / "yellow_tripdata_2015-03.parquet")
    loader.load_service(spark, str(land), raw, "yellow", CFG)
    assert sorted((r.month, r.rows) for r in loader.read_log(spark, raw).collect()) == [(1, 5), (2, 3), (3, 0)]
    assert len(_rows(spark, raw)) == 8
    assert loader.load_service(spark, str(land), raw, "yellow", CFG).months_loaded == 0


def test_schema_registry_reads_a_footer_once(spark, tmp_path, monkeypatch):
    land, registry = _landing(tmp_path), str(tmp_path / "schemas")
    files = list_month_files(spark, str(land), "yellow")
    read = []
    plain = monthly.file_schemas
    monkeypatch.setattr(monthly, "file_schemas", lambda s, fs, *a: read.extend(fs) or plain(s, fs, *a))
    first = monthly.registered_schemas(spark, files, registry)
    assert read == files and first == plain(spark, files)
    assert monthly.registered_schemas(spark, files, registry) == first and read == files  # nothing read again
    pq.write_table(_month_table(2, 9, drift=False), land / "yellow_tripdata_2015-02.parquet")  # the file is replaced
    again = monthly.registered_schemas(spark, files, registry)
    assert read == [*files, files[1]] and again == plain(spark, files)
    drift = {(r.column, r.type): r.files for r in monthly.schema_drift(spark, registry).collect()}
    assert drift["PASSENGER_COUNT", "long"] == 2 and ("PASSENGER_COUNT", "double") not in drift


def test_raw_version_follows_loads_and_zones(spark, tmp_path):
    land, raw = _landing(tmp_path), str(tmp_path / "raw")
    csv = tmp_path / "zones.csv"
    csv.write_text("LocationID,Borough,Zone,service_zone\n1,A,B,C\n")
    loader.load_zones(spark, str(csv), raw)
    loader.load_service(spark, str(land), raw, "yellow", CFG)
    first = loader.raw_version(spark, raw)
    assert loader.raw_version(spark, raw) == first
    csv.write_text("LocationID,Borough,Zone,service_zone\n1,A,B,D\n")
    loader.load_zones(spark, str(csv), raw)
    second = loader.raw_version(spark, raw)
    loader.load_service(spark, str(land), raw, "yellow", CFG, only_pending=False)
    assert len({first, second, loader.raw_version(spark, raw)}) == 3
