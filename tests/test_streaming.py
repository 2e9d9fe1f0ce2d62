"""File-stream ingest: run, re-run (nothing new), drifting months, replayed batches."""

import shutil

import pyarrow.parquet as pq
import pytest
from test_ingest import CFG, _month_table

from tripstar.operators.loads import month_plan
from tripstar.plans import loader
from tripstar.sources.monthly import UnknownColumnsError
from tripstar.streaming.file_ingest import ExportTotals, export_batch, stream_month_files


def test_available_now_is_exactly_once(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    pq.write_table(_month_table(1, 5, drift=False), land / "yellow_tripdata_2015-01.parquet")
    raw, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    t1 = stream_month_files(spark, str(land), raw, "yellow", ckpt, CFG, load_time_ns=1)
    assert (t1.batches, t1.rows) == (1, 5)
    t2 = stream_month_files(spark, str(land), raw, "yellow", ckpt, CFG, load_time_ns=2)
    assert t2.rows == 0
    # types drift and an extra column arrives: the same rows as from the batch loader
    pq.write_table(_month_table(2, 4, drift=True), land / "yellow_tripdata_2015-02.parquet")
    pq.write_table(_month_table(7, 4, drift=True), land / "yellow_tripdata_2015-07.parquet")  # not planned
    t3 = stream_month_files(spark, str(land), raw, "yellow", ckpt, CFG, load_time_ns=1)
    assert t3.rows == 4
    loader.load_service(spark, str(land), str(tmp_path / "batch"), "yellow", CFG, load_time_ns=1)
    streamed, batch = (sorted(tuple(r) for r in loader.read_raw(spark, r, "yellow").collect()) for r in (raw, str(tmp_path / "batch")))
    assert streamed == batch and len(streamed) == 9
    log = sorted((r.year, r.month, r.rows) for r in loader.read_log(spark, raw).collect())
    assert log == [(2015, 1, 5), (2015, 2, 4)]
    plan = month_plan(spark, loader.read_log(spark, raw), ["yellow"], CFG)
    assert sorted((r.year, r.month) for r in plan.collect()) == [(2015, 3), (2015, 4)]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    pq.write_table(_month_table(1, 5, drift=False), land / "yellow_tripdata_2015-01.parquet")
    raw, ckpt = str(tmp_path / "raw"), tmp_path / "ckpt"
    stream_month_files(spark, str(land), raw, "yellow", str(ckpt), CFG, load_time_ns=1)
    shutil.rmtree(ckpt / "commits")  # as if the stream had died before it noted the batch
    again = stream_month_files(spark, str(land), raw, "yellow", str(ckpt), CFG, load_time_ns=2)
    assert again.rows == 5 and loader.read_raw(spark, raw, "yellow").count() == 5
    assert loader.manifests(spark, raw, "yellow").count() == 1


def test_unknown_columns_stop_a_yellow_stream(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    pq.write_table(_month_table(1, 5, drift=False, unknown=True), land / "yellow_tripdata_2015-01.parquet")
    with pytest.raises(Exception, match="unknown columns|UnknownColumnsError"):
        stream_month_files(spark, str(land), str(tmp_path / "raw"), "yellow", str(tmp_path / "ckpt"), CFG)
    assert loader.read_log(spark, str(tmp_path / "raw")).count() == 0
    assert issubclass(UnknownColumnsError, ValueError)


def test_export_batch_reports_totals(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "2015 as YEAR", "cast(id % 3 as int) as MONTH")
    totals = ExportTotals()
    for batch in (0, 1, 1):  # a repeated batch replaces its partitions
        export_batch(df.where(f"MONTH = {batch}"), str(tmp_path / "out"), totals, batch)
    assert (totals.batches, totals.rows, totals.per_batch) == (3, 10, [(0, 4), (1, 3), (1, 3)])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7
