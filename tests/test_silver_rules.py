"""Silver semantics on hand-made edge rows (FIXTURES §3)."""

from pyspark.sql import functions as F

from helpers import trip, union_df, zones_df
from tripstar.operators import gold, silver


def _silver(spark, rows):
    return silver.silver_from_union(union_df(spark, rows), zones_df(spark))


def test_duplicates_get_ordinals_and_distinct_ids(spark):
    rows = [trip(), trip(), trip()]
    keyed = silver.with_trip_id(silver.with_pickup_zone(union_df(spark, rows), zones_df(spark)))
    got = keyed.select("trip_ordinal", "trip_id").collect()
    assert sorted(r.trip_ordinal for r in got) == [1, 2, 3]
    assert len({r.trip_id for r in got}) == 3


def test_null_codes_get_default_labels(spark):
    s = _silver(spark, [trip(payment_type=None, rate_code_id=None), trip(payment_type=0, rate_code_id=7)])
    labels = {(r.payment_type_description, r.rate_code_description) for r in s.collect()}
    assert labels == {("Other", "Unknown")}


def test_null_rate_code_has_null_sk_in_fact(spark):
    s = _silver(spark, [trip(rate_code_id=None), trip(rate_code_id=1, pickup="2020-06-02 10:00:00")])
    dims = gold.build_dimensions(s)
    f = gold.fct_trips(s, dims)
    sks = sorted((r.rate_code_sk is None) for r in f.collect())
    assert sks == [False, True]
    # the dimension holds the null member, with the highest surrogate key (nulls last)
    rc = {r.rate_code_id: r.rate_code_sk for r in dims.rate_code.collect()}
    assert rc[None] == max(rc.values())


def test_flag_bounds(spark):
    rows = [trip(seconds=s, trip_distance=1.0) for s in (59, 60, 3600, 3601)]
    got = {r.trip_duration_seconds: r.duration_flag for r in _silver(spark, rows).collect()}
    assert got == {59.0: "Very short trip (<1min)", 60.0: "Normal trip", 3600.0: "Normal trip",
                   3601.0: "Very long trip (>1h)"}
    # speeds 4.99, 5, 80, 80.01 mph over one hour
    rows = [trip(pickup=f"2020-06-0{i + 1} 10:00:00", seconds=3600, trip_distance=d)
            for i, d in enumerate((4.99, 5.0, 80.0, 80.01))]
    got = {r.trip_distance: r.speed_flag for r in _silver(spark, rows).collect()}
    assert got == {4.99: "Low speed", 5.0: "Normal speed", 80.0: "Normal speed", 80.01: "High speed"}


def test_fact_speed_cap(spark):
    rows = [trip(seconds=3600, trip_distance=d, pickup=f"2020-06-0{i + 1} 10:00:00")
            for i, d in enumerate((100.0, 100.01))]
    s = _silver(spark, rows)
    f = gold.fct_trips(s, gold.build_dimensions(s))
    assert [r.avg_speed_mph for r in f.collect()] == [100.0]


def test_validity_window(spark):
    rows = [
        trip(pickup="2014-12-31 23:59:59", seconds=600),  # before the window (NYC)
        trip(pickup="2015-01-01 00:00:00", seconds=600),  # first second: kept
        trip(pickup="2025-12-31 19:00:00", seconds=600),  # UTC 2026-01-01 00:00 -> rejected
        trip(pickup="2025-12-31 18:40:00", seconds=600),  # kept
    ]
    kept = sorted(str(r.pickup_datetime_nyc) for r in _silver(spark, rows).collect())
    assert kept == ["2015-01-01 00:00:00", "2025-12-31 18:40:00"]


def test_dst_transitions(spark):
    rows = [
        trip(pickup="2020-11-01 00:50:00", dropoff="2020-11-01 01:10:00"),
        trip(pickup="2020-11-01 01:50:00", dropoff="2020-11-01 02:10:00"),
        trip(pickup="2021-03-14 01:50:00", dropoff="2021-03-14 03:10:00"),
        trip(pickup="2021-03-14 02:30:00", dropoff="2021-03-14 03:10:00"),
    ]
    s = _silver(spark, rows).select(
        F.col("pickup_datetime_nyc").cast("string").alias("p"),
        F.col("pickup_datetime_utc").cast("string").alias("pu"),
        F.col("dropoff_datetime_utc").cast("string").alias("du"),
    )
    got = {r.p: (r.pu, r.du) for r in s.collect()}
    # ambiguous autumn hour resolves to daylight time (the earlier instant)
    assert got["2020-11-01 00:50:00"] == ("2020-11-01 04:50:00", "2020-11-01 05:10:00")
    assert got["2020-11-01 01:50:00"] == ("2020-11-01 05:50:00", "2020-11-01 07:10:00")
    assert got["2021-03-14 01:50:00"] == ("2021-03-14 06:50:00", "2021-03-14 07:10:00")
    # 02:30 does not exist in spring: its UTC time is after the dropoff -> rejected
    assert "2021-03-14 02:30:00" not in got


def test_zero_fare_tip_percentage(spark):
    s = _silver(spark, [trip(fare_amount=0.0, tip_amount=1.0, total_amount=4.3)])
    f = gold.fct_trips(s, gold.build_dimensions(s))
    assert [r.tip_percentage for r in f.collect()] == [0.0]


def test_unmatched_zone_gives_null_borough(spark):
    s = _silver(spark, [trip(pulocation_id=99)])
    r = s.first()
    assert r.pickup_location_id == 99 and r.pickup_borough is None and r.dropoff_borough == "Queens"


def test_reject_report_counts_each_rule(spark):
    rows = [trip(), trip(passenger_count=0), trip(fare_amount=-1.0), trip(vendor_id=None), trip(seconds=0)]
    std = silver.standardized(union_df(spark, rows), zones_df(spark))
    rep = {r.rule: r.failing_rows for r in silver.reject_report(std).collect()}
    assert rep["passenger_count > 0"] == 1
    assert rep["fare_amount >= 0"] == 1
    assert rep["vendor_id is not null"] == 1
    assert rep["avg_speed_mph > 0"] == 1  # zero duration -> null speed -> fails
    assert rep["pickup_datetime_utc < dropoff_datetime_utc"] == 1


def test_time_key_ignores_session_zone_gaps(spark):
    from tripstar.functions.timecols import time_key

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT timestamp_ntz'2021-03-14 02:30:05' AS ts")  # inside LA's spring-forward gap
        row = df.select(time_key(F.col("ts")).alias("k"), gold._time_rows(
            df.select(F.hour("ts").alias("hour"), F.minute("ts").alias("minute"), F.second("ts").alias("second")), "pickup"
        ).select("pickup_time_formatted").scalar().alias("t")).first()
        assert (row.t, row.k) == ("02:30:05", 23005)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_amounts_that_differ_by_noise_get_distinct_ids(spark):
    rows = [trip(total_amount=12.35), trip(total_amount=12.350000000000001), trip(total_amount=float("nan")),
            trip(total_amount=1e40), trip(total_amount=-1e40), trip(total_amount=None), trip(total_amount=0.0), trip(total_amount=-0.0)]
    keyed = silver.with_trip_id(silver.with_pickup_zone(union_df(spark, rows), zones_df(spark))).collect()
    assert len({r.trip_id for r in keyed}) == len(rows)
    assert sorted(r.trip_ordinal for r in keyed if r.total_amount is not None and 12 < r.total_amount < 13) == [1, 2]
    assert sorted(r.trip_ordinal for r in keyed if r.total_amount == 0) == [1, 2]


def test_codes_beyond_32_bits_are_kept(spark):
    s = _silver(spark, [trip(vendor_id=3_000_000_000, passenger_count=2 ** 40)])
    r = s.first()
    assert (r.vendor_id, r.passenger_count) == (3_000_000_000, 2 ** 40)
    f = gold.fct_trips(s, gold.build_dimensions(s)).first()
    assert f.vendor_sk == 1 and f.passenger_count == 2 ** 40


def test_times_before_the_epoch(spark):
    from tripstar.functions.timecols import ns_to_wallclock

    df = spark.createDataFrame([(-1,), (-1000,), (999,), (1000,)], "ns long")
    got = [r.t for r in df.select(ns_to_wallclock(F.col("ns")).cast("string").alias("t")).collect()]
    assert got == ["1969-12-31 23:59:59.999999", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "1970-01-01 00:00:00.000001"]
