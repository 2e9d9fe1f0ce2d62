"""Benchmark: build the lakehouse and run the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Measured:
* layer builds (bronze, silver + tests, gold + tests) from the trips fixture;
* the six filter shapes of the reference's clustering study on the fact
  table, clustered (pickup_date_sk, pickup_zone_sk, service_type_sk) vs. an
  unclustered copy: seconds, and in ``rows_scanned`` what the Parquet scan
  really returned after skipping row groups, from the scan's own metrics, as
  [clustered, unclustered, all rows].  The two copies use small row groups, so
  that hundreds of them exist at this size;
* the eight business queries plus peak hours on the clustered tables;
* a skew scenario derived from the data (a third of the rows copies of one
  trip, plus many variants of one natural key): the range-cut duplicate
  ordinal vs a plain ``row_number`` window (not part of ``value``).

``value`` is the sum of the three layer builds and of the query times (filters on
the clustered fact plus business queries; each the best of three warm runs).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tripstar.operators import analytics  # noqa: E402
from tripstar.plans import layers, layout  # noqa: E402
from tripstar.session import build_session, checkpoint_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t0


def best_of(fn, runs: int = 3) -> float:
    fn()  # warm
    return min(timed(fn)[1] for _ in range(runs))


# Row groups of the fact copies: some 150 in the whole fact at sf0.1.
ROW_GROUP_BYTES = 256 * 1024


def rows_scanned(spark, df) -> int:
    """Rows that the file scan of ``df`` returned, by the scan's metric."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan hides its leaves
    try:
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.collect()
        return int(plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def main() -> None:
    spark = build_session(
        "tripstar-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=CPUS,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    # Tables go to the shared checkpoint folder (a private scratch folder only when unset).
    scratch = f"{checkpoint_dir(spark)}/bench-{uuid.uuid4().hex[:12]}"
    lake = layers.Lakehouse.from_fixture(spark, SF_DIR)
    tables = layers.Tables(spark, f"{scratch}/lake", lake.cfg)
    q: dict[str, float] = {}

    _, q["build_bronze"] = timed(lambda: layers.build_bronze(lake, tables))
    _, q["build_silver"] = timed(lambda: layers.build_silver(tables, on_fail="warn"))
    _, q["build_gold"] = timed(lambda: layers.build_gold(tables, on_fail="warn"))

    # Copies of the fact: clustered, clustered by dropoff date, and scattered by
    # a hash of the trip id (deterministic under task retry).
    clustered, by_dropoff, unclustered = (f"{scratch}/fct_{n}" for n in ("clustered", "by_dropoff", "unclustered"))
    layout.write_clustered(tables.fact, clustered, files=CPUS, row_group_bytes=ROW_GROUP_BYTES)
    layout.write_clustered(tables.fact, by_dropoff, files=CPUS, keys=["dropoff_date_sk"], row_group_bytes=ROW_GROUP_BYTES)
    tables.fact.orderBy(F.xxhash64("trip_id")).write.mode("overwrite").option(
        "parquet.block.size", str(ROW_GROUP_BYTES)).parquet(unclustered)

    fact_c = spark.read.parquet(clustered)
    fact_u = spark.read.parquet(unclustered)
    fact_d = spark.read.parquet(by_dropoff)

    # Filter values: a busy day, zone and service present in the data.
    top = (fact_c.groupBy("pickup_date_sk", "pickup_zone_sk", "service_type_sk").count()
           .orderBy(F.col("count").desc(), "pickup_date_sk").first())
    day, zone, svc = top["pickup_date_sk"], top["pickup_zone_sk"], top["service_type_sk"]
    month_lo, month_hi = (day // 100) * 100, (day // 100) * 100 + 31
    drop_day = fact_c.where(F.col("pickup_date_sk") == day).agg(F.max("dropoff_date_sk")).first()[0]

    shapes = {
        "f1_pickup_date": F.col("pickup_date_sk") == day,
        "f2_pickup_zone": F.col("pickup_zone_sk") == zone,
        "f3_date_zone": (F.col("pickup_date_sk") == day) & (F.col("pickup_zone_sk") == zone),
        "f4_month_zone": F.col("pickup_date_sk").between(month_lo, month_hi) & (F.col("pickup_zone_sk") == zone),
        "f5_dropoff_date": F.col("dropoff_date_sk") == drop_day,
        "f6_date_zone_service": (F.col("pickup_date_sk") == day) & (F.col("pickup_zone_sk") == zone)
        & (F.col("service_type_sk") == svc),
    }
    agg = [F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue")]
    fact_rows = fact_c.count()
    pruning = {}
    for name, cond in shapes.items():
        clustered_df = fact_d if name == "f5_dropoff_date" else fact_c
        q[f"{name}_clustered"] = best_of(lambda: clustered_df.where(cond).agg(*agg).collect())
        q[f"{name}_unclustered"] = best_of(lambda: fact_u.where(cond).agg(*agg).collect())
        pruning[name] = [*(rows_scanned(spark, f.where(cond).agg(*agg)) for f in (clustered_df, fact_u)), fact_rows]

    fact_c = tables.fact
    d = tables.dims
    business = {
        "top_zones_pickup": lambda: analytics.top_zones(fact_c, d.zone_pickup, d.date_pickup, "pickup"),
        "top_zones_dropoff": lambda: analytics.top_zones(fact_c, d.zone_dropoff, d.date_dropoff, "dropoff"),
        "revenue_tips_pickup": lambda: analytics.revenue_tips(fact_c, d.zone_pickup, d.date_pickup, "pickup"),
        "revenue_tips_dropoff": lambda: analytics.revenue_tips(fact_c, d.zone_dropoff, d.date_dropoff, "dropoff"),
        "speed_by_band_pickup": lambda: analytics.speed_by_band(fact_c, d.zone_pickup, d.time_pickup, "pickup"),
        "speed_by_band_dropoff": lambda: analytics.speed_by_band(fact_c, d.zone_dropoff, d.time_dropoff, "dropoff"),
        "duration_percentiles": lambda: analytics.duration_percentiles(fact_c, d.zone_pickup),
        "demand_dow_hour": lambda: analytics.demand_dow_hour(fact_c, d.date_pickup, d.time_pickup),
        "peak_hours": lambda: analytics.peak_hours(analytics.demand_dow_hour(fact_c, d.date_pickup, d.time_pickup)),
    }
    for name, build in business.items():
        q[name] = best_of(lambda: build().collect())

    # Skew scenario derived from the data: a third of all rows become copies
    # of one trip, and one natural key gets many distinct variants.
    from pyspark.sql import Window

    from tripstar.operators import silver as silver_ops
    from tripstar.operators.numbering import number_within_key
    from tripstar.operators.ranges import RANGE, pinned_ranges

    union = tables.lakehouse().union
    n = union.count()
    first = union.orderBy(*union.columns).limit(1)
    copies = first.select(*[c for c in union.columns],
                          F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_i")).drop("_i")
    variants = first.select(*[c for c in union.columns if c != "fare_amount"],
                            F.explode(F.sequence(F.lit(1), F.lit(n // 10))).alias("_f"))
    variants = variants.withColumn("fare_amount", F.col("_f").cast("double")).drop("_f")
    skewed = union.unionByName(copies).unionByName(variants.select(*union.columns))
    skewed.write.mode("overwrite").parquet(f"{scratch}/skewed")
    skewed = spark.read.parquet(f"{scratch}/skewed")
    key = silver_ops.NATURAL_KEY
    rest = [c for c in skewed.columns if c not in key]
    naive = skewed.withColumn("o", F.row_number().over(
        Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in rest])))

    def ordinals():  # the range write is part of the work, so it is built anew in each run
        return number_within_key(skewed, key, ordinal_col="o").agg(F.max("o"), F.count(F.lit(1))).collect()[0]

    q["skew_numbering_safe"] = best_of(ordinals, runs=2)
    q["skew_numbering_plain_window"] = best_of(lambda: naive.agg(F.max("o"), F.count(F.lit(1))).collect(), runs=2)
    assert ordinals()[0] == naive.agg(F.max("o")).first()[0] > n // 2
    # Largest share of the rows in one task: of a range, and of a hash partition
    # (Spark's hash partitioning is pmod(hash(keys), n)).
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def max_share(df, part):
        sizes = df.groupBy(part.alias("_p")).count()
        r = sizes.agg(F.max("count").alias("m"), F.sum("count").alias("t")).first()
        return round(r["m"] / r["t"], 4)

    tied = skewed.withColumn("_tie", F.monotonically_increasing_id())
    skew_share = {
        "partitions": parts,
        "skew_safe": max_share(pinned_ranges(tied, [*[F.col(c) for c in [*key, *rest]], F.col("_tie")]), F.col(RANGE)),
        "plain_window": max_share(skewed, F.pmod(F.hash(*key), F.lit(parts))),
    }

    headline = [k for k in q if k.endswith("_clustered") or k in business or k.startswith("build_")]
    total = sum(q[k] for k in headline)
    print(json.dumps({
        "metric": "build_and_query_seconds_total",
        "value": round(total, 4),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in q.items()},
        "sf": os.path.basename(SF_DIR).replace("sf", ""),
        "fact_rows": fact_rows,
        "rows_scanned": pruning,
        "skew_max_task_share": skew_share,
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
