"""Trips-shaped raw tables derived from the driver's test tables.

No trip files are available offline, so the raw layer is derived from
``lineitem ⋈ orders ⋈ customer ⋈ supplier`` (every line item becomes one trip)
and the zone lookup from ``nation ⋈ region``.  The mapping is fixed so that an
independent SQL engine can rebuild exactly the same rows; dates are shifted by
7,305 days so that 1995 becomes 2015 and the validity window applies unchanged.

The rows are dirty on purpose, in ways that follow from the keys, so that every
rule and the duplicate handling have work to do: exact copies, variants of one
natural key (another tip, a total that differs by noise only), null timestamps,
trips outside the validity window, negative fares, null passengers and tips, and
vendor codes beyond 32 bits.

All joins are on keys of the small side (orders by order key, customer and
supplier by their keys); Spark plans them from runtime sizes under AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.timecols import epoch_ntz, epoch_seconds, month_index
from ..operators.packing import pack
from ..schemas import RAW_GREEN, RAW_YELLOW
from ..session import COMPRESSION, MONTHS_OPEN, OPEN_FILES, sql_setting, write_unsorted
from .samples import write_csv

# FIXED VALUES of the fixture mapping (shared with the SQL oracle).
DATE_SHIFT_SECONDS = 631_152_000  # 7,305 days
LOAD_TIME_NS = 1_758_259_200_000_000_000  # 2025-09-19 05:20:00 on the loader clock
UNMATCHED_NATION = 24  # left out of the zone lookup -> one location without zone

# Bits of a line item's numbers while it moves to its order; amounts are hundredths.
LINE_WORDS = [{"l_linenumber": 4, "l_quantity": 15, "l_extendedprice": 25, "l_discount": 7, "l_tax": 7, "open_line": 2, "green_line": 2}]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trip_rows(spark: SparkSession, sf_dir: str, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per line item with raw-trip columns plus ``SERVICE``."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax",
        # what the two texts decide, before the rows move
        F.coalesce(F.col("l_linestatus") == "O", F.lit(False)).alias("open_line"),
        F.coalesce(F.col("l_returnflag") == "A", F.lit(False)).alias("green_line"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = orders.select("o_orderkey", "o_custkey", epoch_seconds(orders, "o_orderdate").alias("o_epoch"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    # customers meet the orders first: however many they are, line items move once
    placed = orders.join(cust, F.col("o_custkey") == cust.c_custkey).select("o_orderkey", "o_epoch", "c_nationkey")
    packed = pack(li, LINE_WORDS)
    j = packed.rows.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    j = packed.unpack(j)
    # copy 0 is the trip itself, copy 1 an exact duplicate, copy 2 a variant
    extra = F.when(F.col("l_orderkey") % 40 == 0, 2).when(F.col("l_orderkey") % 40 == 1, 1).otherwise(0)
    j = j.withColumn("copy", F.explode(F.sequence(F.lit(0), extra)))
    variant = F.col("copy") == 2
    sod = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 13) % 86400
    file_s = F.col("o_epoch") + DATE_SHIFT_SECONDS + sod
    # trips of these suppliers carry a wrong date: 20 years before their file's month
    start_s = F.when(F.col("l_suppkey") % 89 == 0, file_s - DATE_SHIFT_SECONDS).otherwise(file_s)
    end_s = start_s + (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17) % 5400 - 60
    file_wall = F.timestamp_add("SECOND", file_s, epoch_ntz())
    year, month = F.year(file_wall), F.month(file_wall)
    odd_line = (F.col("l_linenumber") % 2) == 1

    def unless(cond, value):
        return F.when(~cond, value)

    vendor = F.col("l_suppkey") % 3
    return j.select(
        F.when(F.col("l_suppkey") % 83 == 0, vendor + 3_000_000_000).otherwise(vendor).cast("long").alias("VENDORID"),
        unless(F.col("l_partkey") % 97 == 0, start_s * 1_000_000_000).cast("long").alias("PICKUP_NS"),
        unless(F.col("l_partkey") % 97 == 1, end_s * 1_000_000_000).cast("long").alias("DROPOFF_NS"),
        unless(F.col("l_partkey") % 71 == 0, F.col("l_quantity").cast("long") % 7).alias("PASSENGER_COUNT"),
        (((F.col("l_orderkey") * 31 + F.col("l_suppkey")) % 2500).cast("double") / 100).alias("TRIP_DISTANCE"),
        (F.col("l_partkey") % 8).cast("long").alias("RATECODEID"),
        F.when(F.col("open_line"), "N").otherwise("Y").alias("STORE_AND_FWD_FLAG"),
        (F.col("c_nationkey") + 1).cast("long").alias("PULOCATIONID"),
        (F.col("s_nationkey") + 1).cast("long").alias("DOLOCATIONID"),
        F.col("l_linenumber").cast("long").alias("PAYMENT_TYPE"),
        F.when(F.col("l_orderkey") % 101 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("FARE_AMOUNT"),
        F.col("l_discount").alias("EXTRA"),
        F.col("l_tax").alias("MTA_TAX"),
        unless(F.col("l_partkey") % 61 == 0, F.when(variant, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).alias("TIP_AMOUNT"),
        (F.col("l_discount") * 10).alias("TOLLS_AMOUNT"),
        F.lit(None).cast("double").alias("EHAIL_FEE"),
        F.lit(0.3).alias("IMPROVEMENT_SURCHARGE"),
        (F.col("l_extendedprice") + F.col("l_quantity") + F.when(variant, F.lit(1e-9)).otherwise(F.lit(0.0))).alias("TOTAL_AMOUNT"),
        F.lit(1).cast("long").alias("TRIP_TYPE"),
        F.when(odd_line, (F.col("l_quantity").cast("long") % 5) * 0.75).alias("CONGESTION_SURCHARGE"),
        F.lit(None).cast("double").alias("AIRPORT_FEE"),
        month_index(year, month, cfg.first_month).alias("RUN_ID"),
        F.lit(LOAD_TIME_NS).cast("long").alias("VENTANA_TEMPORAL"),
        F.concat(F.lit("1/"), month.cast("string")).alias("LOTE_MES"),
        month.cast("long").alias("MONTH"),
        year.cast("long").alias("YEAR"),
        F.when(F.col("green_line"), "green").otherwise("yellow").alias("SERVICE"),
    )


def write_month_files(spark: SparkSession, rows: DataFrame, root: str) -> None:
    """The rows as the monthly files a provider would drop, types drifting by month.

    In odd months counts and codes are stored as doubles, names are lower-case and
    an extra ``cbd_congestion_fee`` appears.  One partitioned write per form; the
    part files are then renamed (one per service and month).
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    keys = ["SERVICE", "YEAR", "MONTH"]
    for service in ("yellow", "green"):
        own = raw_from_rows(rows, service).drop("RUN_ID", "VENTANA_TEMPORAL", "LOTE_MES")
        for odd in (0, 1):
            # the form's own columns are added behind the shuffle
            form = own.where(F.col("MONTH") % 2 == odd).repartition("YEAR", "MONTH").withColumn("SERVICE", F.lit(service))
            if odd:
                drifting = {c: F.col(c).cast("double") for c in ("PASSENGER_COUNT", "RATECODEID", "PAYMENT_TYPE")}
                form = form.withColumns({**drifting, "cbd_congestion_fee": F.lit(0.75)})
                form = form.toDF(*[c if c in keys else c.lower() for c in form.columns])
            staged = f"{root}/_staged/{service}-{odd}"
            # a file for each of a task's months stays open, so rows are not sorted by month
            with sql_setting(spark, OPEN_FILES, MONTHS_OPEN):
                write_unsorted(form.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*keys), staged)
            files = jvm.org.apache.hadoop.fs.Path(f"{staged}/SERVICE=*/YEAR=*/MONTH=*/part-*")
            fs = files.getFileSystem(conf)
            for found in fs.globStatus(files) or []:
                part = found.getPath()
                month, year = part.getParent().getName(), part.getParent().getParent().getName()
                name = f"{service}_tripdata_{int(year[5:]):04d}-{int(month[6:]):02d}.parquet"
                fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"))


def raw_from_rows(rows: DataFrame, service: str) -> DataFrame:
    """Project ``trip_rows`` (or its written copy) onto one service's raw schema."""
    prefix = "TPEP" if service == "yellow" else "LPEP"
    schema = RAW_YELLOW if service == "yellow" else RAW_GREEN
    rows = rows.where(F.col("SERVICE") == service)
    rows = rows.withColumnsRenamed(
        {"PICKUP_NS": f"{prefix}_PICKUP_DATETIME", "DROPOFF_NS": f"{prefix}_DROPOFF_DATETIME"}
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup as the CSV reader would deliver it (A3)."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (
        nation.where(F.col("n_nationkey") != UNMATCHED_NATION)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            (F.col("n_nationkey") + 1).cast("int").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.concat(F.lit("Zone "), (F.col("n_nationkey") % 3).cast("string")).alias("service_zone"),
        )
    )


def write_zone_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The zone lookup as a provider's CSV, with the texts that stand for missing values."""
    key = F.col("LocationID")
    zones = raw_zones(spark, sf_dir).withColumns({
        "Zone": F.when(key % 7 == 0, "N/A").otherwise(F.col("Zone")),
        "service_zone": F.when(key % 5 == 0, "NULL").otherwise(F.col("service_zone"))})
    write_csv(zones, path)
