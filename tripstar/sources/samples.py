"""CSV sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PASSENGERS, RAW_ZONES

# FIXED VALUES: texts that a pandas CSV reader turns into missing values by
# default; the zone lookup relies on this ("N/A" boroughs become null).
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _read_csv_as_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    return spark.read.schema(text).option("header", True).csv(path)


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        c = F.when(c.isin(*NA_STRINGS) | c.isNull(), F.lit(None)).otherwise(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """A3: header CSV with LocationID, Borough, Zone, service_zone; NA texts -> null."""
    return _typed(_read_csv_as_text(spark, path, RAW_ZONES), RAW_ZONES)


def read_passengers_csv(spark: SparkSession, path: str) -> DataFrame:
    """A4: the sample passenger CSV with an explicit schema."""
    return _typed(_read_csv_as_text(spark, path, PASSENGERS), PASSENGERS)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV export (one directory of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def literal_rows(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id``."""
    one = spark.range(1).select(F.lit(1).cast("int").alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionAll(null)


def literal_rows_filtered(rows: DataFrame) -> DataFrame:
    """``where id = 1``."""
    return rows.where(F.col("id") == 1)
