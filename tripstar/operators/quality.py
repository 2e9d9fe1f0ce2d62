"""Declarative data tests (K1-K8).

Checks are data (``Check``).  All checks of a table are evaluated in **one scan**, and
those of any number of tables meet in **one small shuffle**.  A row turns into cells:

* one for every ``unique`` key, with a 64-bit hash of its value,
* one with the bits of the other checks it fails, if it fails any (relationships are
  left joins to the distinct parent keys, broadcast when the parent is small).

Cells are counted with map-side combine; what tells of a failure is written as a small
table.  Rows that pass cost nothing beyond their key hashes.  Hashes that occur twice
are confirmed on the values themselves, in a second scan of the tables concerned
(a great many hashes are sent to the rows as bits, see :mod:`.bitmaps`); without any,
which is the rule, there is none.
The result is a small report DataFrame ``(table, column, test, failing_rows)``;
``assert_quality`` is the gate that stops a layer build when a check fails (K8).

Semantics follow the reference's test package: ``not_null`` counts nulls;
``unique`` counts distinct non-null values occurring more than once;
``expression_is_true`` counts rows where the expression is FALSE (a NULL
result passes); ``relationships`` counts non-null child keys without a parent;
``accepted_values`` counts non-null values outside the list.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..session import scratch_path
from .bitmaps import flag_members, write_bitmaps

REPORT_COLUMNS = ["table", "column", "test", "failing_rows"]


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    test: str  # not_null | unique | expression_is_true | relationships | accepted_values
    arg: str | tuple[str, ...] | None = None  # expression / "parent.field" / accepted values

    @property
    def name(self) -> str:
        if self.test == "expression_is_true":
            return f"expression_is_true({self.arg.strip()})"
        if self.test == "relationships":
            return f"relationships({self.arg})"
        return self.test


class DataQualityError(RuntimeError):
    """Raised by the gate; ``failures`` holds (table, column, test, failing rows)."""

    def __init__(self, failures: list[tuple]):
        self.failures = failures
        lines = "\n".join(f"  {t}.{c} {test}: {n} failing rows" for t, c, test, n in failures)
        super().__init__(f"{len(failures)} data test(s) failed:\n{lines}")


# --- check lists of the layers ------------------------------------------------------
MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount"]

SILVER_NOT_NULL = [
    "trip_id", "vendor_id", "passenger_count", "trip_distance", "pickup_datetime_utc",
    "dropoff_datetime_utc", "pickup_datetime_nyc", "dropoff_datetime_nyc", *MONEY,
    "pickup_location_id", "dropoff_location_id",
]
SILVER_EXPRESSIONS = [
    ("passenger_count", "> 0"), ("trip_distance", ">= 0"),
    ("dropoff_datetime_utc", "> pickup_datetime_utc"),
    *[(c, ">= 0") for c in MONEY],
    ("pickup_location_id", "> 0"), ("dropoff_location_id", "> 0"), ("avg_speed_mph", "> 0"),
]
SILVER_ACCEPTED = [
    ("payment_type_description", (*labels.PAYMENT_LABELS.values(), labels.PAYMENT_DEFAULT)),
    ("rate_code_description", (*labels.RATE_LABELS.values(), labels.RATE_DEFAULT)),
    ("duration_flag", (labels.DURATION_SHORT, labels.DURATION_LONG, labels.DURATION_NORMAL)),
    ("speed_flag", (labels.SPEED_HIGH, labels.SPEED_LOW, labels.SPEED_NORMAL)),
    ("service_type", ("yellow", "green")),
]

FACT_FOREIGN_KEYS = [
    ("pickup_date_sk", "dim_date_pickup", True), ("dropoff_date_sk", "dim_date_dropoff", True),
    ("pickup_time_sk", "dim_time_pickup", True), ("dropoff_time_sk", "dim_time_dropoff", True),
    ("pickup_zone_sk", "dim_zone_pickup", True), ("dropoff_zone_sk", "dim_zone_dropoff", True),
    ("vendor_sk", "dim_vendor", True), ("rate_code_sk", "dim_rate_code", True),
    ("payment_type_sk", "dim_payment_type", True), ("service_type_sk", "dim_service_type", False),
    ("trip_type_sk", "dim_trip_type", False),
]
FACT_NOT_NULL = [
    "trip_id", *[fk for fk, _, required in FACT_FOREIGN_KEYS if required],
    "trip_duration_seconds", "avg_speed_mph", "passenger_count", "trip_distance", *MONEY,
]
FACT_EXPRESSIONS = [
    ("trip_duration_seconds", "> 0"), ("avg_speed_mph", "> 0"), ("passenger_count", "> 0"),
    ("trip_distance", "> 0"), *[(c, ">= 0") for c in MONEY], ("congestion_surcharge", ">= 0"),
    ("tip_percentage", ">= 0"),
]


def silver_checks(table: str = "silver_trips") -> list[Check]:
    checks = [Check(table, c, "not_null") for c in SILVER_NOT_NULL]
    checks.append(Check(table, "trip_id", "unique"))
    checks += [Check(table, c, "expression_is_true", e) for c, e in SILVER_EXPRESSIONS]
    checks += [Check(table, c, "accepted_values", v) for c, v in SILVER_ACCEPTED]
    return checks


def fact_checks(table: str = "fct_trips") -> list[Check]:
    checks = [Check(table, c, "not_null") for c in FACT_NOT_NULL]
    checks.append(Check(table, "trip_id", "unique"))
    checks += [Check(table, fk, "relationships", f"{dim}.{fk}") for fk, dim, _ in FACT_FOREIGN_KEYS]
    checks += [Check(table, c, "expression_is_true", e) for c, e in FACT_EXPRESSIONS]
    return checks


def zone_checks(table: str = "bronze_zones") -> list[Check]:
    """A doubled lookup would fan every trip out in the zone joins."""
    return [Check(table, "LOCATIONID", "not_null"), Check(table, "LOCATIONID", "unique")]


# surrogate key and, for zone dimensions, the natural key the fact joins on
DIM_KEYS = {
    "dim_date_pickup": ["pickup_date_sk"], "dim_date_dropoff": ["dropoff_date_sk"],
    "dim_time_pickup": ["pickup_time_sk"], "dim_time_dropoff": ["dropoff_time_sk"],
    "dim_zone_pickup": ["pickup_zone_sk", "pickup_location_id"],
    "dim_zone_dropoff": ["dropoff_zone_sk", "dropoff_location_id"],
    "dim_vendor": ["vendor_sk"], "dim_rate_code": ["rate_code_sk"], "dim_payment_type": ["payment_type_sk"],
    "dim_service_type": ["service_type_sk"], "dim_trip_type": ["trip_type_sk"],
}


def dim_checks() -> list[Check]:
    checks = []
    for dim, keys in DIM_KEYS.items():
        checks.append(Check(dim, keys[0], "not_null"))
        checks += [Check(dim, k, "unique") for k in keys]
    return checks


def all_checks() -> list[Check]:
    return zone_checks() + silver_checks() + dim_checks() + fact_checks()


# --- evaluation -----------------------------------------------------------------------
# Checks whose results share one number.
BITS = 60
# Hashes that occur twice (and their cells) that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def _fails(check: Check, parent_marker: str | None = None) -> Column:
    c = F.col(check.column)
    if check.test == "not_null":
        return c.isNull()
    if check.test == "expression_is_true":
        return ~F.expr(f"`{check.column}` {check.arg}")
    if check.test == "accepted_values":
        return c.isNotNull() & ~c.isin(*check.arg)
    if check.test == "relationships":
        return c.isNotNull() & F.col(parent_marker).isNull()
    raise ValueError(check.test)


@dataclass(frozen=True)
class _Numbered:
    """A check, its place in the report, and the cell that holds its result."""
    check: Check
    place: int
    cell: int
    bit: int = -1  # of the cell's number; unique checks have a cell of their own


def _number(checks: list[Check]) -> list[_Numbered]:
    out, bits, cell = [], BITS, -1
    table = None
    for place, chk in enumerate(checks):
        if chk.test == "unique":
            out.append(_Numbered(chk, place, len(checks) + place))
            continue
        if bits == BITS or chk.table != table:
            cell, bits, table = cell + 1, 0, chk.table
        out.append(_Numbered(chk, place, cell, bits))
        bits += 1
    return out


def _cells(df: DataFrame, numbered: list[_Numbered], parents: dict[str, DataFrame]) -> DataFrame:
    """(cell, h): what a scan of ``df`` has to say about its checks."""
    masks: dict[int, Column] = {}
    unique: list[Column] = []
    for i, n in enumerate(numbered):
        marker = None
        if n.check.test == "relationships":
            parent_name, field = n.check.arg.split(".")
            marker = f"_parent_{i}"
            keys = parents[parent_name].select(F.col(field).alias(marker)).distinct()
            df = df.join(keys, df[n.check.column] == keys[marker], "left")
        if n.check.test == "unique":
            h = F.xxhash64(n.check.column)
            unique.append(F.when(F.col(n.check.column).isNotNull(), F.struct(F.lit(n.cell).alias("cell"), h.alias("h"))))
        else:
            bit = F.when(_fails(n.check, marker), F.lit(1 << n.bit).cast("long")).otherwise(F.lit(0).cast("long"))
            masks[n.cell] = masks[n.cell].bitwiseOR(bit) if n.cell in masks else bit
    failed = [F.when(m != 0, F.struct(F.lit(c).alias("cell"), m.alias("h"))) for c, m in masks.items()]
    return df.select(F.explode(F.array(*unique, *failed)).alias("c")).where("c is not null").select("c.cell", "c.h")


def run_table_checks(tables: dict[str, DataFrame], checks: list[Check],
                     parents: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """The report of all ``checks`` on the given tables; those of other tables are left out.

    The scan runs here; the report reads its (scratch) result.
    """
    numbered = _number([c for c in checks if c.table in tables])
    if not numbered:
        return None
    spark = next(iter(tables.values())).sparkSession
    by_table = {t: [n for n in numbered if n.check.table == t] for t in tables}
    cells = [_cells(tables[t], own, parents or {}) for t, own in by_table.items() if own]
    counts = reduce(DataFrame.unionByName, cells).groupBy("cell", "h").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "check-cells")
    counts.where((F.col("cell") < len(numbered)) | (F.col("n") > 1)).write.parquet(path)
    counts = spark.read.parquet(path)

    found = []
    bits = [(n.cell, n.bit, n.place) for n in numbered if n.bit >= 0]
    if bits:
        places = spark.createDataFrame(bits, "cell int, bit int, place int")
        failed = counts.join(F.broadcast(places), "cell")  # a row per check
        found.append(failed.where(F.expr("(shiftright(h, bit) & 1L) = 1")).groupBy("place").agg(F.sum("n").alias("failing_rows")))
    twice = counts.where(F.col("cell") >= len(numbered)).select("cell", "h")
    hit = {r["cell"]: r["n"] for r in twice.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per unique check
    keys = [n for n in numbered if n.cell in hit]
    if keys:
        few = sum(hit.values()) <= BROADCAST_ROWS
        if few:
            again = _duplicated(tables, keys, F.broadcast(twice))
        else:
            again = _duplicated(_maybe_twice(tables, keys, write_bitmaps(twice, "h", sum(hit.values()))), keys, None)
        found.append(again.groupBy("place").agg(F.count(F.lit(1)).alias("failing_rows")))
    if not found:
        found.append(spark.createDataFrame([], "place int, failing_rows long"))
    listed = spark.createDataFrame([(n.place, n.check.table, n.check.column, n.check.name) for n in numbered],
                                   "place int, `table` string, `column` string, test string")
    report = listed.join(reduce(DataFrame.unionByName, found), "place", "left")
    return report.select(*REPORT_COLUMNS[:3], F.coalesce("failing_rows", F.lit(0)).cast("long").alias("failing_rows"))


def _duplicated(tables: dict[str, DataFrame], keys: list[_Numbered], twice: DataFrame | None) -> DataFrame:
    """(place, value) of the key values that occur more than once.

    ``twice`` are the hashes that do, and other rows need not move.  Without them all
    values of the given tables are counted, in one shuffle.
    """
    parts = []
    for n in keys:
        column = F.col(n.check.column)
        values = tables[n.check.table].where(column.isNotNull()).select(
            F.lit(n.place).alias("place"), F.lit(n.cell).alias("cell"), F.xxhash64(column).alias("h"), column.cast("string").alias("value"))
        parts.append(values)
    again = reduce(DataFrame.unionByName, parts)
    if twice is not None:
        again = again.join(twice, ["cell", "h"], "left_semi")
    return again.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _maybe_twice(tables: dict[str, DataFrame], keys: list[_Numbered], bitmaps: tuple[DataFrame, int]) -> dict[str, DataFrame]:
    """The rows that may hold a value that occurs more than once in one of the columns of ``keys``."""
    out = dict(tables)
    for table in {n.check.table for n in keys}:
        columns = [n.check.column for n in keys if n.check.table == table]
        rows, flags = tables[table].select(*dict.fromkeys(columns)), [f"_twice_{i}" for i in range(len(columns))]
        for c, flag in zip(columns, flags, strict=True):
            rows = flag_members(rows, F.xxhash64(c), bitmaps, flag)
        out[table] = rows.where(reduce(Column.__or__, [F.col(f) for f in flags])).drop(*flags)
    return out


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values of ``column`` that occur more than once: one shuffle."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.where(F.col("occurrences") > 1)


def run_checks(df: DataFrame, checks: list[Check], parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate ``checks`` against ``df``; ``parents`` maps dimension names to tables."""
    return run_table_checks({c.table: df for c in checks}, checks, parents)


def assert_quality(report: DataFrame, on_fail: str = "raise") -> list[tuple]:
    """K8 gate: collect the (small) report; raise when any check fails."""
    failures = [tuple(r) for r in report.where(F.col("failing_rows") > 0).collect()]
    if failures and on_fail == "raise":
        raise DataQualityError(failures)
    return failures
