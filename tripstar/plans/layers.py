"""Layer jobs (N1/N2): raw -> bronze -> silver -> gold.

``Lakehouse`` wires the DataFrame functions of :mod:`tripstar.operators` into
lazily built layers over any raw source (monthly files, managed tables or the
test fixture).  ``build_*`` write each layer as tables in order and return the
data-test report of the layer, like the reference's layer runners.  A layer is
tested before anybody can read it (:mod:`.publish`): when a test fails, the build
stops and the last good version stays current.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property, partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..operators import bronze, gold, quality, silver
from ..session import COMPRESSION, OPEN_FILES, scratch_tables, sql_setting, write_unsorted
from ..sources import fixture
from . import layout
from .publish import Publications, Version


@dataclass
class Lakehouse:
    spark: SparkSession
    raw_yellow: DataFrame
    raw_green: DataFrame
    raw_zones: DataFrame
    cfg: PipelineConfig = DEFAULT
    # Both services' raw rows in one frame with a SERVICE column, when the
    # source produces them together (the fixture); written once by build_bronze.
    raw_combined: DataFrame | None = None
    # Identity of the raw tables; a build can only be resumed if there is one.
    source: str | None = None

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, cfg: PipelineConfig = DEFAULT) -> "Lakehouse":
        rows = fixture.trip_rows(spark, sf_dir, cfg)
        return cls(
            spark,
            fixture.raw_from_rows(rows, "yellow"),
            fixture.raw_from_rows(rows, "green"),
            fixture.raw_zones(spark, sf_dir),
            cfg,
            raw_combined=rows,
            source=f"fixture {sf_dir.rstrip('/')}",
        )

    @classmethod
    def from_raw_tables(cls, spark: SparkSession, raw_root: str, cfg: PipelineConfig = DEFAULT) -> "Lakehouse":
        """Production source: the raw tables written by :mod:`tripstar.plans.loader`."""
        from . import loader

        return cls(
            spark,
            loader.read_raw(spark, raw_root, "yellow"),
            loader.read_raw(spark, raw_root, "green"),
            spark.read.parquet(f"{raw_root.rstrip('/')}/raw_zones"),
            cfg,
            source=loader.raw_version(spark, raw_root),
        )

    # bronze
    @cached_property
    def bronze_yellow(self) -> DataFrame:
        return bronze.bronze_yellow(self.raw_yellow)

    @cached_property
    def bronze_green(self) -> DataFrame:
        return bronze.bronze_green(self.raw_green)

    @cached_property
    def bronze_zones(self) -> DataFrame:
        return bronze.bronze_zones(self.raw_zones)

    # silver
    @cached_property
    def union(self) -> DataFrame:
        return silver.trips_union(self.bronze_yellow, self.bronze_green)

    @cached_property
    def standardized(self) -> DataFrame:
        return silver.standardized(self.union, self.bronze_zones, self.cfg)

    @cached_property
    def silver(self) -> DataFrame:
        return self.standardized.where(silver.passes(silver.quality_rules(self.cfg)))

    # gold
    @cached_property
    def dims(self) -> gold.Dimensions:
        return gold.build_dimensions(self.silver)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fct_trips(self.silver, self.dims, self.cfg)


# --- materialised layers (N1 / N2) ------------------------------------------------------
DIM_NAMES = [
    "dim_date_pickup", "dim_date_dropoff", "dim_time_pickup", "dim_time_dropoff", "dim_zone_pickup",
    "dim_zone_dropoff", "dim_vendor", "dim_rate_code", "dim_payment_type", "dim_service_type",
    "dim_trip_type",
]
# Row groups of the clustered fact: small enough for min/max pruning inside a file.
FACT_ROW_GROUP_BYTES = 32 * 1024 * 1024


# Shuffled bytes of one task's side of a join that are hashed instead of sorting both sides.
HASHED_BYTES = "128m"

LAYER_TABLES = {
    "bronze": ["raw_trips", "bronze_yellow", "bronze_green", "bronze_zones"],
    "silver": ["silver"],
    "gold": [*DIM_NAMES, "fct_trips"],
}
_LAYER_OF = {t: layer for layer, names in LAYER_TABLES.items() for t in names}
REPORT_SCHEMA = "`table` string, `column` string, test string, failing_rows long, layer string, version int, run string"


@dataclass
class Tables:
    """Published layer tables under ``root``.

    An object reads one state: the versions that were current when it first looked.
    Its own builds move it on, as does :meth:`refresh`.
    """

    spark: SparkSession
    root: str
    cfg: PipelineConfig = DEFAULT
    ran: list[str] = field(default_factory=list)  # steps that run_pipeline did not skip
    _current: dict[str, Version] | None = None

    @property
    def publications(self) -> Publications:
        return Publications(self.spark, self.root)

    def refresh(self) -> "Tables":
        self._current = {layer: versions[-1] for layer, versions in self.publications.history().items()}
        return self

    def version(self, layer: str) -> Version | None:
        if self._current is None:
            self.refresh()
        return self._current.get(layer)

    def publish(self, draft: Version, source: str) -> None:
        done = self.publications.publish(draft, source)
        self.refresh()
        self._current[done.layer] = done

    def path(self, name: str) -> str:
        """Folder of a table in the current version of its layer."""
        layer = _LAYER_OF[name]
        version = self.version(layer)
        return self.publications.path(version, name) if version else f"{self.root}/{layer}/unpublished/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def report_history(self) -> DataFrame:
        """Data-test reports of every build, those that failed included."""
        return self.spark.read.schema(REPORT_SCHEMA).parquet(f"{self.root}/test_reports")

    @property
    def test_reports(self) -> DataFrame:
        """Data-test reports of the current versions."""
        self.version("bronze")
        return self.report_history().where(F.col("run").isin([v.run for v in self._current.values()]))

    @property
    def bronze_yellow(self) -> DataFrame:
        return self.read("bronze_yellow")

    @property
    def bronze_green(self) -> DataFrame:
        return self.read("bronze_green")

    @property
    def bronze_zones(self) -> DataFrame:
        return self.read("bronze_zones")

    @property
    def silver(self) -> DataFrame:
        return self.read("silver")

    @property
    def dims(self) -> gold.Dimensions:
        return gold.Dimensions(*[self.read(n) for n in DIM_NAMES])

    @property
    def fact(self) -> DataFrame:
        return self.read("fct_trips")

    def lakehouse(self) -> "Lakehouse":
        """A lazy pipeline whose raw layer is this bronze (for per-step views)."""
        lk = Lakehouse(self.spark, None, None, None, self.cfg, None)
        lk.__dict__["bronze_yellow"] = self.bronze_yellow
        lk.__dict__["bronze_green"] = self.bronze_green
        lk.__dict__["bronze_zones"] = self.bronze_zones
        return lk


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def _write_all(frames: dict[str, DataFrame], jobs: int = 4) -> None:
    """Independent tables (path -> rows), a few at a time, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(jobs) as pool:
        list(pool.map(_write, frames.values(), frames))


def build_bronze(lake: Lakehouse, tables: Tables) -> None:
    """Raw -> bronze.  A combined raw source is written once, partitioned by
    service, so each bronze table reads only its own partition."""
    draft = tables.publications.draft("bronze")
    path = partial(tables.publications.path, draft)
    by, bg = lake.bronze_yellow, lake.bronze_green
    with scratch_tables(tables.spark):
        if lake.raw_combined is not None:
            # a file for each of the two services stays open, so rows are not sorted by service, and
            # line items are not sorted to meet their orders where a task's orders fit a hash table
            with (sql_setting(tables.spark, OPEN_FILES, "2"),
                  sql_setting(tables.spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED_BYTES)):
                write_unsorted(lake.raw_combined.write.option("compression", COMPRESSION).partitionBy("SERVICE"), path("raw_trips"))
            raw = tables.spark.read.parquet(path("raw_trips"))
            by = bronze.bronze_yellow(fixture.raw_from_rows(raw, "yellow"))
            bg = bronze.bronze_green(fixture.raw_from_rows(raw, "green"))
        _write_all({path("bronze_yellow"): by, path("bronze_green"): bg, path("bronze_zones"): lake.bronze_zones})
    tables.publish(draft, bronze_source(lake))


def bronze_source(lake: Lakehouse) -> str:
    """What a bronze version is built from; empty if the raw tables have no identity."""
    return f"{lake.source}|{lake.cfg}" if lake.source else ""


def _gate(tables: Tables, draft: Version, layer: str, report: DataFrame, on_fail: str) -> DataFrame:
    """Write a test report of a draft, then let it stop the build."""
    path = f"{tables.root}/test_reports/layer={layer}/version={draft.number}/run={draft.run}"
    _write(report, path)
    written = tables.spark.read.parquet(path)
    quality.assert_quality(written, on_fail)
    return written


def build_silver(tables: Tables, on_fail: str = "raise") -> DataFrame:
    """Silver from the bronze tables; returns the evaluated data-test report."""
    draft = tables.publications.draft("silver")
    # The zone lookup is checked first: duplicated ids would multiply trips.
    path = tables.publications.path(draft, "silver")
    with scratch_tables(tables.spark):
        zones = _gate(tables, draft, "zones", quality.run_checks(tables.bronze_zones, quality.zone_checks()), on_fail)
        _write(tables.lakehouse().silver, path)
        report = quality.run_checks(tables.spark.read.parquet(path), quality.silver_checks())
        report = _gate(tables, draft, "silver", report, on_fail)
    tables.publish(draft, _folder(tables, "bronze"))
    return report.unionByName(zones)


def build_gold(tables: Tables, on_fail: str = "raise") -> DataFrame:
    """Dimensions and their tests, then the clustered fact and its tests."""
    draft = tables.publications.draft("gold")
    path, s = partial(tables.publications.path, draft), tables.silver

    def pin(df: DataFrame, name: str) -> DataFrame:
        _write(df, path(name))
        return tables.spark.read.parquet(path(name))

    with scratch_tables(tables.spark):
        # one sorted file each; the shuffle in between keeps the work above spread
        _write_all({path(name): dim.repartition(1).sortWithinPartitions(dim.columns[0])
                    for name, dim in gold.build_dimensions(s, pin).as_dict().items()})
        dims = gold.Dimensions(*[tables.spark.read.parquet(path(n)) for n in DIM_NAMES])
        # a doubled member would multiply facts, so dimensions are tested first
        checked = quality.run_table_checks(dims.as_dict(), quality.dim_checks())
        checked = _gate(tables, draft, "dimensions", checked, on_fail)
        fact = gold.fct_trips(s, dims, tables.cfg)
        files = layout.files_for(tables.spark, tables.path("silver"))
        layout.write_clustered(fact, path("fct_trips"), tables.cfg, files=files, row_group_bytes=FACT_ROW_GROUP_BYTES,
                               weights=gold.cluster_weights(s, dims), derived={"tip_percentage": gold.tip_percentage()},
                               usual={"avg_speed_mph": gold.usual_speed()}, words=gold.FACT_WORDS)
        report = quality.run_checks(tables.spark.read.parquet(path("fct_trips")), quality.fact_checks(), dims.as_dict())
        report = _gate(tables, draft, "gold", report, on_fail)
    tables.publish(draft, _folder(tables, "silver"))
    return report.unionByName(checked)


def _folder(tables: Tables, layer: str) -> str:
    return tables.version(layer).folder


def run_pipeline(lake: Lakehouse, root: str, on_fail: str = "raise", resume: bool = False) -> Tables:
    """Raw -> bronze -> silver (+tests) -> gold (+tests), in order.

    With ``resume``, a layer whose current version was built from the same source is
    kept, so a run after a crash begins at the first unfinished step; the steps
    that ran are in ``Tables.ran``.
    """
    tables = Tables(lake.spark, root.rstrip("/"), lake.cfg)
    steps = {
        "bronze": (lambda: build_bronze(lake, tables), lambda: bronze_source(lake)),
        "silver": (lambda: build_silver(tables, on_fail), lambda: _folder(tables, "bronze")),
        "gold": (lambda: build_gold(tables, on_fail), lambda: _folder(tables, "silver")),
    }
    for layer, (build, source) in steps.items():
        have = tables.version(layer)
        if resume and have and source() and have.source == source():
            continue
        build()
        tables.ran.append(layer)
    return tables


# --- catalog (A6 / B4) --------------------------------------------------------------------
LAYER_DATABASES = {
    "taxis": ["raw_trips"],
    "taxis_bronze": ["bronze_yellow", "bronze_green", "bronze_zones"],
    "taxis_silver": ["silver"],
    "taxis_gold": [*DIM_NAMES, "fct_trips"],
}


def register(tables: Tables, as_views: bool = False, prefix: str = "") -> list[str]:
    """Expose the layer tables by name so queries can ``spark.table(...)`` them.

    Tables are external tables over the folders of the current versions; a name that
    exists is moved to the new folder (B4) without a moment in which it is missing,
    unless its columns changed.  With ``as_views`` they are temporary views instead
    (the reference's default materialisation).  The raw table exists only for a
    combined raw source; any other missing table is an error.
    """
    spark, names = tables.spark, []
    for db, layer_tables in LAYER_DATABASES.items():
        db = f"{prefix}{db}"
        if not as_views:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        for t in layer_tables:
            try:
                df = tables.read(t)
            except AnalysisException:
                if t == "raw_trips":
                    continue
                raise
            if as_views:
                df.createOrReplaceTempView(f"{db}_{t}")
                names.append(f"{db}_{t}")
                continue
            name = f"{db}.{t}"
            if spark.catalog.tableExists(name) and spark.table(name).schema == df.schema and t != "raw_trips":
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{tables.path(t)}'")
                spark.catalog.refreshTable(name)
            else:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
                spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{tables.path(t)}'")
            names.append(name)
    return names
