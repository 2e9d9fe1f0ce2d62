"""Write, audit, publish: versions of the layers.

A layer is written to a fresh folder ``<root>/<layer>/v<number>-<run>`` (a draft),
its data tests run there, and only then one row in ``<root>/_published`` makes it
the current version.  Readers look a table up through that row, so they never see
a half-written or a failed build: until the row is there, they read the version
before.

* A publication is one small file in a folder of its own.  It appears with the
  rename of that file, so it is there or not; two builders cannot damage each
  other's.  The highest (number, run) is current.
* ``source`` says what a version was built from: the folder of the layer below, or
  the identity of the raw tables.  The publications are thus the journal of the
  build: a step whose source is unchanged need not run again.
* Publishing keeps this version and the one before it, for readers that still hold
  it.  Folders with a lower number are removed, published or not.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path

SCHEMA = "number int, run string, source string, published_at long, layer string"


@dataclass(frozen=True)
class Version:
    layer: str
    number: int
    run: str
    source: str = ""

    @property
    def folder(self) -> str:
        return f"v{self.number:06d}-{self.run}"


class Publications:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> str:
        return f"{self.root}/_published"

    def table(self) -> DataFrame:
        """All publications; empty before the first one."""
        try:
            return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self._log())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def history(self) -> dict[str, list[Version]]:
        """Versions of every layer, oldest first (one row per publication)."""
        out: dict[str, list[Version]] = {}
        for r in sorted(self.table().collect(), key=lambda r: (r["number"], r["run"])):
            out.setdefault(r["layer"], []).append(Version(r["layer"], r["number"], r["run"], r["source"]))
        return out

    def draft(self, layer: str) -> Version:
        """A version that nobody reads yet."""
        known = self.history().get(layer)
        return Version(layer, known[-1].number + 1 if known else 1, uuid.uuid4().hex[:8])

    def path(self, version: Version, table: str = "") -> str:
        return f"{self.root}/{version.layer}/{version.folder}/{table}".rstrip("/")

    def publish(self, draft: Version, source: str) -> Version:
        done = Version(draft.layer, draft.number, draft.run, source)
        row = self.spark.createDataFrame([(done.number, done.run, source, time.time_ns(), done.layer)], SCHEMA)
        row.coalesce(1).write.parquet(f"{self._log()}/{done.layer}/{done.folder}")
        self._clean(done)
        return done

    def _clean(self, current: Version) -> None:
        """Removes what lies before the version that ``current`` replaces."""
        older = sorted({v.number for v in self.history()[current.layer] if v.number < current.number})
        if not older:
            return
        # folders of the layer: one row per version
        layer = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{current.layer}")
        files = layer.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(layer)
        for name in [f.getPath().getName() for f in files]:
            if name.startswith("v") and int(name[1:7]) < older[-1]:
                remove_path(self.spark, f"{self.root}/{current.layer}/{name}")
