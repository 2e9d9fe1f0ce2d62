"""Column helpers shared by the operators.

All of them are plain Column expressions, so callers stay in the JVM.
"""

from __future__ import annotations

import gc
import pickle
from collections.abc import Callable
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.session import checkpoint_dir

# A word is a maximal run of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    The value becomes a lambda variable, which the optimizer cannot copy into
    the places that use it (a copied array expression inside another lambda
    would be evaluated again for every element).
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def doc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus


def let_go(spark: SparkSession) -> None:
    """Frees what plans have written that nothing refers to.

    Shuffle files go when the driver finds their plans unreachable, which it only
    notices when it collects garbage; the one-row job makes the scheduler let go of
    the plan that ran last.
    """
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives lost executors).

    What earlier plans have written is freed first instead of being kept to the end.
    """
    checkpoint_dir(spark)
    let_go(spark)
    return df.checkpoint()


def share(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcast of a value of bounded size; classes travel by value too."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast) -> Any:
    """The value of :func:`share` inside a task."""
    return pickle.loads(shared.value)
