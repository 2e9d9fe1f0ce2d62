"""Target-distribution importance resampling over hashed n-gram features.

Words are runs of digits, ``a``-``z`` (``A``-``Z`` lower-cased) and bytes beyond
ASCII; features are all runs of 1 to ``max_n`` consecutive words joined by one
space, repeats counted.  A feature falls into the bucket ``crc32(UTF-8) mod
buckets``.  The gain of a bucket is the smoothed log ratio of its share in the
target table and in the corpus, in thousandths; a document's weight is the sum of
the gains of its features.  Adding Gumbel noise, drawn from a hash of the id, and
keeping the highest scores is sampling without replacement in proportion to
``exp(weight)``.

Method: length-bucketed CRC matrices.  The features of a block of texts are
grouped by byte length; the distinct ones of a length are the rows of a
two-dimensional uint8 array, and one column after the other updates the CRCs of
all rows at once.  The buckets are then scattered back to the occurrences.

Scale: two passes over the texts, which are never shuffled.  The counts of a pass
are one array of ``buckets`` longs per task, summed by Spark, and the gains, an
array of the same size, are broadcast (both bounded by that parameter).  A block
holds ``BLOCK_BYTES`` of text, or one longer text.  Ranks come from pinned ranges
of the score order, so no task orders all documents and equal rows spread too.

Defined cases: null and empty texts have no features and weight 0; a null id
draws its noise from the empty text; documents with fewer than ``min_words`` words
are scored but never drawn; ties go to the smaller id (null last), then to the
smaller hash of the text; repeated rows are ranked one by one.  Empty tables give
empty results, an empty target the smoothed ratio.  The input row travels in one
struct, so its columns may have any names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import received, share
from tripstar.operators.ranges import RANGE, pinned_ranges

BUCKETS = 10_000
BLOCK_BYTES = 4 << 20
SEED = 2024


def _byte_classes() -> bytes:
    """Lower-cases A-Z, keeps word bytes, turns all others into spaces."""
    out = bytearray(b" " * 256)
    for b in range(256):
        low = b + 32 if 0x41 <= b <= 0x5A else b
        if 0x30 <= low <= 0x39 or 0x61 <= low <= 0x7A or low >= 0x80:
            out[b] = low
    return bytes(out)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1).astype(np.uint32)
    return c


CLASSES, TABLE = _byte_classes(), _crc_table()


def crc_columns(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a uint8 matrix, one column at a time."""
    crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def features(texts: list[str | None], max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, document, start, length) of every feature, and the words of every text.

    The bytes hold the words of all texts with one space behind each, so a run of
    words is one slice.
    """
    coded = [(t or "").encode("utf-8", "surrogatepass").translate(CLASSES) for t in texts]
    raw = np.frombuffer(b" ".join(coded) + b" ", dtype=np.uint8)
    word = raw != 32
    kept = word.copy()
    kept[1:] |= word[:-1]
    packed = raw[kept]
    ends = np.flatnonzero(packed == 32)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    # words of a text: word beginnings inside its slice of the raw bytes
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    limits = np.cumsum([0, *[len(c) + 1 for c in coded]])
    n_words = np.add.reduceat(begins, limits[:-1], dtype=np.int64) if coded else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    parts = []
    for n in range(1, max_n + 1):
        same = doc[: len(doc) - n + 1] == doc[n - 1:]
        parts.append((doc[: len(doc) - n + 1][same], starts[: len(doc) - n + 1][same], ends[n - 1:][same]))
    docs, begin, end = (np.concatenate(x) for x in zip(*parts))
    return packed, docs, begin, end - begin, n_words


def feature_buckets(packed: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every feature: distinct rows per length, CRCs by column, scattered back."""
    out = np.zeros(len(starts), dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, at, to in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        own = order[at:to]
        rows = np.lib.stride_tricks.sliding_window_view(packed, size)[starts[own]]
        if size <= 8:  # the bytes of a row as one integer: cheaper to sort
            wide = np.zeros((len(rows), 8), dtype=np.uint8)
            wide[:, :size] = rows
            keys = wide.view(np.uint64).ravel()
        else:
            keys = np.ascontiguousarray(rows).view(f"S{size}").ravel()  # features hold no zero byte
        _, one, back = np.unique(keys, return_index=True, return_inverse=True)
        out[own] = (crc_columns(rows[one]) % np.uint32(buckets)).astype(np.int64)[back]
    return out


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of consecutive texts of about ``BLOCK_BYTES`` characters."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t or "") > BLOCK_BYTES:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    if at < len(texts):
        yield at, len(texts)


def bucket_counts(df: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts per bucket; at most ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in _blocks(texts):
                packed, _, starts, lengths, _ = features(texts[a:b], max_n)
                total += np.bincount(feature_buckets(packed, starts, lengths, buckets), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    per_task = df.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths, rounded down; ``buckets`` longs."""
    have, want = ({r["bucket"]: r["n"] for r in c.collect()} for c in (corpus, target))  # bounded by buckets
    all_have, all_want = float(sum(have.values()) + buckets), float(sum(want.values()) + buckets)
    return np.array([math.floor(1000 * math.log((want.get(b, 0) + 1.0) * all_have / ((have.get(b, 0) + 1.0) * all_want)))
                     for b in range(buckets)], dtype=np.int64)


def noise(doc_id: str | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{doc_id or ''}".encode("utf-8", "surrogatepass")).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(spark: SparkSession, docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          max_n: int = 1, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, by default all) with n_words, n_features, weight, score, and what breaks ties."""
    gain = share(spark, gains)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row"),
        F.col(id_col).alias("tie_id"), F.xxhash64(text_col).alias("tie_text"),
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.drop("id", "text")
    for name in ("n_words", "n_features", "weight", "score"):
        out = out.withColumn(name, F.lit(0).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(gain)
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            found = [np.zeros((3, 0), dtype=np.int64)]
            for a, b in _blocks(texts):
                packed, doc, starts, lengths, n_words = features(texts[a:b], max_n)
                got = known[feature_buckets(packed, starts, lengths, len(known))]
                # sums of whole numbers below 2**53 are exact
                weight = np.bincount(doc, weights=got, minlength=b - a).astype(np.int64)
                found.append(np.stack([n_words, np.bincount(doc, minlength=b - a), weight]))
            n_words, n_features, weight = np.concatenate(found, axis=1)
            total = weight + np.array([noise(i, seed) for i in ids], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "tie_id", "tie_text")], *map(pa.array, (n_words, n_features, weight, total))],
                names=["row", "tie_id", "tie_text", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, out.schema)


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", max_n: int = 1, buckets: int = BUCKETS, percent: int = 10,
             min_words: int = 20, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """Every document as ``row`` with n_words, n_features, weight, score and rank.

    ``rank`` is 1, 2, 3 ... for the ``percent`` of the eligible documents that are
    drawn and null for the others; ``where("rank is not null").select("row.*")`` is
    the resampled corpus.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, max_n, buckets), bucket_counts(target, target_text_col, max_n, buckets), buckets)
    scored = score(spark, docs, gains, id_col, text_col, max_n, seed, keep).withColumns({
        "open": F.col("n_words") >= min_words, "tie": F.monotonically_increasing_id()})
    order = [F.col("open").desc(), F.col("score").desc(), F.col("tie_id").asc_nulls_last(), F.col("tie_text").asc(), F.col("tie").asc()]
    pinned = pinned_ranges(scored, order)
    drawn = pinned.agg(F.floor(F.count(F.when(F.col("open"), 1)) * percent / 100).alias("n")).scalar()
    # one row per range
    sizes = pinned.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    placed = pinned.join(F.broadcast(starts), RANGE).withColumn("place", place)
    rank = F.when(F.col("open") & (F.col("place") <= drawn), F.col("place")).cast("long")
    return placed.select("row", "n_words", "n_features", "weight", "score", rank.alias("rank"))
