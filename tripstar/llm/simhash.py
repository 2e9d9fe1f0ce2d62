"""SimHash fingerprints and exact near-duplicate groups by vantage-point trees.

Fingerprint: ASCII-lower-cased words, shingles of ``width`` words joined by one
space (repeats count; a shorter text is one shingle), XXH64 with seed 42 of the
UTF-8 bytes; a bit is set if it is set in more than half of the hashes.  No
words: zero.

Links: two fingerprints at ``max_distance`` or fewer differing bits.  Method:
distinct fingerprints are partitioned by a vantage-point tree that is built on
the driver from a sample (about ``SAMPLE_PER_SHARD`` per shard; the sample only
shapes the shards).  At a node a point goes inside if its distance to the
vantage point is at most mu, else outside; by the triangle inequality two linked
points differ by at most r in that distance, so outside points with distance
<= mu + r also go inside.  By induction every linked pair meets in some shard:
the search is exact.  Inside a shard the same tree goes on to leaves of a few
hundred points, which are compared pairwise in blocks.

Dense balls that no vantage point can split (thousands of fingerprints within a
few bits) would be copied at every node.  They are linked through shared
neighbours instead: two points are within 2 bits exactly when some code is
within 1 bit of both, so grouping points by their 65 codes at distance <= 1
finds the same components in linear work.  Such shards take that path as a
Spark job over (code), whose groups hold 65 points at most.

A shard emits links to the smallest point of each local component, never all
pairs; components are then merged over shards (:mod:`components`).

Defined cases: null and empty texts have fingerprint zero and link like any
other; repeated rows get equal results; a null id is ignored by the minimum.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tripstar.llm.common import cut_lineage, received, share
from tripstar.llm.components import connected_components

SEED = 42
SHARD_POINTS = 8192
SAMPLE_PER_SHARD = 64
LEAF_POINTS = 256
CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    if text is None:
        return 0
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(tokens)
    if n == 0:
        return 0
    joined = b" ".join(tokens)
    if n <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=n)
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: n - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(begins), CHUNK):
        hashes = np.array([digest(joined[b:e], SEED) for b, e in zip(begins[at:at + CHUNK], ends[at:at + CHUNK], strict=True)],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * counts > len(begins)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """64-bit fingerprint as a signed long."""

    @pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, width)) for t in texts], dtype="int64")

    return run(text)


class VantageTree:
    """Arrays of a vantage-point tree; leaves carry a shard number."""

    def __init__(self, sample: np.ndarray, leaf: int, radius: int, seed: int = 7):
        self.radius, self.nodes, self.shards, self.dense = radius, [], 0, []
        self._rng = np.random.default_rng(seed)
        self._build(np.unique(sample), leaf)

    def _build(self, points: np.ndarray, leaf: int) -> int:
        me = len(self.nodes)
        self.nodes.append(None)
        best = None
        if len(points) > leaf:
            for vp in self._rng.choice(points, size=min(8, len(points)), replace=False):
                d = np.bitwise_count(points ^ vp)
                mu = int(np.median(d))
                inside = int((d <= mu + self.radius).sum())
                outside = int((d > mu).sum())
                cost = max(inside, outside)
                if outside and (best is None or cost < best[0]):
                    best = (cost, vp, mu, d)
        if best is None or best[0] > 0.9 * len(points):  # small enough, or a ball no vantage point splits
            self.nodes[me] = (None, self.shards, 0, 0)
            if len(points) > leaf:
                self.dense.append(self.shards)
            self.shards += 1
            return me
        _, vp, mu, d = best
        left = self._build(points[d <= mu + self.radius], leaf)
        right = self._build(points[d > mu], leaf)
        self.nodes[me] = (vp, mu, left, right)
        return me

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of point, shard) for every shard that the point belongs to."""
        found, todo = [], [(0, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            vp, mu, left, right = self.nodes[node]
            if vp is None:
                found.append((at, np.full(len(at), mu, dtype=np.int32)))
                continue
            d = np.bitwise_count(points[at] ^ vp)
            todo.append((left, at[d <= mu + self.radius]))
            todo.append((right, at[d > mu]))
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _merge(labels: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Smallest label over each local component of a boolean link matrix."""
    while True:
        low = np.where(linked, labels[None, :], labels.max()).min(axis=1)
        low = np.minimum(low, labels)
        if (low == labels).all():
            return labels
        labels = low


def shard_links(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, smallest point of its leaf component) within one shard."""
    points = np.unique(points)
    tree = VantageTree(points, LEAF_POINTS, radius)
    at, leaf = tree.route(points)
    order = np.argsort(leaf, kind="stable")
    at, leaf = at[order], leaf[order]
    a, b = [], []
    for block in np.split(at, np.flatnonzero(np.diff(leaf)) + 1) if len(at) else []:
        own = points[block]
        for lo in range(0, len(own), 2048):  # a leaf is small; a ball that doesn't split comes in strips
            strip = own[lo:lo + 2048]
            for hi in range(lo, len(own), 2048):
                other = own[hi:hi + 2048]
                both = strip if lo == hi else np.concatenate([strip, other])
                linked = np.bitwise_count(both[:, None] ^ both[None, :]) <= radius
                if linked.sum() == len(both):
                    continue
                label = _merge(np.arange(len(both)), linked)
                moved = label != np.arange(len(both))
                a.append(both[moved])
                b.append(both[label[moved]])
    if not a:
        return points[:0], points[:0]
    return np.concatenate(a), np.concatenate(b)


def near_links(spark: SparkSession, codes: DataFrame, max_distance: int = 2, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the distance.

    ``codes`` has one distinct fingerprint per row in column ``fp``.
    """
    n = codes.count()
    shards = max(1, math.ceil(n / shard_points))
    every = max(1, n // (shards * SAMPLE_PER_SHARD))
    picked = codes.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).collect()
    sample = np.array([r["fp"] for r in picked], dtype=np.int64).view(np.uint64)
    tree = VantageTree(sample, 2 * SAMPLE_PER_SHARD, max_distance)
    shared = share(spark, tree)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = received(shared)
        for frame in frames:
            points = frame["fp"].to_numpy(dtype=np.int64)
            at, shard = own.route(points.view(np.uint64))
            yield pd.DataFrame({"fp": points[at], "shard": shard})

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_links(frame["fp"].to_numpy(dtype=np.int64).view(np.uint64), max_distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = codes.select("fp").mapInPandas(deal, "fp long, shard int")
    if not tree.dense or max_distance != 2:
        return dealt.groupBy("shard").applyInPandas(search, "a long, b long").distinct()
    dealt = cut_lineage(spark, dealt)
    sparse = dealt.where(~F.col("shard").isin(tree.dense)).groupBy("shard").applyInPandas(search, "a long, b long")
    masks = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
    near = dealt.where(F.col("shard").isin(tree.dense)).select("fp").distinct().withColumn("mask", F.explode(masks))
    near = near.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("code"))
    low = near.groupBy("code").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("fps"))
    dense = low.select(F.explode("fps").alias("a"), "b").where("a <> b")
    return sparse.unionByName(dense).distinct()


def simhash_groups(spark: SparkSession, docs: DataFrame, width: int = 3, max_distance: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, ``_fp`` (signed), ``_component`` (smallest id), ``_root`` and ``keep``.

    ``_root`` is the smallest fingerprint of the group: it tells groups apart, which
    the smallest id does not where ids are null or repeat on other texts.
    """
    slim = docs.select(F.col(id_col).alias("_id"), fingerprint_column(F.col(text_col), width).alias("_fp"), *keep)
    slim = cut_lineage(spark, slim)
    codes = slim.groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("low"))
    codes = cut_lineage(spark, codes)
    groups = connected_components(spark, near_links(spark, codes.select("fp"), max_distance))
    rooted = codes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("low").alias("_component"))
    by_code = rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "_component", F.col("root").alias("_root"))
    return slim.join(by_code, "_fp")


def simhash_dedup(spark: SparkSession, docs: DataFrame, width: int = 3, max_distance: int = 2, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One document of each group: the one with the smallest id.

    Rows are told apart by id (null or not) and text hash; of rows equal in both one
    stays.  A null id comes last, so it stays only where the group has no other.
    """
    marked = docs.select(
        F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text_hash"))
    groups = simhash_groups(spark, marked, width, max_distance, "_doc", "_text", keep=("_text_hash",))
    first = groups.groupBy("_root", "_fp").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_text_hash")).alias("r"))
    first = first.groupBy("_root").agg(F.min("r").alias("r")).select(
        F.col("r._id").alias("_winner"), F.col("r._text_hash").alias("_winner_hash")).distinct()
    kept = marked.join(first, F.col("_doc").eqNullSafe(F.col("_winner")) & (F.col("_text_hash") == F.col("_winner_hash")), "left_semi")
    return kept.dropDuplicates(["_doc", "_text_hash"]).select("_row.*")
