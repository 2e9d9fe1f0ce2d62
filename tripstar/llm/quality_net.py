"""Document quality from random-indexing word vectors and a two-layer network.

Word vectors: every token falls into one of ``BUCKETS`` hash buckets with a
fixed sparse ternary index vector; the context vector of a bucket is the sum of
the index vectors of its neighbours (up to ``REACH`` tokens either side) over
the whole corpus.  Tasks sum whole partitions into integer arrays, Spark adds
them per bucket, and the table (BUCKETS x DIM, a fixed bound) is broadcast.
Integer sums make the table independent of task order.

A document is the mean of the unit vectors of its tokens; a two-layer numpy
network scores it, and a temperature fitted on held-back training rows turns the
logit into a probability.  The network is fitted on the driver from about
``sample`` labelled documents.

Defined cases: a text without tokens (null, empty) pools to the zero vector and
is scored like any other; without labels or with one class only the score is
the smoothed share of positives.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import received, share
from tripstar.llm.training import Adam, sigmoid

BUCKETS = 1 << 14
DIM = 32
NONZERO = 2
REACH = 2
SAMPLE = 8000
HIDDEN = 32
CACHE_TOKENS = 300_000
CHUNK_TOKENS = 400_000

# letter runs, digit runs, and runs of one repeated mark
_TOKEN = re.compile(r"[^\W\d_]+|\d+|([^\w\s]|_)\1*")


class Buckets:
    """Token -> bucket with a bounded memo."""

    def __init__(self) -> None:
        self._memo: dict[str, int] = {}

    def _of(self, token: str) -> int:
        if token.isdigit():
            token = f"<num{min(len(token), 20)}>"
        elif len(token) > 1 and token.isupper():
            token = "<upper>"
        return zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % BUCKETS

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        memo, out = self._memo, []
        for match in _TOKEN.finditer(text):
            token = match.group()
            known = memo.get(token)
            if known is None:
                if len(memo) >= CACHE_TOKENS:
                    memo.clear()
                known = memo[token] = self._of(token)
            out.append(known)
        return out


def index_vectors(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the nonzero entries of every bucket's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, size=(BUCKETS + 1, NONZERO)), rng.choice([-1, 1], size=(BUCKETS + 1, NONZERO))


def chunks(texts: Iterable[str | None], buckets: Buckets, size: int = CHUNK_TOKENS) -> Iterator[list[list[int]]]:
    """Token ids of whole documents, grouped to about ``size`` tokens."""
    group, total = [], 0
    for text in texts:
        ids = buckets.ids(text)
        group.append(ids)
        total += len(ids)
        if total >= size:
            yield group
            group, total = [], 0
    if group:
        yield group


def add_contexts(table: np.ndarray, docs: list[list[int]], positions: np.ndarray, signs: np.ndarray) -> None:
    """Add the contexts of some documents to ``table`` (flat, BUCKETS * DIM)."""
    pad = [BUCKETS] * REACH
    ids = np.array([x for d in docs for x in (*d, *pad)], dtype=np.int64)
    for gap in range(1, REACH + 1):
        left, right = ids[:-gap], ids[gap:]
        real = (left < BUCKETS) & (right < BUCKETS)
        left, right = left[real], right[real]
        for word, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                table += np.bincount(word * DIM + positions[other, k], weights=signs[other, k], minlength=BUCKETS * DIM).astype(np.int64)


def word_vectors(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit context vectors per bucket, from every document."""
    columns = [f"v{i}" for i in range(DIM)]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        positions, signs = index_vectors()
        buckets, table = Buckets(), np.zeros(BUCKETS * DIM, dtype=np.int64)
        for frame in frames:
            for group in chunks(frame["_text"], buckets):
                add_contexts(table, group, positions, signs)
        table = table.reshape(BUCKETS, DIM)
        used = np.flatnonzero(table.any(axis=1))
        out = pd.DataFrame(table[used], columns=columns)
        out.insert(0, "bucket", used.astype(np.int32))
        yield out

    sums = docs.select(F.col(text_col).alias("_text")).mapInPandas(partial, "bucket int, " + ", ".join(f"{c} long" for c in columns))
    total = sums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    vectors = np.zeros((BUCKETS, DIM), dtype=np.float32)
    if len(total):
        raw = total[columns].to_numpy(dtype=np.float64)
        vectors[total["bucket"].to_numpy()] = raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)
    return vectors


def pool(docs: list[list[int]], vectors: np.ndarray) -> np.ndarray:
    """Mean unit vector per document (zero without tokens)."""
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    out = np.zeros((len(docs), DIM), dtype=np.float32)
    full = np.flatnonzero(lengths)
    if len(full):
        flat = np.fromiter((x for d in docs for x in d), dtype=np.int64, count=int(lengths.sum()))
        starts = np.cumsum(lengths[full]) - lengths[full]
        out[full] = np.add.reduceat(vectors[flat], starts, axis=0) / lengths[full, None]
    return out


class Network:
    """DIM -> HIDDEN (tanh) -> 1 with inputs standardised on the training rows."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p = {"w1": rng.normal(0, DIM ** -0.5, (DIM, HIDDEN)), "b1": np.zeros(HIDDEN),
                  "w2": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "b2": np.zeros(1)}
        self.mean, self.scale, self.temperature = np.zeros(DIM), np.ones(DIM), 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale) @ self.p["w1"] + self.p["b1"])
        return h @ self.p["w2"] + self.p["b2"][0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 128, seed: int = 4) -> Network:
        share = (y.sum() + 1) / (len(y) + 2)
        self.p["b2"][:] = np.log(share / (1 - share))
        if len(np.unique(y)) < 2:
            self.p["w2"][:] = 0
            return self
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        held, rows = order[: len(y) // 5], order[len(y) // 5:]
        self.mean, self.scale = x[rows].mean(0), x[rows].std(0) + 1e-6
        adam = Adam(self.p, 3e-3)
        for _ in range(epochs):
            rng.shuffle(rows)
            for at in range(0, len(rows), batch):
                pick = rows[at:at + batch]
                z = (x[pick] - self.mean) / self.scale
                h = np.tanh(z @ self.p["w1"] + self.p["b1"])
                d = (sigmoid(h @ self.p["w2"] + self.p["b2"][0]) - y[pick]) / len(pick)
                dh = np.outer(d, self.p["w2"]) * (1 - h * h)
                adam.step(self.p, {"w1": z.T @ dh + 1e-4 * self.p["w1"], "b1": dh.sum(0),
                                   "w2": h.T @ d + 1e-4 * self.p["w2"], "b2": d.sum(keepdims=True)})
        raw, target = self.logits(x[held]), y[held]
        grid = np.geomspace(0.25, 8, 60)
        loss = [np.mean(np.logaddexp(0, raw / t) - target * raw / t) for t in grid]
        if len(held):
            self.temperature = float(grid[int(np.argmin(loss))])
        return self


def fit_quality(sample: DataFrame, vectors: np.ndarray) -> Network:
    """Network from (text, label) rows of a bounded sample."""
    shared = share(sample.sparkSession, vectors)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets, table = Buckets(), received(shared)
        for frame in frames:
            pooled = [pool(g, table) for g in chunks(frame["_text"], buckets)]
            if pooled:
                yield pd.DataFrame({"id": frame["_id"].astype(str), "label": frame["label"], "x": list(np.concatenate(pooled))})

    got = sample.mapInPandas(features, "id string, label double, x array<float>").toPandas()
    got = got.sort_values(["id", "label"], kind="stable")
    network = Network()
    if not len(got):
        network.p["w2"][:] = 0
        return network
    return network.fit(np.stack(got["x"].to_numpy()).astype(np.float64), got["label"].to_numpy())


def score_quality(spark: SparkSession, docs: DataFrame, vectors: np.ndarray, network: Network, text_col: str = "text") -> DataFrame:
    """Input plus ``score`` in 0..1."""
    shared = share(spark, (vectors, network))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, net = received(shared)
        buckets = Buckets()
        for texts in batches:
            parts = [net.scores(pool(g, table)) for g in chunks(texts, buckets)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.withColumn("score", run(F.col(text_col)))
