"""Near-duplicate embeddings by product quantisation.

Equal vectors are one class with a count, so copies cost nothing.  Classes go
into inverted lists by their nearest coarse centroid; the residual is coded per
subspace.  A class is compared with every list that it probes: the home list and
each list c with ``d(x,c)^2 - d(x,home)^2 <= 2 * reach * d(c,home)``, that is, with
its point at most ``reach`` beyond the plane between the two centroids.  The
default ``reach = eps / 2``, with eps the distance that the cosine allows, is exact:
two linked vectors on two sides of a plane are at most eps apart, so one of them
lies within eps / 2 of it, and a pair counts if either side probes.

In a list, table lookups give the distance from x to the coded vector y'; rows of
a table hold one codeword for a strip of queries, so a lookup copies a row.  As
``|d(x,y) - d(x,y')| <= |y - y'|`` and that error is stored with the code, the
filter ``d(x,y') <= eps + |y - y'|`` loses nothing.  What is left is decided by
the exact cosine in double precision.

A pair is found if either side probes the other's home list; each member carries
its probed lists, so a pair found from one side only is counted for both.  Small
lists are bundled up to a block of members, and a query is sent once to a bundle,
not once to each list.  Bundles are dealt in blocks of members and queries, so a
list with any share of the rows spreads over tasks.  Tasks return link counts and
links to the smallest class of each local component, never all pairs.

Centroids and codebooks are fitted on the driver on about ``SAMPLE`` classes;
their size is bounded by MAX_LISTS and CODEWORDS.  Every dimension present has its
own, and lists are numbered over all of them, so one search serves all dimensions.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without an id, link with nothing; vectors link within
their dimension; repeated rows are copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import cut_lineage, received, share
from tripstar.llm.components import connected_components

SAMPLE = 16_384
LIST_ROWS = 256
MAX_LISTS = 1024
SUBSPACES = 8
CODEWORDS = 256
MEMBER_BLOCK = 8192
QUERY_BLOCK = 16_384
STRIP = 512


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((centers * centers).sum(1)[None, :] - 2 * x @ centers.T, axis=1)
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=len(centers))
        centers = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centers)
    return centers


class Index:
    """Coarse centroids and residual codebooks over unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float, reach: float | None = None):
        self.dim = dim = sample.shape[1]
        self.parts = min(SUBSPACES, dim)
        self.width = math.ceil(dim / self.parts)
        self.pad = self.parts * self.width - dim
        self.threshold = threshold
        self.eps = math.sqrt(max(0.0, 2 - 2 * threshold))
        self.reach = self.eps / 2 if reach is None else reach
        self.centers = kmeans(sample, lists, 10, 1)
        self.gaps = np.sqrt(np.maximum(((self.centers[:, None] - self.centers[None]) ** 2).sum(-1), 0)) if len(self.centers) <= 2048 else None
        rest = self._split(sample - self.centers[self._distances(sample).argmin(axis=1)])
        self.books = np.stack([self._fill(kmeans(rest[:, m], CODEWORDS, 8, 2 + m)) for m in range(self.parts)])
        self._norms = (self.books ** 2).sum(-1)

    @staticmethod
    def _fill(book: np.ndarray) -> np.ndarray:
        return np.concatenate([book, np.repeat(book[:1], CODEWORDS - len(book), axis=0)])

    def _split(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.pad))).reshape(len(x), self.parts, self.width)

    def _distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        return np.maximum((x * x).sum(1)[:, None] + (self.centers * self.centers).sum(1)[None] - 2 * x @ self.centers.T, 0)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Home list, codes, quantisation errors and the matrix of probed lists."""
        d = self._distances(x)
        home = d.argmin(axis=1)
        rest = self._split(x - self.centers[home])
        codes = np.stack([(self._norms[m][None] - 2 * rest[:, m] @ self.books[m].T).argmin(axis=1) for m in range(self.parts)], axis=1)
        decoded = np.stack([self.books[m][codes[:, m]] for m in range(self.parts)], axis=1)
        error = np.sqrt(((rest - decoded) ** 2).sum((1, 2)))
        probed = d - d[np.arange(len(x)), home][:, None] <= 2 * self.reach * self.gaps[home] + 1e-9
        return home, codes.astype(np.uint8), error, probed

    def estimate(self, queries: np.ndarray, center: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances (coded members x queries) in one list."""
        rest = self._split(queries - self.centers[center])
        out = np.repeat((rest ** 2).sum((1, 2)).astype(np.float32)[None], len(codes), axis=0)
        rest = rest.astype(np.float32)
        for m in range(self.parts):
            table = self._norms[m].astype(np.float32)[:, None] - self.books[m].astype(np.float32) @ (2 * rest[:, m].T)
            out += np.take(table, codes[:, m], axis=0)
        return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _packed(x: np.ndarray) -> list[bytes]:
    """Rows as bytes: single precision where that loses nothing, else double."""
    short = x.astype(np.float32)
    exact = (short == x).all(axis=1)
    return [(a if e else b).tobytes() for a, b, e in zip(short, x, exact, strict=True)]


def _unpacked(rows: np.ndarray, dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(r, dtype=np.float32 if len(r) == 4 * dim else np.float64) for r in rows]).astype(np.float64)


def _search_block(index: Index, first: int, frame: pd.DataFrame) -> pd.DataFrame:
    """Counts and local links of one (bundle, member block, query block); lists are numbered from ``first``."""
    member = frame["member"].to_numpy()
    cid, copies, home = frame["cid"].to_numpy(), frame["m"].to_numpy(), frame["home"].to_numpy()
    probes = frame["probes"].to_numpy()
    y, q = np.flatnonzero(member), np.flatnonzero(~member)
    if not len(y) or not len(q):
        return pd.DataFrame({"cid": [], "links": [], "low": []}, dtype="int64")
    x = _unit(_unpacked(frame["vec"].to_numpy(), index.dim))
    codes = np.stack([np.frombuffer(c, dtype=np.uint8) for c in frame["code"].to_numpy()[y]])
    limit = ((index.eps + frame["err"].to_numpy()[y]) ** 2 + 1e-4).astype(np.float32)
    span = first + len(index.centers)
    asked = np.concatenate([probes[k] for k in q])
    asking = np.repeat(q, [len(probes[k]) for k in q])[np.argsort(asked, kind="stable")]
    asked = np.sort(asked)
    # (member, probed list) as one sorted number
    probed = np.sort(np.concatenate([k * span + probes[k].astype(np.int64) for k in y]))
    links = np.zeros(len(frame), dtype=np.int64)
    moved, lows = [], []
    for center in np.unique(home[y]):
        inside = np.flatnonzero(home[y] == center)
        rows_here = asking[np.searchsorted(asked, center, "left"):np.searchsorted(asked, center, "right")]
        for at in range(0, len(rows_here), STRIP):
            rows = rows_here[at:at + STRIP]
            j, i = np.nonzero(index.estimate(x[rows], center - first, codes[inside]) <= limit[inside][:, None])
            i, j = rows[i], y[inside[j]]
            real = cid[i] != cid[j]
            i, j = i[real], j[real]
            real = np.einsum("ij,ij->i", x[i], x[j]) >= index.threshold
            i, j = i[real], j[real]
            if not len(i):
                continue
            np.add.at(links, i, copies[j])
            back = j * span + home[i]
            seen = probed[np.minimum(np.searchsorted(probed, back), len(probed) - 1)] == back
            one_sided = (home[i] != center) & ~seen
            np.add.at(links, j[one_sided], copies[i[one_sided]])
            nodes, ends = np.unique(np.concatenate([cid[i], cid[j]]), return_inverse=True)
            i, j = ends[:len(i)], ends[len(i):]
            label = np.arange(len(nodes))
            while True:  # smallest class of each component among the strip's pairs
                low = np.minimum(label[i], label[j])
                before = label.copy()
                np.minimum.at(label, i, low)
                np.minimum.at(label, j, low)
                if (before == label).all():
                    break
            other = np.flatnonzero(label != np.arange(len(nodes)))
            moved.append(nodes[other])
            lows.append(nodes[label[other]])
    some = np.flatnonzero(links)
    stars = pd.DataFrame({"cid": np.concatenate([cid[:0], *moved]), "links": 0, "low": np.concatenate([cid[:0], *lows])}).drop_duplicates()
    return pd.concat([stars, pd.DataFrame({"cid": cid[some], "links": links[some], "low": cid[some]})], ignore_index=True).astype("int64")


def _components_are_finite(v):
    return F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                    vec_col: str = "embedding", reach: float | None = None, max_lists: int = MAX_LISTS) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    usable = F.col("vec_id").isNotNull() & (F.size(F.coalesce("vec", F.array().cast("array<double>"))) > 0)
    usable = usable & _components_are_finite(F.col("vec")) & F.exists("vec", lambda c: c != 0)
    classes = rows.where(usable).groupBy("vec").agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("m"))
    classes = cut_lineage(spark, classes.withColumn("cid", F.monotonically_increasing_id()))
    # one row per dimension present
    dims = {r["dim"]: r["n"] for r in classes.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()}

    def unlinked(some: DataFrame) -> DataFrame:
        return some.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))

    if not dims:
        return unlinked(rows)
    total = sum(dims.values())
    rates = F.create_map(*[F.lit(x) for dim, n in dims.items() for x in (dim, min(1.0, max(SAMPLE * n / total, 4.0 * CODEWORDS) / n))])
    u = F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) / float(1 << 30)
    picked = classes.where(u < F.element_at(rates, F.size("vec"))).select("cid", "vec").collect()
    samples = {dim: [] for dim in dims}
    for r in sorted(picked, key=lambda r: r["cid"]):
        samples[len(r["vec"])].append(r["vec"])
    indexes, lists_in = {}, []  # dimension -> its index and first list
    for dim, n in dims.items():
        lists = max(1, min(max_lists, math.ceil(n / LIST_ROWS), len(samples[dim])))
        indexes[dim] = Index(_unit(np.array(samples[dim], dtype=np.float64)), lists, threshold, reach), sum(lists_in)
        lists_in.append(lists)
    shared = share(spark, indexes)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = received(shared)
        for frame in frames:
            for dim, same in frame.groupby(frame["vec"].map(len)):
                index, first = known[dim]
                for at in range(0, len(same), 2048):
                    part = same.iloc[at:at + 2048]
                    vec = np.stack(part["vec"].to_numpy()).astype(np.float64)
                    home, codes, error, probed = index.assign(_unit(vec))
                    lists = [np.flatnonzero(p).astype(np.int32) + np.int32(first) for p in probed]
                    yield pd.DataFrame({"cid": part["cid"], "m": part["m"], "dim": np.int32(dim), "vec": _packed(vec),
                                        "home": (home + first).astype(np.int32), "code": [c.tobytes() for c in codes], "err": error, "probes": lists})

    assigned = classes.select("cid", "m", "vec").mapInPandas(
        deal, "cid long, m long, dim int, vec binary, home int, code binary, err double, probes array<int>")
    assigned = cut_lineage(spark, assigned)
    # one row per list: bounded by max_lists and the dimensions; a bundle has one dimension
    sizes = {r["home"]: r["count"] for r in assigned.groupBy("home").count().collect()}
    bundles, blocks = [], []
    for lists in lists_in:
        fill = math.inf
        for size in (sizes.get(k, 0) for k in range(len(bundles), len(bundles) + lists)):
            if fill + size > MEMBER_BLOCK:
                blocks.append(0)
                fill = 0
            fill += size
            bundles.append(len(blocks) - 1)
            blocks[-1] = math.ceil(fill / MEMBER_BLOCK)
    bundle_of, blocks_of = F.lit(bundles), F.lit(blocks)
    bundled = assigned.withColumn("bundle", F.explode(F.array_distinct(F.transform("probes", lambda p: F.get(bundle_of, p)))))
    bundled = bundled.withColumn("nb", F.get(blocks_of, F.col("bundle"))).where("nb > 0")
    asking = bundled.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("nq"))
    dealt = bundled.join(F.broadcast(asking), "bundle")
    own_block, own_query = F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"), F.pmod(F.xxhash64(F.lit(3), F.col("cid")), F.col("nq")).cast("int")
    queries = dealt.withColumn("member", F.lit(False)).withColumn("q", own_query).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    queries = queries.withColumn("probes", F.filter("probes", lambda p: F.get(bundle_of, p) == F.col("bundle")))
    members = dealt.where(F.get(bundle_of, F.col("home")) == F.col("bundle")).withColumn("member", F.lit(True))
    members = members.withColumn("b", own_block).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
    columns = ["bundle", "b", "q", "member", "cid", "m", "dim", "vec", "home", "code", "err", "probes"]

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        return _search_block(*received(shared)[int(frame["dim"].iloc[0])], frame)

    found = queries.select(*columns).unionByName(members.select(*columns)).groupBy("bundle", "b", "q").applyInPandas(search, "cid long, links long, low long")
    found = cut_lineage(spark, found)
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected_components(spark, found.select(F.col("cid").alias("a"), F.col("low").alias("b")).where("a <> b"))
    rooted = classes.join(counts, "cid", "left").join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "cid"))
    smallest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    per_class = rooted.join(smallest, "root").select("vec", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where(usable).join(per_class, "vec").select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return linked.unionByName(unlinked(rows.where(~F.coalesce(usable, F.lit(False)))))
