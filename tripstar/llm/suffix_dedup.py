"""Removal of repeated byte strings over the whole corpus, by suffix arrays.

A window is a string of ``length`` bytes inside one text.  Every byte that a window
covers which also starts anywhere else (another text or another place of the same
text, overlaps count) is removed; windows are judged on the input.

Method.  Suffix arrays of shards are built by induced sorting: suffixes are
classified as smaller or larger than their right neighbour, the leftmost-smaller
substrings are sorted, recursively where they are not unique, and the array is
induced from them, a bucket at a time.  Permuted common prefixes (the common
prefix of each suffix with the one before it in the array) are computed for the
irreducible positions and carried on to the others.  A window is repeated if and
only if its suffix shares ``length`` bytes with a neighbour in the array.

Shards, so that equal windows always meet and the corpus is never in one place:

1. Every window is given to the ``GRAM`` bytes inside it with the smallest hash
   (the last such).  Consecutive windows of the same gram form a segment.  Equal
   windows have equal grams in equal places, so they can only stand in segments of
   the same gram; every window stands in exactly one segment.
2. Grams that occur once, which is nearly all of a clean text, are dropped after one
   count over 64-bit hashes, combined map-side.
3. If all segments of a gram are equal (copies), every window of them is repeated:
   the count is the answer, whatever the size of the group.
4. The other distinct segments are fetched once, grouped by gram and sorted in
   shards of ``SHARD_BYTES``, which never split a gram.
5. Grams with more than ``CROWD`` distinct segments (a passage that very many
   documents continue in different ways) are not gathered: their windows are counted
   one by one by a 128-bit hash, spread over all tasks.  The result is the same.

Texts travel twice, grouped by a 128-bit hash with copies combined first; a text
with any share of the rows is one row.  Marks and results in between are written to
the shared folder.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes;
repeated rows count as separate texts, so copies of ``length`` bytes or more lose
everything; ids play no part; an empty table gives an empty result; input columns
are kept, results come under the given names.  What remains is binary, as a cut may
fall inside a character.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.session import checkpoint_dir

LENGTH = 200
GRAM = 64
SHARD_BYTES = 1 << 20
CROWD = 4096
BLOCK_BYTES = 512 << 10
SMALL_ALPHABET = 1024
_LOW = np.uint64(0xFFFFFFFF)


# --- hashes and segments --------------------------------------------------------------
class _Rolling:
    """Hashes of all substrings of one length, from prefix sums modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.symbol = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 40, 1 << 62)) * 2 + 1
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self._up) < n:
            up, down = np.full(n, self.base), np.full(n, self.inverse)
            up[0] = down[0] = 1
            self._up, self._down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        out = np.zeros(n, dtype=np.uint64)
        np.cumsum(self.symbol[data] * self._up[: n - 1], out=out[1:])
        return out

    def between(self, prefixes: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return (prefixes[end] - prefixes[start]) * self._down[: len(prefixes)][start]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF), dtype=np.uint64)
    full[: len(x)] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


class Segmenter:
    """Segments of texts: stretches of windows that share their smallest gram."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        if not 0 < gram <= length:
            raise ValueError("the gram must not be longer than the window")
        self.length, self.gram = length, gram
        self._one, self._two = _Rolling(11), _Rolling(12)

    def segments(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, first window, last window, gram hash, segment hash), a row per segment."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        long = np.flatnonzero(sizes >= self.length)
        if not len(long):
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
        offsets = np.cumsum(sizes) - sizes
        begin, stop = offsets[long], offsets[long] + sizes[long] - self.length + 1  # windows of each text
        one = self._one.prefixes(data)
        grams = self._one.between(one, slice(0, len(data) - self.gram + 1), slice(self.gram, len(data) + 1))
        # hash first, then the later position
        low = _sliding_min((grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64)), self.length - self.gram + 1)
        at = (low & _LOW).astype(np.uint32)
        new = np.ones(len(at) + 1, dtype=bool)
        new[1:-1] = at[1:] != at[:-1]
        new[begin] = new[stop] = True
        edges = np.flatnonzero(new)
        owner = np.searchsorted(begin, edges[:-1], side="right") - 1
        inside = (owner >= 0) & (edges[:-1] < stop[owner])
        first, last, owner = edges[:-1][inside], edges[1:][inside] - 1, owner[inside]
        whole = self._two.between(self._two.prefixes(data), first, last + self.length)
        gram = grams[(_LOW - (low[first] & _LOW)).astype(np.int64)]
        return long[owner], first - begin[owner], last - begin[owner], gram.view(np.int64), whole.view(np.int64)

    def window_hashes(self, segment: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of every window of a segment."""
        data = np.frombuffer(segment, dtype=np.uint8)
        n = len(data) - self.length + 1
        return tuple(r.between(r.prefixes(data), slice(0, n), slice(self.length, self.length + n)).view(np.int64)
                     for r in (self._one, self._two))


# --- suffix arrays --------------------------------------------------------------------
def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last symbol is the only smallest one."""
    step = np.diff(s)
    places = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(places[::-1])[::-1]
    return np.concatenate([step[following] > 0, [True]])


def _induce_buckets(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Suffix array from leftmost-smaller suffixes in order, a bucket of equal first symbols at a time."""
    n, k = len(s), len(size)
    end = np.cumsum(size)
    start = end - size
    out = np.full(n, -1, dtype=np.int64)
    symbols = s.astype(np.uint16)  # sorts by radix
    cuts = np.searchsorted(s[lms], np.arange(k + 1))

    def put(block: np.ndarray, kind: np.ndarray, at: np.ndarray, sign: int) -> None:
        left = block[block > 0] - 1
        left = left[kind[left]]
        if not len(left):
            return
        symbol = symbols[left]
        order = np.argsort(symbol, kind="stable")
        left, symbol = left[order], symbol[order]
        counts = np.bincount(symbol, minlength=k)
        place = np.arange(len(left)) - (np.cumsum(counts) - counts)[symbol]
        out[at[symbol] + place if sign > 0 else at[symbol] - 1 - place] = left
        at += sign * counts

    larger, head, tail = ~smaller, start.copy(), end.copy()
    present = np.flatnonzero(size).tolist()
    for c in present:
        done = start[c]
        while done < head[c]:  # suffixes of the same bucket induce each other in rounds
            block, done = out[done: head[c]], head[c]
            put(block, larger, head, 1)
        put(lms[cuts[c]: cuts[c + 1]], larger, head, 1)
    for c in reversed(present):
        done = end[c]
        while tail[c] < done:
            block, done = out[tail[c]: done][::-1], tail[c]
            put(block, smaller, tail, -1)
        put(out[start[c]: head[c]][::-1], smaller, tail, -1)
    out[0] = n - 1
    return out


def _induce_single(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same, a suffix at a time: for alphabets too large for buckets to be worth an array."""
    ends = np.cumsum(size)
    out = np.full(len(s), -1, dtype=np.int64)
    own = s[lms]
    counts = np.bincount(own, minlength=len(size))
    out[ends[own] - counts[own] + np.arange(len(lms)) - (np.cumsum(counts) - counts)[own]] = lms
    out = out.tolist()
    # symbol of the suffix one to the left if it is of the kind asked for; the entry at -1 is for free places
    left = np.full(len(s) + 1, -1, dtype=np.int64)
    left[1:-1] = np.where(smaller[:-1], -1, s[:-1])
    bucket, head = left.tolist(), (ends - size).tolist()
    for i in out:  # sees what is put further on
        c = bucket[i]
        if c >= 0:
            h = head[c]
            out[h] = i - 1
            head[c] = h + 1
    left[1:-1] = np.where(smaller[:-1], s[:-1], -1)
    bucket, tail = left.tolist(), ends.tolist()
    for i in reversed(out):
        c = bucket[i]
        if c >= 0:
            t = tail[c] - 1
            out[t] = i - 1
            tail[c] = t
    out[0] = len(s) - 1
    return np.array(out, dtype=np.int64)


def _names(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Numbers of the leftmost-smaller substrings, equal for equal ones, in the order given."""
    length = np.ones(len(s), dtype=np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    left, at = np.flatnonzero(same), 0
    while len(left):
        equal = s[a[left] + at] == s[b[left] + at]
        same[left[~equal]] = False
        at += 1
        left = left[equal & (length[a[left]] > at)]
    return np.concatenate([[0], np.cumsum(~same)])


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of whole numbers by induced sorting; the last one is 0 and the only 0."""
    if len(s) <= 1:
        return np.zeros(len(s), dtype=np.int64)
    smaller = _types(s)
    is_lms = np.concatenate([[False], smaller[1:] & ~smaller[:-1]])
    lms = np.flatnonzero(is_lms)
    size = np.bincount(s)
    induce = _induce_buckets if len(size) <= SMALL_ALPHABET and len(s) > 16 * len(size) else _induce_single
    rough = lms[np.argsort(s[lms], kind="stable")]
    found = induce(s, smaller, rough, size)
    order = found[is_lms[found]]
    names = _names(s, lms, order)
    if names[-1] + 1 < len(order):
        reduced = np.empty(len(s), dtype=np.int64)
        reduced[order] = names
        order = lms[suffix_array(reduced[lms])]
    return induce(s, smaller, order, size)


def common_prefixes(s: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(for each position its common prefix with the suffix before it in the array, that
    suffix); symbols are below 65,536."""
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    known = np.zeros(n, dtype=bool)
    inner = np.flatnonzero((before > 0) & (np.arange(n) > 0))
    # reducible: the suffixes one symbol to the left are neighbours too, with one more in common
    known[inner] = s[inner - 1] == s[before[inner] - 1]
    start = np.flatnonzero(~known & (before >= 0))
    common = np.zeros(n, dtype=np.int64)
    # four symbols in a comparison; the last one of the string is unique, so it stops every one
    four = np.ndarray(n + 1, dtype="<u8", buffer=np.concatenate([s, np.zeros(4, s.dtype)]).astype("<u2").tobytes(), strides=(2,))
    left, at = start, 0
    while len(left):
        differ = four[left + at] ^ four[before[left] + at]
        done = differ != 0
        bits = differ[done]
        common[left[done]] = at + (bits & 0xFFFF == 0).astype(np.int64) + (bits & 0xFFFFFFFF == 0) + (bits & 0xFFFFFFFFFFFF == 0)
        left, at = left[~done], at + 4
    places = np.where(known, 0, np.arange(n))
    source = np.maximum.accumulate(places)
    return np.where(known, common[source] - (np.arange(n) - source), common), before


def repeated_windows(segments: list[bytes], length: int = LENGTH) -> list[tuple[int, int] | None]:
    """Per segment its first and last window that starts anywhere else in the shard."""
    sizes = np.array([len(x) + 1 for x in segments], dtype=np.int64)
    ends = np.cumsum(sizes)
    # 0 ends the shard, 1 ends a segment, bytes follow
    s = np.ones(int(ends[-1]) + 1, dtype=np.int64)
    s[-1] = 0
    inside = np.ones(len(s), dtype=bool)
    inside[ends - 1] = inside[-1] = False
    s[inside] = np.frombuffer(b"".join(segments), dtype=np.uint8).astype(np.int64) + 2
    common, before = common_prefixes(s, suffix_array(s))
    home = np.repeat(np.arange(len(segments)), sizes)
    rest = ends[home] - 1 - np.arange(len(home))  # bytes left in the segment
    hit = np.flatnonzero((common[:-1] >= length) & (rest >= length))
    hit = np.unique(np.concatenate([hit, before[hit]]))
    out: list[tuple[int, int] | None] = [None] * len(segments)
    owner = home[hit]
    which, first = np.unique(owner, return_index=True)
    last = np.concatenate([first[1:], [len(hit)]]) - 1
    for i, a, b in zip(which.tolist(), hit[first].tolist(), hit[last[: len(which)]].tolist()):
        begin = int(ends[i] - sizes[i])
        out[i] = (a - begin, b - begin)
    return out


# --- Spark ----------------------------------------------------------------------------
def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text; null is the empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def _blocks(texts: list[str | None], length: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Blocks of about ``BLOCK_BYTES``: pieces, the row of each and where it begins.

    A longer text is cut into pieces that share ``length - 1`` bytes, so that every
    window is in one of them.
    """
    pieces, rows, begins, size = [], [], [], 0
    for row, t in enumerate(texts):
        data = (t or "").encode("utf-8", "surrogatepass")
        for begin in range(0, max(1, len(data) - length + 1), BLOCK_BYTES):
            piece = data[begin: begin + BLOCK_BYTES + length - 1]
            if pieces and size + len(piece) > BLOCK_BYTES:
                yield pieces, rows, begins
                pieces, rows, begins, size = [], [], [], 0
            pieces.append(piece)
            rows.append(row)
            begins.append(begin)
            size += len(piece)
    if pieces:
        yield pieces, rows, begins


def _all_segments(keyed: DataFrame, length: int, gram: int, placed: bool) -> DataFrame:
    """A row per segment: gram and segment hash, and where it stands if ``placed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Segmenter(length, gram)
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t1", "t2")] if placed else []
            for pieces, rows, begins in _blocks(batch.column("text").to_pylist(), length):
                owner, first, last, gram_hash, whole = maker.segments(pieces)
                columns = [gram_hash, whole]
                if placed:
                    row, begin = np.array(rows)[owner], np.array(begins)[owner]
                    columns += [*[k[row] for k in keys], first + begin, last + begin]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    names = ["gram", "whole", "t1", "t2", "first", "last"] if placed else ["gram", "whole"]
    source = keyed if placed else keyed.select("text")
    return source.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _fetch(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(gram, whole, n, crowded, data): the bytes of the wanted segments."""
    lists = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "last", "gram", "whole", "n", "crowded")).alias("want"))
    both = texts.join(lists, ["t1", "t2"]).select("text", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("gram", pa.int64()), ("whole", pa.int64()), ("n", pa.int64()), ("crowded", pa.bool_()), ("data", pa.binary())])
        for batch in batches:
            rows: list[dict] = []
            for text, want in zip(batch.column("text"), batch.column("want")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for w in want.as_py():
                    rows.append({"gram": w["gram"], "whole": w["whole"], "n": w["n"], "crowded": w["crowded"],
                                 "data": data[w["first"]: w["last"] + length]})
                    if len(rows) * length > BLOCK_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=kind)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return both.mapInArrow(run, "gram long, whole long, n long, crowded boolean, data binary")


def _shards(segments: DataFrame, length: int, gram: int, shard_bytes: int) -> DataFrame:
    """(gram, whole, lo, hi, h1, h2): repeated windows lo .. hi of a segment from its
    shard's suffix array; for crowded grams a row per window with its hash."""
    names = ["gram", "whole", "lo", "hi", "h1", "h2"]

    def sorted_out(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        found = repeated_windows([x[3] for x in held], length)
        rows = [(x[0], x[1], *f, None, None) for x, f in zip(held, found, strict=True) if f and x[2] == 1]
        return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([(c, pa.int64()) for c in names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Segmenter(length, gram)
        held, size = [], 0
        for batch in batches:
            for g, whole, n, crowded, data in zip(*[batch.column(c).to_pylist() for c in ("gram", "whole", "n", "crowded", "data")]):
                if crowded:
                    h1, h2 = maker.window_hashes(data)
                    at = np.arange(len(h1))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                        np.full(len(h1), g), np.full(len(h1), whole), at, at, h1, h2)], names=names)
                    continue
                if held and size > shard_bytes and held[-1][0] != g:
                    yield sorted_out(held)
                    held, size = [], 0
                held.append((g, whole, n, data))
                size += len(data)
        if held:
            yield sorted_out(held)

    # a crowded gram is spread by its segments
    spread = segments.repartition(F.col("gram"), F.when(F.col("crowded"), F.col("whole"))).sortWithinPartitions("gram")
    return spread.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def repeated_spans(spark: SparkSession, docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   crowd: int = CROWD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(t1, t2, spans): removed byte ranges (start, end) of every distinct text that has any."""
    folder = f"{checkpoint_dir(spark)}/suffixes-{uuid.uuid4().hex[:12]}"

    def pinned(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    keyed = docs.select(*text_key(F.col(text_col)), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = _all_segments(keyed, length, gram, placed=False).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.min("whole").alias("lo"), F.max("whole").alias("hi"))
    shared = counts.where(F.col("n") > 1).select("gram", (F.col("lo") != F.col("hi")).alias("mixed"))
    placed = _all_segments(keyed, length, gram, placed=True).join(shared, "gram")
    marks = pinned(placed.groupBy("t1", "t2", "gram", "whole", "first", "last", "mixed").agg(F.count(F.lit(1)).alias("copies")), "marks")

    mixed = marks.where("mixed")
    distinct = mixed.groupBy("gram", "whole").agg(F.sum("copies").alias("n"), F.min(F.struct("t1", "t2", "first", "last")).alias("at"))
    crowds = distinct.groupBy("gram").agg((F.count(F.lit(1)) > crowd).alias("crowded"))
    wanted = distinct.join(crowds, "gram").select("gram", "whole", "n", "crowded", "at.*")
    texts = keyed.dropDuplicates(["t1", "t2"])
    found = pinned(_shards(_fetch(texts, wanted, length), length, gram, shard_bytes), "found")

    windows = found.where("h1 is not null")
    again = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("h1", "h2")
    crowded = windows.join(again, ["h1", "h2"]).groupBy("gram", "whole").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    single = found.where("h1 is null").select("gram", "whole", "lo", "hi").unionByName(crowded)
    # a segment that stands in several places is repeated as a whole
    whole = distinct.where("n > 1").select("gram", "whole", F.lit(0).cast("long").alias("lo"), (F.col("at.last") - F.col("at.first")).alias("hi"))
    ranges = single.unionByName(whole).groupBy("gram", "whole").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spans = mixed.join(ranges, ["gram", "whole"]).select(
        "t1", "t2", (F.col("first") + F.col("lo")).alias("start"), (F.col("first") + F.col("hi") + length).alias("end"))
    copies = marks.where("not mixed").select("t1", "t2", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    listed = spans.unionByName(copies).groupBy("t1", "t2").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    return listed.select("t1", "t2", merged(F.col("spans")).alias("spans"))


def merged(spans: Column) -> Column:
    """Sorted ranges (start, end) with those that touch or overlap joined."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<start:bigint,end:bigint>>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for ranges in column.to_pylist():
            joined: list[dict] = []
            for r in ranges:
                if joined and r["start"] <= joined[-1]["end"]:
                    joined[-1]["end"] = max(joined[-1]["end"], r["end"])
                else:
                    joined.append(r)
            out.append(joined)
        return pa.array(out, type=kind)

    return run(spans)


def without(text: Column, spans: Column) -> Column:
    """The bytes of ``text`` outside ``spans``, as binary."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for text, cuts in zip(texts.to_pylist(), ranges.to_pylist()):
            data, at, kept = (text or "").encode("utf-8", "surrogatepass"), 0, []
            for c in cuts or []:
                kept.append(data[at: c["start"]])
                at = c["end"]
            out.append(b"".join([*kept, data[at:]]))
        return pa.array(out, type=pa.binary())

    return run(text, spans)


def cut_texts(spark: SparkSession, docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """(t1, t2, text, spans, kept) of every distinct text: its removed ranges and remaining bytes."""
    spans = repeated_spans(spark, docs, text_col, **limits)
    keyed = docs.select(*text_key(F.col(text_col)), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = keyed.dropDuplicates(["t1", "t2"]).join(spans, ["t1", "t2"], "left")
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    texts = texts.withColumn("spans", F.coalesce("spans", nothing))
    return texts.withColumn("kept", without(F.col("text"), F.col("spans")))


def for_rows(docs: DataFrame, per_text: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` (as ``row``) with what ``per_text`` has for their text."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), *text_key(F.col(text_col)))
    return rows.join(per_text, ["t1", "t2"]).drop("t1", "t2")


def dedup_substrings(spark: SparkSession, docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """Every row as ``row`` (all columns but the text) with ``text``, removed ``spans`` and ``kept`` bytes."""
    return for_rows(docs, cut_texts(spark, docs, text_col, **limits), text_col)
