"""Maximal periodic runs of words, by string synchronising sets.

A run of a text is a stretch of consecutive words with smallest period q (words q
apart are equal) and a length of at least ``max(min_length, 4 q)`` that no
neighbouring word extends with period q.  Words of a run after its first q words
repeat what stands before them; :func:`kept_words` drops them.

Method, for one block of texts laid end to end (a unique symbol behind each):

* Small periods, below ``BASE``, are the highly periodic regions.  They are
  detected separately, by comparing the words with themselves shifted by q.
* For every dyadic scale s = BASE, 2 BASE, ... the synchronising set holds the
  positions i where the smallest hash among the windows of s words that begin at
  i .. i + s is that of the first or the last one.  Windows with a period of at
  most s / 4 take no part: they lie in runs already found.  Membership depends on
  the 2 s words from i alone, so equal contexts are chosen alike.
* Positions of equal context (2 s words) that follow each other propose their
  distance as a period, in [s, 2 s).  In a run of period q in that range, q + 1
  positions in a row cannot all be left out, or the run would have a smaller period;
  and two chosen positions of equal context less than q apart would give it one.
  So the first chosen position of every run is paired with the one q further on.
* A proposal is extended word by word in both directions and kept if it is long
  enough and no run of a divisor covers the same stretch.

Window hashes are 64 bits of word numbers, joined by doubling; proposals are
verified on the words themselves, so a collision can never add a run.

Scale: texts are independent, so there is no shuffle.  A block holds
``BLOCK_CHARS`` characters or one longer text; memory is a few arrays of its words,
work is n log n.  At a scale only texts that could hold such a run take part.

Defined cases: null, empty and one-word texts have no runs; a null text collapses
to an empty one; repeated rows get equal results.  The input row travels in one
struct, so its columns may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
EXPONENT = 4
BASE = 8
BLOCK_CHARS = 2 << 20
RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: unrelated hashes for neighbouring numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from block prefixes and suffixes."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, _FREE, dtype=np.uint64)
    full[: len(x)] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def _joined(windows: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as long, where two of ``width`` words stand in a row."""
    return _mixed(windows[:-width] * np.uint64(0x9E3779B97F4A7C15) + windows[width:])


class RunFinder:
    """Runs of one string of symbol numbers in which separators are unique."""

    def __init__(self, symbols: np.ndarray, found: list[tuple[int, int, int]]):
        self.s = symbols
        self.found = found  # start, end, period: at least EXPONENT periods long
        self._known = {(start, end) for start, end, _ in found}

    def _add(self, start: int, end: int, period: int) -> None:
        # the same stretch was found with a divisor of this period before
        if end - start >= EXPONENT * period and (start, end) not in self._known:
            self._known.add((start, end))
            self.found.append((start, end, period))

    def small_periods(self, periods: range) -> None:
        for q in periods:
            if len(self.s) <= q:
                break
            same = self.s[q:] == self.s[:-q]
            if not same.any():
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            begin, end = edge[::2], edge[1::2] + q
            for i in np.flatnonzero(end - begin >= EXPONENT * q).tolist():
                self._add(int(begin[i]), int(end[i]), q)

    def _periodic_windows(self, scale: int) -> np.ndarray:
        """Marks the windows of ``scale`` words with a period of at most scale / 4."""
        change = np.zeros(len(self.s) + 1, dtype=np.int32)
        for start, end, q in self.found:
            if 4 * q <= scale <= end - start:
                change[start] += 1
                change[end - scale + 1] -= 1
        return np.cumsum(change[:-1]) > 0

    def at_scale(self, scale: int, windows: np.ndarray, contexts: np.ndarray) -> None:
        """Runs with a period in [scale, 2 scale).  ``windows`` and ``contexts`` are
        the hashes of the scale and 2 scale words from every position."""
        ids = np.where(self._periodic_windows(scale)[: len(windows)], _FREE, windows)
        low = sliding_min(ids, scale + 1)
        n = min(len(low), len(contexts))
        low = low[:n]
        chosen = np.flatnonzero((low != _FREE) & ((low == ids[:n]) | (low == ids[scale: scale + n])))
        context = contexts[chosen]
        order = np.argsort(context, kind="stable")
        a, b = chosen[order[:-1]], chosen[order[1:]]
        gap = b - a
        hit = (context[order[:-1]] == context[order[1:]]) & (gap >= scale) & (gap < 2 * scale)
        a, gap = a[hit], gap[hit]
        # the first position of a run is followed by at least 2 q equal pairs
        fits = a + 3 * gap <= len(self.s)
        a, gap = a[fits], gap[fits]
        for shift in (lambda q: q, lambda q: q + q // 2, lambda q: 2 * q - 1):
            at = a + shift(gap)
            same = self.s[at] == self.s[at + gap]
            a, gap = a[same], gap[same]
        by_gap = np.lexsort((a, gap))
        seen_gap, seen_end = -1, -1
        for i, q in zip(a[by_gap].tolist(), gap[by_gap].tolist()):
            if q == seen_gap and i < seen_end:
                continue  # inside the stretch just extended
            start, end = self._extend(i, q)
            seen_gap, seen_end = q, end - q
            self._add(start, end, q)

    def _extend(self, i: int, q: int) -> tuple[int, int]:
        """The longest stretch around i in which words q apart are equal."""
        s, n = self.s, len(self.s)
        hi, step = i, 64
        while hi + q < n:
            to = min(hi + step, n - q)
            differs = s[hi:to] != s[hi + q: to + q]
            if differs.any():
                hi += int(differs.argmax())
                break
            hi, step = to, 2 * step
        lo, step = i, 64
        while lo > 0:
            to = max(lo - step, 0)
            differs = (s[to:lo] != s[to + q: lo + q])[::-1]
            if differs.any():
                lo -= int(differs.argmax())
                break
            lo, step = to, 2 * step
        return lo, hi + q


def find_runs(texts: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Runs of every text, given as arrays of word numbers; positions count within the text."""
    found: list[dict[tuple[int, int, int], None]] = [{} for _ in texts]
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    symbols = max((int(t.max()) for t in texts if len(t)), default=0) + 1

    def laid(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The given texts end to end, each followed by a symbol of its own."""
        size = lengths[some] + 1
        offsets = np.concatenate([[0], np.cumsum(size)])
        line = np.empty(offsets[-1], dtype=np.int64)
        for k, i in enumerate(some.tolist()):
            line[offsets[k]: offsets[k + 1] - 1] = texts[i]
            line[offsets[k + 1] - 1] = symbols + k
        return line, offsets

    some, scale, windows, still = np.flatnonzero(lengths >= EXPONENT), BASE, None, []
    while len(some):
        line, offsets = laid(some)
        finder = RunFinder(line, still)
        if windows is None:
            finder.small_periods(range(1, BASE))
            windows, width = _mixed(line.astype(np.uint64) + np.uint64(1)), 1
            while width < BASE:
                windows = _joined(windows, width)
                width *= 2
        contexts = _joined(windows, scale)
        if len(contexts):
            finder.at_scale(scale, windows, contexts)
        home = np.searchsorted(offsets, [r[0] for r in finder.found], side="right") - 1
        for k, (a, b, q) in zip(home.tolist(), finder.found):
            if b - a >= min_length:
                found[some[k]][int(a - offsets[k]), int(b - a), int(q)] = None
        # texts that can hold a run of the next scale go on, with their hashes and runs
        scale *= 2
        longer = np.flatnonzero(lengths[some] >= EXPONENT * scale)
        if not len(longer):
            break
        padded = np.zeros(len(line), dtype=np.uint64)
        padded[: len(contexts)] = contexts
        size = offsets[longer + 1] - offsets[longer]
        begin = np.concatenate([[0], np.cumsum(size)])
        take = np.arange(begin[-1]) - np.repeat(begin[:-1] - offsets[longer], size)
        moved = {int(k): int(begin[j] - offsets[k]) for j, k in enumerate(longer.tolist())}
        still = [(a + moved[k], b + moved[k], q) for k, (a, b, q) in zip(home.tolist(), finder.found) if k in moved]
        hashes = padded[take]
        # windows that reach over the end of their text belong to no other one
        tail = np.repeat(begin[1:], size) - np.arange(begin[-1]) < scale
        hashes[tail] = _mixed(np.flatnonzero(tail).astype(np.uint64) + np.uint64(symbols + len(texts) + 2))
        windows, some = hashes, some[longer]
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def kept_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(dropped[:-1]).tolist(), strict=True) if not d]


def detect_runs(docs: DataFrame, text: Column, min_length: int = MIN_LENGTH, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, by default all) with the number of words, the
    runs by start and period, and the collapsed text (kept words joined by one space)."""
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    source = docs.select(row.alias("row"), text.cast("string").alias("text"))
    out = source.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUN_TYPE).alias("runs"),
                        F.lit(None).cast("string").alias("collapsed"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in _blocks(batch.column("text").to_pylist()):
                numbers: dict[str, int] = {}
                words = [_WORD.findall(t) if t else [] for t in block]
                coded = [np.array([numbers.setdefault(w, len(numbers)) for w in ws], dtype=np.int64) for ws in words]
                found = find_runs(coded, min_length)
                listed = [[{"start": a, "length": n, "period": q} for a, n, q in runs] for runs in found]
                collapsed = [" ".join(kept_words(ws, runs)) for ws, runs in zip(words, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, len(block)), pa.array([len(ws) for ws in words], type=pa.int64()),
                     pa.array(listed, type=kind), pa.array(collapsed, type=pa.string())],
                    names=["row", "n_words", "runs", "collapsed"])
                at += len(block)

    return source.mapInArrow(run, out.schema)


def _blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``BLOCK_CHARS`` characters together."""
    block, size = [], 0
    for t in texts:
        if block and size + len(t or "") > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t or "")
    if block:
        yield block


def repeat_from(text: Column, first: Column, period: Column) -> Column:
    """``text`` with every word i >= ``first`` replaced by word ``first + (i - first) mod period``."""
    # both arrays stand in one lambda variable, so they are evaluated once per row
    plan = F.struct(F.regexp_extract_all(text, F.lit(_WORD.pattern), F.lit(0)).alias("w"), first.cast("int").alias("a"),
                    period.cast("int").alias("p"))

    def word(x: Column, i: Column) -> Column:
        return F.get(x["w"], F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]))

    return F.get(F.transform(F.array(plan), lambda x: F.concat_ws(" ", F.transform(
        x["w"], lambda _, i: word(x, i)))), F.lit(0))
