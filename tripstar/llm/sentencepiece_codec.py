"""SentencePiece encoding and decoding with a unigram (best path) segmentation.

The pieces, scores and flags come from a ``.model`` file, which is only read.
Encoding: a space becomes the marker U+2581 (and one is put in front if the model
says so); Viterbi over a double-array trie of the pieces finds the segmentation
with the highest sum of scores (ties: the longer last piece); a character that no
piece covers becomes its UTF-8 bytes as byte pieces, or the unknown piece if the
model has no byte pieces.  Decoding joins the pieces, turns runs of byte pieces
back into text and markers into spaces.

No piece of such a model has a marker behind another character, so a best path
never crosses the border before a marker: text is cut there and equal units are
solved once per task (a bounded memo).  A model with such pieces is segmented as
a whole.  A literal U+2581 in a text is encoded by its bytes, so decoding is the
exact inverse for every text.

The trie (a few hundred thousand cells, bounded by the vocabulary) is built once
on the driver and broadcast.

Defined cases: a null text has null ids; an empty text has none and decodes to
itself; a literal that looks like a control piece is ordinary text.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import received, share

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
# Fixed values of the file format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
MEMO_UNITS = 400_000
TEXTS_AT_ONCE = 256
MEMO_UNIT_BYTES = 64


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at:at + n]
            at += n


class Vocabulary:
    """Pieces, scores and the flags that matter here."""

    def __init__(self, pieces: list[tuple[str, float, int]], dummy_prefix: bool = True):
        self.pieces, self.dummy_prefix = pieces, dummy_prefix
        self.byte_ids = [-1] * 256
        self.unknown = 0
        for i, (text, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(text[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        pieces, dummy = [], True
        for number, value in _fields(data):
            if number == 1:
                text, score, kind = "", 0.0, NORMAL
                for k, v in _fields(value):
                    if k == 1:
                        text = v.decode("utf-8")
                    elif k == 2:
                        score = struct.unpack("<f", v)[0]
                    elif k == 3:
                        kind = v
                pieces.append((text, score, kind))
            elif number == 3:
                flags = dict(_fields(value))
                if flags.get(2) or flags.get(4, 1):
                    raise ValueError("only models with the identity normalizer are supported")
                dummy = bool(flags.get(3, 1))
        return cls(pieces, dummy)


class DoubleArrayTrie:
    """Bytes -> piece id; ``base[s] + byte + 1`` is the child if ``check`` names s."""

    def __init__(self, keys: dict[bytes, int]):
        self.base, self.check, self.value = [0], [0], [-1]
        self._free = 1
        items = sorted(keys.items())
        todo = [(0, 0, len(items), 0)]
        while todo:
            state, lo, hi, depth = todo.pop()
            if lo < hi and len(items[lo][0]) == depth:
                self.value[state] = items[lo][1]
                lo += 1
            children = []
            while lo < hi:
                byte, start = items[lo][0][depth], lo
                while lo < hi and items[lo][0][depth] == byte:
                    lo += 1
                children.append((byte, start, lo))
            if children:
                base = self._place([c[0] for c in children])
                self.base[state] = base
                for byte, start, stop in children:
                    child = base + byte + 1
                    self.check[child] = state
                    todo.append((child, start, stop, depth + 1))
        # room behind the last cell, so that a lookup of any byte stays inside
        self._grow(max(self.base) + 258)

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more

    def _place(self, letters: list[int]) -> int:
        """Smallest base from the first free cell on with room for all letters."""
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        base = max(0, self._free - letters[0] - 1)
        tries = 0
        while True:
            self._grow(base + letters[-1] + 2)
            if all(self.check[base + x + 1] < 0 for x in letters):
                return base
            base += 1
            tries += 1
            if tries > 200:  # crowded front: go on where there is room
                self._free = min(len(self.check), self._free + 64)
                tries = 0


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = v = vocabulary
        usable = {t.encode(): i for i, (t, _, kind) in enumerate(v.pieces) if kind in (NORMAL, USER_DEFINED) and t}
        self.trie = DoubleArrayTrie(usable)
        self._longest = max(map(len, usable), default=0)
        self.scores = [s for _, s, _ in v.pieces]
        normal = [self.scores[i] for i in usable.values()] or [0.0]
        for i, (text, _, kind) in enumerate(v.pieces):
            if kind == USER_DEFINED:  # always preferred over what it is made of
                self.scores[i] = len(text) * max(normal) - 0.1
        self.unknown_score = min(normal) - UNKNOWN_PENALTY
        separable = not any(MARKER in t.lstrip(MARKER) for t, _, kind in v.pieces if kind in (NORMAL, USER_DEFINED))
        self._units = re.compile(f" *[^ {MARKER}]+| +|{MARKER}" if separable else f"[^{MARKER}]+|{MARKER}")
        self._memo: dict[str, tuple[int, ...]] = {}
        self._raw = [bytes([int(t[3:5], 16)]) if kind == BYTE else None for t, _, kind in v.pieces]
        self._text = ["" if kind == CONTROL else t for t, _, kind in v.pieces]

    def best_path(self, data: bytes) -> tuple[int, ...]:
        """Piece ids of the best segmentation of the UTF-8 bytes of one unit."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n, nothing, unknown, longest = len(data), float("-inf"), self.unknown_score, self._longest
        best = [nothing] * (n + 1)
        start_of, piece_of = [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            so_far = best[i]
            if so_far == nothing:
                continue
            lead = data[i]
            char = i + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            state, covered, end = 0, False, i
            for byte in data[i:i + longest]:
                child = base[state] + byte + 1
                if check[child] != state:
                    break
                state = child
                end += 1
                piece = value[child]
                if piece >= 0:
                    if end == char:
                        covered = True
                    score = so_far + scores[piece]
                    if score > best[end]:
                        best[end], start_of[end], piece_of[end] = score, i, piece
            if not covered and so_far + unknown > best[char]:
                best[char], start_of[char], piece_of[char] = so_far + unknown, i, -1
        out: list[int] = []
        end = n
        while end:
            start, piece = start_of[end], piece_of[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(reversed(self._bytes(data[start:end])))
            end = start
        out.reverse()
        return tuple(out)

    def _bytes(self, data: bytes) -> list[int]:
        ids = [self.vocabulary.byte_ids[b] for b in data]
        return ids if min(ids) >= 0 else [self.vocabulary.unknown]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if self.vocabulary.dummy_prefix:
            text = " " + text
        memo, out = self._memo, []
        for unit in self._units.findall(text):
            ids = memo.get(unit)
            if ids is None:
                if unit == MARKER:
                    ids = tuple(self._bytes(MARKER.encode()))
                else:
                    data = unit.replace(" ", MARKER).encode("utf-8", "surrogatepass")
                    ids = self.best_path(data)
                if len(unit) <= MEMO_UNIT_BYTES:
                    if len(memo) >= MEMO_UNITS:
                        memo.clear()
                    memo[unit] = ids
            out.extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        if not len(ids):
            return ""
        raw, text, parts, run = self._raw, self._text, [], []
        if self._has_bytes(ids):
            for i in ids:
                if raw[i] is not None:
                    run.append(raw[i])
                    continue
                if run:
                    parts.append(b"".join(run).decode("utf-8", "replace"))
                    run = []
                parts.append(text[i].replace(MARKER, " "))
            if run:
                parts.append(b"".join(run).decode("utf-8", "replace"))
            joined = "".join(parts)
        else:
            joined = "".join([text[i] for i in ids]).replace(MARKER, " ")
        return joined[1:] if self.vocabulary.dummy_prefix and joined.startswith(" ") else joined

    def _has_bytes(self, ids: list[int]) -> bool:
        raw = self._raw
        return any(raw[i] is not None for i in set(ids))

    def byte_count(self, ids: list[int]) -> int:
        raw = self._raw
        return sum(raw[i] is not None for i in ids) if self._has_bytes(ids) else 0


def encode_documents(spark: SparkSession, docs: DataFrame, model_path: str = DEFAULT_MODEL, text_col: str = "text",
                     prefix: str = "") -> DataFrame:
    """Input plus ``ids``, ``n_byte_ids`` and ``round_trip`` (decoding gives the text)."""
    shared = share(spark, Codec(Vocabulary.read(model_path)))

    @F.pandas_udf("ids array<int>, n_byte_ids int, round_trip boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = received(shared)
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):  # ids as Python numbers are many times a text's size
                texts = batch.iloc[at:at + TEXTS_AT_ONCE]
                ids = [None if t is None else codec.encode(t) for t in texts]
                yield pd.DataFrame({
                    "ids": pd.Series(ids, dtype=object),
                    "n_byte_ids": pd.Series([None if x is None else codec.byte_count(x) for x in ids], dtype="Int32"),
                    "round_trip": pd.Series([None if x is None else codec.decode(x) == t for x, t in zip(ids, texts, strict=True)], dtype="boolean"),
                })

    df = docs.withColumn("_codec", run(F.col(text_col)))
    return df.withColumns({prefix + c: F.col("_codec")[c] for c in ("ids", "n_byte_ids", "round_trip")}).drop("_codec")


def decode_documents(spark: SparkSession, docs: DataFrame, model_path: str = DEFAULT_MODEL, ids_col: str = "ids",
                     out_col: str = "decoded") -> DataFrame:
    """Input plus the text that the ids stand for; null ids give null."""
    shared = share(spark, Codec(Vocabulary.read(model_path)))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = received(shared)
        for batch in batches:
            yield pd.Series([None if x is None else codec.decode([int(i) for i in x]) for x in batch], dtype=object)

    return docs.withColumn(out_col, run(F.col(ids_col)))
