"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Tokens are the letter runs of the lower-cased text.  The input of a token is its
hashed word embedding beside the mean of its hashed character 3-, 4- and 5-gram
embeddings (with word boundaries).  A gated recurrent network reads a window of
``WINDOW`` tokens in both directions, attention pools the states, and a linear
unit scores the pool.  Windows overlap by half and cover the whole text; a
document's raw score is that of its worst window, mapped to a probability by
Platt scaling on training documents.

Training is numpy in one task, on about ``SAMPLE`` labelled documents and at
most ``TRAIN_WINDOWS`` of their windows (parameters).  Windows inherit the
document's label at first; from the second round on the windows of toxic
documents that the network finds harmless are set aside (unless they are the
worst of their document), since most of a toxic text is not toxic, and half of
the clean windows are the ones most like toxic ones.

Scoring runs in tasks: token projections are kept in a bounded table, windows
are computed in blocks of ``BLOCK``.

Defined cases: a text without letters (null, empty) has the score of the empty
window; without labels or with one class only every score is the smoothed share
of toxic training documents.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import received, share
from tripstar.llm.training import Adam, fit_line, sigmoid

WORD_BUCKETS = 1 << 13
GRAM_BUCKETS = 1 << 13
GRAMS = (3, 4, 5)
EMBED = 16
HIDDEN = 12
WINDOW = 24
STRIDE = 12
BLOCK = 4096
SAMPLE = 5000
TRAIN_WINDOWS = 24_000
MIN_STEPS = 60
TABLE_TOKENS = 150_000
CHUNK_TOKENS = 200_000

_TOKEN = re.compile(r"[^\W\d_]+")


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def window_starts(n: int) -> range:
    """Starts of the overlapping windows that cover ``n`` tokens."""
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE) if n else range(0)


class Features:
    """Word buckets and character-gram buckets of a list of tokens."""

    def __init__(self, tokens: list[str]):
        self.words = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for t in tokens], dtype=np.int64)
        codes = np.frombuffer("".join(f"\x02{t}\x03" for t in tokens).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        lengths = np.array([len(t) + 2 for t in tokens], dtype=np.int64)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        self.count = np.zeros(len(tokens), dtype=np.float32)
        self.grams = []
        for n in GRAMS:
            if len(codes) < n:
                continue
            key = np.full(len(codes) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                key = (key ^ codes[k:len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            inside = owner[: len(key)] == owner[n - 1:]
            at = owner[: len(key)][inside]
            self.grams.append(((key[inside] % np.uint64(GRAM_BUCKETS)).astype(np.int64), at))
            self.count += np.bincount(at, minlength=len(tokens)).astype(np.float32)
        self.count = np.maximum(self.count, 1)

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        chars = np.zeros((len(self.words), EMBED), dtype=np.float32)
        for ids, at in self.grams:
            if len(ids):
                first = np.flatnonzero(np.diff(at, prepend=-1))
                chars[at[first]] += np.add.reduceat(p["chars"][ids], first, axis=0)
        return np.concatenate([p["words"][self.words], chars / self.count[:, None]], axis=1)

    def push(self, grads: dict[str, np.ndarray], dx: np.ndarray) -> None:
        np.add.at(grads["words"], self.words, dx[:, :EMBED])
        dchars = dx[:, EMBED:] / self.count[:, None]
        for ids, at in self.grams:
            np.add.at(grads["chars"], ids, dchars[at])


def new_params(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(scale: float, *shape: int) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return {
        "words": normal(0.1, WORD_BUCKETS, EMBED), "chars": normal(0.1, GRAM_BUCKETS, EMBED),
        # one matrix per direction; gates in the order update, reset, candidate
        "w": normal((2 * EMBED) ** -0.5, 2, 2 * EMBED, 3 * HIDDEN), "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "u": normal(HIDDEN ** -0.5, 2, HIDDEN, 3 * HIDDEN),
        "wa": normal((2 * HIDDEN) ** -0.5, 2 * HIDDEN, HIDDEN), "ba": np.zeros(HIDDEN, np.float32), "va": normal(0.3, HIDDEN),
        "wo": normal((2 * HIDDEN) ** -0.5, 2 * HIDDEN), "bo": np.zeros(1, np.float32),
    }


def _gate(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Pass:
    """Forward pass over windows; keeps what the backward pass needs.

    ``projected``: (2, tokens, 3H) input projections; ``ids``: (B, L) rows of it;
    ``mask``: (B, L) floats, or None when every window is full.
    """

    def __init__(self, p: dict[str, np.ndarray], projected: np.ndarray, ids: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        self.p, self.ids, self.mask, self.steps = p, ids, mask, []
        size, length = ids.shape
        h = np.zeros((2, size, HIDDEN), dtype=np.float32)
        states = np.empty((length, size, 2 * HIDDEN), dtype=np.float32)
        for t in range(length):
            back = length - 1 - t
            x = np.stack([projected[0][ids[:, t]], projected[1][ids[:, back]]])
            hu = h @ p["u"]
            zr = _gate(x[..., :2 * HIDDEN] + hu[..., :2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            n = np.tanh(x[..., 2 * HIDDEN:] + r * hu[..., 2 * HIDDEN:])
            new = n + z * (h - n)
            m = None
            if mask is not None:
                m = np.stack([mask[:, t], mask[:, back]])[..., None]
                new = h + m * (new - h)
            if keep:
                self.steps.append((h, z, r, n, hu[..., 2 * HIDDEN:], m))
            h = new
            states[t, :, :HIDDEN] = h[0]
            states[back, :, HIDDEN:] = h[1]
        self.states = states
        self.a = np.tanh(states @ p["wa"] + p["ba"])
        e = self.a @ p["va"]
        if mask is not None:
            e = np.where(mask.T > 0, e, np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        if mask is not None:
            e = e * mask.T
        self.alpha = e / np.maximum(e.sum(axis=0), 1e-9)
        self.pool = np.einsum("lb,lbh->bh", self.alpha, states)
        self.logits = self.pool @ p["wo"] + p["bo"][0]

    def backward(self, dlogit: np.ndarray, n_tokens: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights, and of the input projections."""
        p, ids = self.p, self.ids
        length = ids.shape[1]
        g = {"wo": self.pool.T @ dlogit, "bo": dlogit.sum(keepdims=True)}
        dpool = np.outer(dlogit, p["wo"])
        dalpha = np.einsum("bh,lbh->lb", dpool, self.states)
        dstates = self.alpha[..., None] * dpool[None]
        de = self.alpha * (dalpha - (self.alpha * dalpha).sum(axis=0))
        g["va"] = np.einsum("lb,lba->a", de, self.a)
        da = de[..., None] * p["va"] * (1 - self.a * self.a)
        flat = da.reshape(-1, HIDDEN)
        g["wa"], g["ba"] = self.states.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(axis=0)
        dstates += da @ p["wa"].T
        g["u"] = np.zeros_like(p["u"])
        dproj = np.zeros((2, n_tokens, 3 * HIDDEN), dtype=np.float32)
        dh = np.zeros((2, len(ids), HIDDEN), dtype=np.float32)
        for t in range(length - 1, -1, -1):
            back = length - 1 - t
            h, z, r, n, hn, m = self.steps[t]
            dh[0] += dstates[t, :, :HIDDEN]
            dh[1] += dstates[back, :, HIDDEN:]
            dnew = dh if m is None else dh * m
            rest = 0 if m is None else dh * (1 - m)
            dn = dnew * (1 - z) * (1 - n * n)
            dz = dnew * (h - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            dhu = np.concatenate([dz, dr, dn * r], axis=2)
            dx = np.concatenate([dz, dr, dn], axis=2)
            g["u"] += h.transpose(0, 2, 1) @ dhu
            dh = dnew * z + dhu @ p["u"].transpose(0, 2, 1) + rest
            np.add.at(dproj[0], ids[:, t], dx[0])
            np.add.at(dproj[1], ids[:, back], dx[1])
        return g, dproj


class Windows:
    """Windows over a list of token-id lists: matrix of ids, mask, and owner."""

    def __init__(self, docs: list[list[int]]):
        flat = np.fromiter((x for d in docs for x in d), dtype=np.int64, count=sum(map(len, docs)))
        begin, stop, owner, at = [], [], [], 0
        for k, d in enumerate(docs):
            for s in window_starts(len(d)):
                begin.append(at + s)
                stop.append(at + min(len(d), s + WINDOW))
                owner.append(k)
            at += len(d)
        self.flat, self.begin, self.stop, self.owner = flat, np.array(begin, np.int64), np.array(stop, np.int64), np.array(owner, np.int64)

    def take(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        at = self.begin[pick][:, None] + np.arange(WINDOW)
        mask = at < self.stop[pick][:, None]
        ids = self.flat[np.minimum(at, len(self.flat) - 1)]
        return (ids, None) if mask.all() else (np.where(mask, ids, ids[:, :1]), mask.astype(np.float32))


class Model:
    def __init__(self, params: dict[str, np.ndarray], line: tuple[float, float] = (1.0, 0.0)):
        self.p, self.line = params, line

    def project(self, tokens: list[str], step: int = 8192) -> np.ndarray:
        """Input projections (2, tokens, 3H), in steps that bound the work arrays."""
        out = np.empty((2, len(tokens), 3 * HIDDEN), dtype=np.float32)
        for at in range(0, len(tokens), step):
            out[:, at:at + step] = Features(tokens[at:at + step]).inputs(self.p) @ self.p["w"] + self.p["b"]
        return out

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.line[0] * raw.astype(np.float64) + self.line[1])


class Scorer:
    """Raw document scores with a bounded table of token projections."""

    def __init__(self, model: Model, capacity: int = TABLE_TOKENS):
        self.model, self.capacity = model, capacity
        self._reset()

    def _reset(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.empty((2, 0, 3 * HIDDEN), dtype=np.float32)

    def _ids(self, docs: list[list[str]]) -> list[list[int]]:
        fresh = list(dict.fromkeys(t for d in docs for t in d if t not in self.rows))
        if len(self.rows) + len(fresh) > self.capacity and self.rows:
            self._reset()
            fresh = list(dict.fromkeys(t for d in docs for t in d))
        if fresh:
            n = len(self.rows)
            self.rows.update(zip(fresh, range(n, n + len(fresh)), strict=True))
            self.table = np.concatenate([self.table, self.model.project(fresh)], axis=1)
        rows = self.rows
        return [[rows[t] for t in d] for d in docs]

    def raw(self, docs: list[list[str]]) -> np.ndarray:
        """Worst window per document; the empty window's score without tokens."""
        out = np.full(len(docs), self.model.p["bo"][0], dtype=np.float32)
        w = Windows(self._ids(docs))
        if not len(w.begin):
            return out
        logits = np.empty(len(w.begin), dtype=np.float32)
        full = w.stop - w.begin == WINDOW
        with np.errstate(over="ignore"):
            for part in (np.flatnonzero(full), np.flatnonzero(~full)):
                for at in range(0, len(part), BLOCK):
                    pick = part[at:at + BLOCK]
                    logits[pick] = Pass(self.model.p, self.table, *w.take(pick)).logits
        first = np.flatnonzero(np.diff(w.owner, prepend=-1))
        out[w.owner[first]] = np.maximum.reduceat(logits, first)
        return out

    def texts(self, texts: Iterator[str | None]) -> np.ndarray:
        parts, group, total = [], [], 0
        for text in texts:
            group.append(tokens_of(text))
            total += len(group[-1])
            if total >= CHUNK_TOKENS:
                parts.append(self.raw(group))
                group, total = [], 0
        if group:
            parts.append(self.raw(group))
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.float32)


def train(texts: list[str | None], labels: np.ndarray, rounds: int = 4, batch: int = 256, seed: int = 6,
          max_windows: int = TRAIN_WINDOWS, rate: float = 3e-3, dropout: float = 0.25, decay: float = 2e-3) -> Model:
    """Fit the network on three quarters of the labelled texts, its calibration on the rest."""
    params = new_params()
    share_ = (labels.sum() + 1) / (len(labels) + 10)
    prior = float(np.log(share_ / (1 - share_)))
    if len(np.unique(labels)) < 2:
        params["wo"][:] = 0
        return Model(params, (0.0, prior))
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs = [[number.setdefault(t, len(number)) for t in tokens_of(text)] for text in texts]
    names = list(number)
    held = np.zeros(len(docs), dtype=bool)
    held[rng.permutation(len(docs))[: len(docs) // 4]] = True
    windows = Windows(docs)
    target = labels[windows.owner]
    usable = ~held[windows.owner]
    model = Model(params)
    adam = Adam(params, rate)
    toxic, clean = np.flatnonzero(usable & (target == 1)), np.flatnonzero(usable & (target == 0))

    def logits_of(rows: np.ndarray) -> np.ndarray:
        table = model.project(names)
        parts = [Pass(params, table, *windows.take(rows[a:a + BLOCK])).logits for a in range(0, len(rows), BLOCK)]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.float32)

    def run(rows: np.ndarray) -> None:
        rng.shuffle(rows)
        for at in range(0, len(rows), batch):
            pick = rows[at:at + batch]
            ids, mask = windows.take(pick)
            used, local = np.unique(ids, return_inverse=True)
            features = Features([names[i] for i in used])
            kept = (rng.random((len(used), 2 * EMBED)) >= dropout).astype(np.float32) / (1 - dropout)
            x = features.inputs(params) * kept
            step = Pass(params, (x @ params["w"] + params["b"]).astype(np.float32), local.reshape(ids.shape), mask, keep=True)
            dlogit = ((sigmoid(step.logits) - target[pick]) / len(pick)).astype(np.float32)
            grads, dproj = step.backward(dlogit, len(used))
            grads["w"], grads["b"] = x.T @ dproj, dproj.sum(axis=1, keepdims=True)
            grads["words"], grads["chars"] = np.zeros_like(params["words"]), np.zeros_like(params["chars"])
            features.push(grads, (dproj @ params["w"].transpose(0, 2, 1)).sum(axis=0) * kept)
            adam.step(params, grads)
            for k in ("words", "chars"):
                params[k] *= 1 - decay

    half = max_windows // 2
    with np.errstate(over="ignore"):
        positive, negative = rng.permutation(toxic)[:half], rng.permutation(clean)[:half]
        for k in range(rounds):
            rows = np.concatenate([positive, negative])
            # small samples are read several times, so that every round has enough steps
            for _ in range(max(1, MIN_STEPS * batch // max(1, len(rows)))):
                run(rows)
            if k + 1 == rounds:
                break
            # toxic documents keep the windows found toxic, and their worst one in any case
            logits = logits_of(toxic)
            worst = np.full(len(docs), -np.inf)
            np.maximum.at(worst, windows.owner[toxic], logits)
            positive = rng.permutation(toxic[(logits > 0) | (logits >= worst[windows.owner[toxic]])])[:half]
            # half of the clean windows are those most like toxic ones
            some = rng.permutation(clean)[: 4 * half]
            hard = some[np.argsort(-logits_of(some))[: half // 2]]
            negative = np.concatenate([hard, rng.permutation(clean)[: half - len(hard)]])
    raw = Scorer(model, capacity=len(names) + 1).raw([[names[i] for i in d] for d in docs]).astype(np.float64)
    rows = held if len(np.unique(labels[held])) == 2 else ~held
    model.line = fit_line(raw[rows], labels[rows].astype(np.float64))
    return model


def fit_toxicity(sample: DataFrame) -> Model:
    """Model from the (id, text, label) rows of a bounded sample, fitted in one task."""

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"_id": [], "_text": [], "label": []}), *frames], ignore_index=True)
        got["_key"] = got["_id"].astype(str)
        got = got.sort_values(["_key", "label"], kind="stable")
        model = train(list(got["_text"]), got["label"].to_numpy(dtype=np.float64))
        yield pd.DataFrame({"model": [pickle.dumps((model.p, model.line))]})

    row = sample.repartition(1).mapInPandas(fit, "model binary").first()
    # an empty sample may leave no task at all
    return Model(*pickle.loads(row["model"])) if row else train([], np.empty(0))


def score_toxicity(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Input plus ``score`` in 0..1."""
    shared = share(spark, model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(received(shared))
        for texts in batches:
            yield pd.Series(scorer.model.probability(scorer.texts(texts)))

    return docs.withColumn("score", run(F.col(text_col)))
