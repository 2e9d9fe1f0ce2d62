"""CRC matrices, weights and ranks against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tripstar.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [None, "", " \n", "One two, TWO!", "Éa é9_z 10", "a b c d e f g h i j k l m n o p q r s t u v", "x" * 300 + " y", "日本語 テキスト", "tab\x00nul\x7fdel"]


def slow_features(text, max_n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)], len(w)


def slow_ranks(docs, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    have, want = Counter(), Counter()
    for counts, texts in ((have, [t for _, t in docs]), (want, target)):
        for t in texts:
            counts.update(zlib.crc32(f.encode()) % buckets for f in slow_features(t, max_n)[0])
    s, t = sum(have.values()), sum(want.values())
    rows = []
    for doc_id, text in docs:
        feats, n_words = slow_features(text, max_n)
        weight = sum(math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets))))
                     for b in (zlib.crc32(f.encode()) % buckets for f in feats))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, n_words, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    ranked = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = len(ranked) * percent // 100
    place = {r: i + 1 for i, r in enumerate(ranked[:drawn])}
    return sorted(((*r, place.get(r)) for r in rows), key=repr)


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_buckets_equal_zlib(max_n):
    packed, doc, starts, lengths, n_words = importance.features(TEXTS, max_n)
    buckets = importance.feature_buckets(packed, starts, lengths, 997)
    got = Counter(zip(doc.tolist(), buckets.tolist()))
    expected = Counter((i, zlib.crc32(f.encode()) % 997) for i, t in enumerate(TEXTS) for f in slow_features(t, max_n)[0])
    assert got == expected
    assert n_words.tolist() == [slow_features(t, 1)[1] for t in TEXTS]


def test_crc_matrix():
    rows = np.random.default_rng(1).integers(0, 256, (50, 13), dtype=np.uint8)
    assert importance.crc_columns(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]


def documents(seed, n):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(60)] + ["É", "Zwei", "the"]
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    for i in range(len(TEXTS), n):
        docs.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))))
    docs.append((None, "the " * 30))
    return docs, [" ".join(rng.choice(vocabulary[:20]) for _ in range(40)) for _ in range(5)]


@pytest.mark.parametrize("max_n,percent", [(1, 10), (2, 35)])
def test_ranks_equal_plain_version(spark, max_n, percent):
    docs, target = documents(2, 200)
    frame = spark.createDataFrame([(i, t, "own") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = importance.resample(spark, frame, goal, max_n=max_n, percent=percent)
    rows = out.collect()
    assert all(r["row"]["score"] == "own" for r in rows)
    got = sorted(((r["row"]["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows), key=repr)
    assert got == slow_ranks(docs, target, max_n=max_n, percent=percent)


def test_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten " * 3
    frame = spark.createDataFrame([(1, text)] * 40 + [(2, "short")], "doc_id long, text string")
    empty = frame.limit(0)
    ranks = [r["rank"] for r in importance.resample(spark, frame, frame).collect()]
    assert sorted(r for r in ranks if r is not None) == [1, 2, 3, 4] and len(ranks) == 41
    assert importance.resample(spark, empty, frame).count() == 0
    assert {r["weight"] for r in importance.resample(spark, frame.limit(1), empty).collect()} < set(range(-10**6, 1))
