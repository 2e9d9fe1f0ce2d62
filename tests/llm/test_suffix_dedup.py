"""Suffix arrays, common prefixes, segments and cuts against plain versions."""

import hashlib
import random

import numpy as np
import pytest

from tripstar.llm import suffix_dedup
from tripstar.llm.queries import op12_suffix_dedup


def strings(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n = rng.randrange(0, 300)
        yield [rng.randrange(1, rng.choice([2, 3, 5, 200])) for _ in range(n)] if n else []
    yield [1] * 200
    yield [1, 2] * 150 + [1]
    yield list(range(1, 200)) + list(range(200, 0, -1))
    a, b = [1], [1, 2]
    while len(b) < 1500:
        a, b = b, b + a
    yield b
    yield [rng.randrange(1, 4) for _ in range(9000)]
    block = [rng.randrange(1, 250) for _ in range(700)]
    yield block * 9 + block[:55]


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_common_prefixes(seed):
    for text in strings(seed):
        s = np.array([*text, 0], dtype=np.int64)
        order = suffix_dedup.suffix_array(s)
        plain = bytes(s.astype(np.uint8)) if s.max() < 256 else None
        if plain is None:
            continue
        expected = sorted(range(len(s)), key=lambda i: plain[i:])
        assert order.tolist() == expected
        common, before = suffix_dedup.common_prefixes(s, order)
        for a, b in zip(expected, expected[1:]):
            n = 0
            while plain[a + n: a + n + 1] == plain[b + n: b + n + 1] != b"":
                n += 1
            assert (common[b], before[b]) == (n, a)


def slow_removed(texts, length):
    """Positions removed in every text, from a table of all windows."""
    seen = {}
    for i, t in enumerate(texts):
        for at in range(len(t) - length + 1):
            seen.setdefault(t[at: at + length], []).append((i, at))
    out = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, at in places:
                out[i].update(range(at, at + length))
    return out


def slow_spans(gone):
    spans = []
    for p in sorted(gone):
        if spans and spans[-1][1] == p:
            spans[-1][1] = p + 1
        else:
            spans.append([p, p + 1])
    return [tuple(s) for s in spans]


def corpus(seed, n, alphabet="abcdefgh é", size=700):
    rng = random.Random(seed)

    def noise(k):
        return "".join(rng.choice(alphabet) for _ in range(k))

    passages = [noise(rng.randrange(100, 420)) for _ in range(6)]
    texts = []
    for i in range(n):
        kind = i % 7
        if kind == 0 and texts:
            texts.append(rng.choice(texts))  # a copy
        elif kind == 1 and texts:
            t = list(rng.choice(texts) or "x")  # a near copy
            for _ in range(3):
                t[rng.randrange(len(t))] = rng.choice(alphabet)
            texts.append("".join(t))
        elif kind == 2:
            p = rng.choice(passages)
            texts.append(noise(rng.randrange(60)) + p + noise(rng.randrange(60)) + p + noise(9))
        elif kind == 3:
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            texts.append(noise(rng.randrange(300)) + p[a: a + rng.randrange(len(p))] + noise(rng.randrange(300)))
        elif kind == 4:
            texts.append("z" * rng.randrange(size) + "ab" * rng.randrange(200))
        else:
            texts.append(noise(rng.randrange(size)))
    return [None, "", "é" * 99 + "a", "é" * 100, *texts]


def rows_of(spark, texts, **limits):
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    out = suffix_dedup.dedup_substrings(spark, docs.repartition(3), **limits)
    return {r["row"]["doc_id"]: r for r in out.collect()}


@pytest.mark.parametrize("limits", [{}, {"crowd": 1}, {"shard_bytes": 2000, "crowd": 6}, {"gram": 5, "length": 40}])
def test_cuts_equal_brute_force(spark, limits):
    texts = corpus(5, 60)
    got = rows_of(spark, texts, **limits)
    coded = [(t or "").encode() for t in texts]
    for i, (data, gone) in enumerate(zip(coded, slow_removed(coded, limits.get("length", 200)), strict=True)):
        assert [tuple(s) for s in got[i]["spans"]] == slow_spans(gone), i
        assert bytes(got[i]["kept"]) == bytes(b for p, b in enumerate(data) if p not in gone)
        assert got[i]["row"]["spans"] == "own"


def test_a_passage_that_everyone_continues_differently(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefghijkl ") for _ in range(250))
    texts = ["".join(rng.choice("mnopq ") for _ in range(rng.randrange(250))) + passage + "".join(rng.choice("rstu ") for _ in range(250))
             for _ in range(60)]
    expected = [slow_spans(g) for g in slow_removed([t.encode() for t in texts], 200)]
    for crowd in (10, 4096):
        got = rows_of(spark, texts, crowd=crowd)
        assert [[tuple(s) for s in got[i]["spans"]] for i in range(60)] == expected


def test_segments_hold_every_window_once():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 199, 200, 201, 1500)]
    owner, first, last, _, _ = suffix_dedup.Segmenter().segments(texts)
    held = sorted((o, w) for o, a, b in zip(owner, first, last) for w in range(a, b + 1))
    assert held == [(i, w) for i, t in enumerate(texts) for w in range(len(t) - 199)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.dedup_substrings(spark, docs).count() == 0


def test_query_equals_plain_version(spark, tmp_path):
    texts = corpus(8, 40) + [None, "short"]
    ids = [None if i == 9 else i // 2 for i in range(len(texts))]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    coded = [(t or "").encode() for t in texts]
    expected = []
    for doc_id, data, gone in zip(ids, coded, slow_removed(coded, 200), strict=True):
        kept = bytes(b for p, b in enumerate(data) if p not in gone)
        expected.append((doc_id, len(data), len(gone), len(slow_spans(gone)), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in op12_suffix_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
