"""Runs against a brute-force search, and the registered query against a plain version."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tripstar.llm import periodic_runs
from tripstar.llm.queries import op11_periodic_runs


def slow_runs(words, min_length=6):
    n, out, taken = len(words), [], set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - a
            # the smallest period of a stretch is met first
            if length >= 4 * q and (a, length) not in taken:
                taken.add((a, length))
                if length >= min_length:
                    out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_collapse(words, runs):
    drop = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def samples(seed):
    rng = random.Random(seed)
    for _ in range(120):
        kind = rng.randrange(6)
        if kind == 0:
            yield [rng.randrange(2) for _ in range(rng.randrange(0, 90))]
        elif kind == 1:  # one repeated block in noise
            block = [rng.randrange(30) for _ in range(rng.randrange(1, 60))]
            body = (block * rng.randrange(2, 9))[: rng.randrange(1, 400)]
            yield [rng.randrange(50) for _ in range(rng.randrange(40))] + body + [rng.randrange(50) for _ in range(rng.randrange(40))]
        elif kind == 2:  # runs inside the period of a run
            block = [1] * rng.randrange(4, 30) + [rng.randrange(5) for _ in range(rng.randrange(1, 30))]
            yield block * rng.randrange(4, 7)
        elif kind == 3:  # three levels
            inner = [7, 8, 9][: rng.randrange(1, 4)] * rng.randrange(4, 8) + [rng.randrange(100, 120)]
            mid = inner * rng.randrange(4, 6) + [rng.randrange(200, 220)]
            yield mid * 4
        elif kind == 4:  # a few changed words
            block = [rng.randrange(12) for _ in range(rng.randrange(5, 50))] * 9
            for _ in range(rng.randrange(4)):
                block[rng.randrange(len(block))] = 99
            yield block
        else:  # Fibonacci words are full of squares
            a, b = [0], [0, 1]
            while len(b) < rng.randrange(2, 500):
                a, b = b, b + a
            yield b


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    texts = list(samples(seed))
    found = periodic_runs.find_runs([np.array(t, dtype=np.int64) for t in texts])
    for text, runs in zip(texts, found, strict=True):
        assert runs == slow_runs(text)
        words = [str(w) for w in text]
        assert " ".join(periodic_runs.kept_words(words, runs)) == slow_collapse(words, runs)


def test_a_text_alone_gives_the_same_runs():
    texts = [np.array(t, dtype=np.int64) for t in samples(11)]
    together = periodic_runs.find_runs(texts)
    assert together == [periodic_runs.find_runs([t])[0] for t in texts]


def test_long_periods_and_highly_periodic_regions():
    rng = random.Random(4)
    block = [rng.randrange(1000) for _ in range(3000)]
    text = [5] * 4000 + block * 4 + block[:1234] + [6, 7] * 900
    runs = periodic_runs.find_runs([np.array(text, dtype=np.int64)])[0]
    assert (4000, 4 * 3000 + 1234, 3000) in runs or (4000, 4 * 3000 + 1234, 3000) == runs[1]
    assert runs[0][2] == 1 and runs[-1][2] == 2 and len(runs) == 3


def test_defined_cases(spark):
    texts = [None, "", " \n\t", "one", "a b " * 4, "a a a a a", "a a a a a a", "x\x1cy x\x1cy x\x1cy x\x1cy x\x1cy x\x1cy"]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)] * 2, "doc_id long, text string, runs string")
    out = periodic_runs.detect_runs(docs, docs["text"])
    rows = {r["row"]["doc_id"]: r for r in out.collect()}
    assert out.count() == 16 and all(r["row"]["runs"] == "kept" for r in rows.values())
    assert [rows[i]["n_words"] for i in range(8)] == [0, 0, 0, 1, 8, 5, 6, 6]
    assert [tuple(map(tuple, rows[i]["runs"])) for i in range(8)] == [(), (), (), (), ((0, 8, 2),), (), ((0, 6, 1),), ((0, 6, 1),)]
    assert [rows[i]["collapsed"] for i in range(8)] == ["", "", "", "one", "a b", "a a a a a", "a", "x\x1cy"]
    assert periodic_runs.detect_runs(docs.limit(0), docs["text"]).count() == 0


def test_query_equals_plain_version(spark, tmp_path):
    rng = random.Random(9)
    rows = [(None, "a b c"), (3, None), (4, "")]
    for i in range(5, 400):
        words = [rng.choice(["alpha", "beta", "É", "x,", "9"]) + str(rng.randrange(40)) for _ in range(rng.randrange(0, 300))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            if h % 10 == 0:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
                planted += 1
        runs = slow_runs(words)
        row = got[doc_id]
        assert row["n_runs"] == len(runs)
        if runs:
            best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (*best, 1000 * best[1] // best[2])
        else:
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (None,) * 4
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{a},{n_},{q}\n" for a, n_, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(slow_collapse(words, runs).encode()).hexdigest()
    assert planted > 20
