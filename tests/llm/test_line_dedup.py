"""Line dedup against a brute-force join, with overlaps, copies and hot tokens."""

import random

import pytest

from tripstar.llm import line_dedup


def tokens(line):
    return frozenset(t for t in line.replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if t)


def text_hashes(spark, texts):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h"))
    return {r["t"]: r["h"] for r in df.collect()}


def brute(spark, rows, threshold=0.8):
    """Row -> cleaned text.  An earlier line that matches removes a line."""
    hashes = text_hashes(spark, {t or "" for _, t in rows})
    places = {}
    for i, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            if tokens(line):
                key = ((i is not None, i or 0), hashes[t], pos)
                places[key] = tokens(line)
    order = sorted(places)
    gone = set()
    for k, b in enumerate(order):
        for a in order[:k]:
            x, y = places[a], places[b]
            if len(x & y) >= threshold * len(x | y) - 1e-9:
                gone.add(b)
                break
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None))
            continue
        lines = t.split("\n")
        keep = [x for pos, x in enumerate(lines) if ((i is not None, i or 0), hashes[t], pos) not in gone]
        out.append((i, "\n".join(keep)))
    return out


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, cid string, _th int")
    out = line_dedup.dedup_lines(spark, docs, **kw)
    assert out.columns == ["doc_id", "text", "cid", "_th", "_n_lines", "_n_removed"]
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


@pytest.mark.parametrize(("seed", "vocabulary", "bits"), [(1, 6, 18), (2, 40, 18), (3, 400, 3)])
def test_matches_brute_force(spark, seed, vocabulary, bits):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    lines = []
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randint(0, 6)):
            if lines and rng.random() < 0.5:
                line = rng.choice(lines).split(" ")
                for _ in range(rng.randint(0, 2)):
                    line[rng.randrange(len(line))] = rng.choice(words)
                own.append(" ".join(line))
            else:
                own.append(" ".join(rng.choices(words, k=rng.choice([1, 2, 5, 9, 20, 60]))))
        lines += own
        rows.append((i * 7 % 60, "\n".join(own)))
    assert run(spark, rows, bits=bits) == sorted(brute(spark, rows), key=repr)


def test_edge_cases(spark):
    rows = [(2, None), (3, ""), (4, "\n\n"), (5, "a b\n\na b\n b  a "), (1, "a\tb\nc"), (6, "x " * 30_000), (7, "c"), (7, "c"), (None, "z z"), (8, "z")]
    assert run(spark, rows) == sorted(brute(spark, rows), key=repr)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_group_of_near_copies_does_not_make_all_its_pairs(spark, monkeypatch):
    """Copies with two words of 40 exchanged: any two match, barely."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(240):
        own = list(base)
        for at in rng.sample(range(40), 2):
            own[at] = f"own{i}x{at}"
        rows.append((i, " ".join(own)))
    compared = []
    original = line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda s, docs, classes, pairs, *a: compared.append(pairs.count()) or original(s, docs, classes, pairs, *a))
    assert run(spark, rows) == sorted(brute(spark, rows), key=repr)
    assert sum(compared) < 12 * len(rows)


def test_candidates_are_searched_once(spark, monkeypatch):
    """Lines whose first partner passes the parity map but is no match (five words of 40 differ) search with all others."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(40)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        own = list(base)
        for at in rng.sample(range(40), 5):
            own[at] = f"own{i}x{at}"
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[1:]))]
    searches = []
    original = line_dedup.candidate_pairs
    monkeypatch.setattr(line_dedup, "candidate_pairs", lambda *a: searches.append(1) or original(*a))
    assert run(spark, rows) == sorted(brute(spark, rows), key=repr)
    assert len(searches) == 1


def test_lines_around_and_above_64_parity_bits(spark):
    rng = random.Random(5)
    rows = []
    for g, n in enumerate([56, 59, 61, 66, 150, 400]):
        base = [f"g{g}w{i}" for i in range(n)]
        for i in range(12):
            own = rng.sample(base, n - rng.randint(0, n // 6)) + [f"g{g}own{i}x{j}" for j in range(rng.randint(0, n // 8))]
            rows.append((rng.randrange(10_000), " ".join(own)))
    assert run(spark, rows) == sorted(brute(spark, rows), key=repr)
