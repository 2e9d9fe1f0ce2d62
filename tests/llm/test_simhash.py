"""Fingerprints and groups against brute force."""

import random
import re

import numpy as np
import xxhash

from tripstar.llm import components, simhash


def slow_fingerprint(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(points, linked):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in points:
        for b in points:
            if a < b and linked(a, b):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {p: find(p) for p in points}


def test_fingerprint():
    rng = random.Random(1)
    words = ["The", "é", "QUICK", "fox x", "😀", "a", "ÀB"]
    for text in [None, "", "\n \t", "One", "One Two", "x\x1cy z"] + [
            "".join(rng.choice(words) + rng.choice([" ", "\n", "\x0b\t"]) for _ in range(rng.randint(1, 60))) for _ in range(40)]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def balls(seed, centers, per_ball, flips):
    rng = random.Random(seed)
    points = set()
    for _ in range(centers):
        c = rng.getrandbits(64)
        for _ in range(per_ball):
            x = c
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            points.add(x - (1 << 64) if x >> 63 else x)
    return sorted(points)


def check(spark, points, **kw):
    codes = spark.createDataFrame([(p,) for p in points], "fp long")
    links = simhash.near_links(spark, codes, 2, **kw)
    assert links.count() <= 65 * len(points)
    got = {r["node"]: r["component"] for r in components.connected_components(spark, links).collect()}
    expected = roots(points, lambda a, b: ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2)
    assert {p: got.get(p, p) for p in points} == expected


def test_groups_over_many_shards(spark):
    check(spark, balls(2, 150, 4, 3), shard_points=32)


def test_dense_ball(spark):
    points = balls(3, 1, 700, 5) + balls(4, 40, 2, 2)
    check(spark, sorted(set(points)), shard_points=64)
    check(spark, sorted(set(points)))


def test_one_and_no_point(spark):
    check(spark, [5])
    check(spark, [])


def test_local_search_of_an_unsplittable_ball():
    points = np.array([p & (2 ** 64 - 1) for p in balls(5, 1, 900, 4)], dtype=np.uint64)
    a, b = simhash.shard_links(points, 2)
    assert (np.bitwise_count(a ^ b) >= 1).all()


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(300))
    near = base + " tail"
    rows = [(5, base, "x"), (3, near, "y"), (9, None, "z"), (8, "", "q"), (7, "other text here", "r"), (7, "other text here", "r"), (None, base, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp string")
    got = simhash.simhash_groups(spark, docs).collect()
    assert len(got) == len(rows)
    linked = (simhash.fingerprint(base) ^ simhash.fingerprint(near)).bit_count() <= 2
    by_id = {r["_id"]: r["_component"] for r in got}
    assert by_id[9] == by_id[8] == 8 and by_id[5] == (3 if linked else 5) and by_id[None] == by_id[5]
    kept = simhash.simhash_dedup(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == ([3, 7, 8] if linked else [3, 5, 7, 8])


def test_groups_of_null_ids_and_of_one_id_on_two_texts(spark):
    texts = [" ".join(f"{w}{i}" for i in range(40)) for w in ("red", "blue", "green", "grey")]
    prints = [simhash.fingerprint(t) for t in texts]
    assert all((a ^ b).bit_count() > 10 for i, a in enumerate(prints) for b in prints[:i])
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (9, texts[3]), (None, texts[2]), (4, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.simhash_dedup(spark, docs).collect()), key=str)
    assert kept == sorted([(None, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[3])], key=str)
    groups = {(r["_id"], r["_component"], r["_root"]) for r in simhash.simhash_groups(spark, docs).collect()}
    assert len({root for _, _, root in groups}) == 4


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(spark, docs).count() == 0
    assert simhash.simhash_dedup(spark, docs).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 200)]
    got = components.connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}
    assert len(got) == 101
