"""Embedding near-duplicates against brute force, and recall of the index."""

import numpy as np

from tripstar.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, cid string"


def brute(rows, threshold=0.9):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            ok.setdefault(i, []).append(np.array(v, dtype=np.float32).astype(np.float64))
    items = [(i, v / np.linalg.norm(v)) for i, vs in ok.items() for v in vs]
    ids = np.array([i for i, _ in items])
    x = np.stack([v for _, v in items])
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = ids.copy()
    while True:
        low = np.minimum(label, np.where(near, label[None], label.max()).min(axis=1))
        if (low == label).all():
            break
        label = low
    return sorted((int(i), int(n), int(c)) for i, n, c in zip(ids, near.sum(1), label, strict=True))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    return E.near_duplicates(spark, df, **kw).collect()


def clusters(seed, n, dim, groups, noise):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(groups):
        rows = rng.choice(n, size=rng.integers(2, 9), replace=False)
        x[rows] = x[rows[0]] + noise * rng.normal(size=(len(rows), dim))
    return x.astype(np.float32)


def test_exact_on_clusters_copies_and_bad_vectors(spark):
    x = clusters(1, 500, 16, 40, 0.15)
    rows = [(i * 3, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000 + i, rows[7][1]) for i in range(120)]  # one large group of copies
    rows += [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] + [1.0] * 15),
             (9005, [float("inf")] * 16), (9006, [1.0, 2.0]), (None, rows[7][1])]
    got = run(spark, rows, reach=float(np.sqrt(0.2)))
    by_id = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows)
    expected = brute([r for r in rows if r[0] not in (9006, None)])
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None and r["vec_id"] < 9000) == expected
    for bad in range(9000, 9007):
        assert (by_id[bad]["n_links"], by_id[bad]["component_id"], by_id[bad]["kept"]) == (0, bad, True)
    assert (by_id[None]["n_links"], by_id[None]["kept"]) == (0, False)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)


def test_recall_at_the_default_reach(spark):
    x = clusters(2, 3000, 64, 300, 0.2)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r["vec_id"]: r["n_links"] for r in run(spark, rows)}
    expected = {i: n for i, n, _ in brute(rows)}
    assert all(got[i] <= expected[i] for i in expected)
    assert sum(got.values()) >= 0.99 * sum(expected.values()) > 0


def test_one_dense_ball_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "MEMBER_BLOCK", 100)
    monkeypatch.setattr(E, "QUERY_BLOCK", 150)
    rng = np.random.default_rng(3)
    x = (np.ones(8) + 0.1 * rng.normal(size=(600, 8))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(100)]
    got = run(spark, rows, reach=float(np.sqrt(0.2)))
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)


def test_tiny_and_empty(spark):
    assert run(spark, []) == []
    assert [tuple(r) for r in run(spark, [(4, None)])] == [(4, 0, 4, True)]
    got = sorted(tuple(r) for r in run(spark, [(2, [1.0, 0.0]), (1, [2.0, 0.0]), (3, [0.0, 1.0])]))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def anisotropic(seed, n, dim):
    """Pairs whose offset lies along the one direction in which the vectors differ most."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * 0.02
    x[:, 0] = 1
    x[:, 1] = rng.uniform(-1.5, 1.5, size=n)
    return x.astype(np.float32)


def test_default_reach_is_exact_for_offsets_along_one_direction(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(anisotropic(5, 2500, 64))]
    got = run(spark, rows)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)


def test_default_reach_is_exact_in_384_dimensions(spark):
    rng = np.random.default_rng(6)
    low = rng.normal(size=(1500, 6)) @ rng.normal(size=(6, 384))
    rows = [(i, v.tolist()) for i, v in enumerate((low + 0.1 * rng.normal(size=low.shape)).astype(np.float32))]
    got = run(spark, rows)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)
    assert sum(r["n_links"] for r in got) > 1500


def test_every_dimension_is_searched(spark):
    parts = [(0, 16, 700), (2000, 12, 400), (4000, 5, 3)]
    rows = {dim: [(first + i, v.tolist()) for i, v in enumerate(clusters(dim, n, dim, 40, 0.15) if n > 9 else np.ones((n, dim)) + np.eye(n, dim) / 9)]
            for first, dim, n in parts}
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in run(spark, [r for some in rows.values() for r in some]))
    assert got == sorted(x for some in rows.values() for x in brute(some))
    assert all(sum(n for i, n, _ in got if first <= i < first + 2000) > 0 for first, _, _ in parts)
