"""Toxicity, language and quality: held-out accuracy, gradients and edge cases."""

import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_data import SF01, joined
from tripstar.llm import langid, quality_net, queries, toxicity, training

ODD = [None, "", " \n", "1234 !!", "x", "word " * 30_000, "é😀" * 50]


def odd(spark, texts=ODD):
    return spark.createDataFrame([(i, t, "old", 2.0) for i, t in enumerate(texts + texts[:2])], "doc_id int, text string, lang_pred string, score double")


# --- toxicity ---------------------------------------------------------------------
def test_gradients():
    """Backward pass against differences, in double precision."""
    source = open(toxicity.__file__).read().replace("np.float32", "np.float64")
    T = types.ModuleType("toxicity_double")
    exec(compile(source, "toxicity_double", "exec"), T.__dict__)
    p = {k: v.astype(np.float64) for k, v in T.new_params().items()}
    rng = np.random.default_rng(0)
    names = ["abc", "bad", "é", "worse", "x"]
    features = T.Features(names)
    ids, mask = rng.integers(0, 5, (3, T.WINDOW)), np.ones((3, T.WINDOW))
    mask[1, 7:] = 0
    y = np.array([0.0, 1.0, 1.0])

    def loss(q):
        x = features.inputs(q)
        run = T.Pass(q, x @ q["w"] + q["b"], ids, mask, keep=True)
        return np.mean(np.logaddexp(0, run.logits) - y * run.logits), run, x

    _, run, x = loss(p)
    grads, dproj = run.backward((training.sigmoid(run.logits) - y) / 3, len(names))
    grads["w"], grads["b"] = x.T @ dproj, dproj.sum(axis=1, keepdims=True)
    grads["words"], grads["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
    features.push(grads, (dproj @ p["w"].transpose(0, 2, 1)).sum(axis=0))
    for k in p:
        for i in rng.choice(np.flatnonzero(np.abs(grads[k]).ravel() > 1e-10), 3):
            up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
            up[k].ravel()[i] += 1e-5
            down[k].ravel()[i] -= 1e-5
            assert (loss(up)[0] - loss(down)[0]) / 2e-5 == pytest.approx(grads[k].ravel()[i], rel=1e-3, abs=1e-8)


def test_windows_cover_every_token():
    for n in [1, 11, 12, 13, 24, 25, 36, 37, 100]:
        seen = set()
        for s in toxicity.window_starts(n):
            assert s == 0 or s + toxicity.WINDOW - toxicity.STRIDE < n
            seen.update(range(s, min(n, s + toxicity.WINDOW)))
        assert seen == set(range(n))


def toxic_texts(n, seed=1):
    rng = np.random.default_rng(seed)
    plain = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    texts, labels = [], []
    for k in range(n):
        words = list(rng.choice(plain, rng.integers(20, 160)))
        if k % 3 == 0:
            for at in rng.integers(0, len(words), 3):
                words[at] = str(rng.choice(["vileone", "nastyone", "vileness"]))
        texts.append(" ".join(words))
        labels.append(float(k % 3 == 0))
    return texts, np.array(labels)


def test_toxicity_learns_and_table_size_does_not_matter(spark):
    texts, labels = toxic_texts(400)
    model = toxicity.train(texts, labels)
    more, target = toxic_texts(200, 2)
    wide = model.probability(toxicity.Scorer(model).texts(more))
    tight = model.probability(toxicity.Scorer(model, capacity=10).texts(more))
    assert ((wide >= 0.5) == target).mean() >= 0.97
    assert np.allclose(wide, tight, atol=1e-5)
    late = ("worda " * 5000) + more[0]  # a toxic passage far behind the start
    rows = toxicity.score_toxicity(spark, odd(spark, [*ODD, late]), model).collect()
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert all(0 <= s <= 1 for s in by_id.values())
    assert by_id[0] == by_id[1] == by_id[2] == by_id[3] and by_id[len(ODD)] >= 0.5
    assert toxicity.score_toxicity(spark, odd(spark).where("false"), model).count() == 0


def test_toxicity_without_labels(spark):
    for texts, labels in (([], np.empty(0)), (["a", "b"], np.zeros(2))):
        model = toxicity.train(texts, labels)
        scores = [r["score"] for r in toxicity.score_toxicity(spark, odd(spark), model).collect()]
        assert len(set(scores)) == 1 and scores[0] < 0.5


def test_toxicity_held_out(spark):
    got = joined(spark, queries.op8_toxicity(spark, SF01)).where("held_out and toxic is not null")
    rows = got.select("predicted", "toxic").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.9 * len(rows) > 0


# --- language ---------------------------------------------------------------------
def test_language_held_out(spark):
    got = joined(spark, queries.op9_language_id(spark, SF01)).where("held_out")
    rows = got.select("lang_pred", "lang", "rejected").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows) > 0
    sure = [r for r in rows if not r["rejected"]]
    assert sum(r["lang_pred"] == r["lang"] for r in sure) >= 0.99 * len(sure) > 0.8 * len(rows)


def test_language_edge_cases(spark):
    train = spark.createDataFrame([("en", "the cat and the dog " * 20), ("de", "der Hund und die Katze " * 20), (None, "x"), ("fr", None)], "lang string, text string")
    known = langid.train_dictionaries(train)
    assert list(known) == ["de", "en"]
    rows = langid.identify(spark, odd(spark, [*ODD, "the dog and the cat", "DIE KATZE UND DER HUND"]), known).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows[:4]] == ["und"] * 4 and all(r["rejected"] for r in rows[:4])
    assert rows[7]["lang_pred"] == "en" and rows[8]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in langid.identify(spark, odd(spark), {}).collect()} == {"und"}
    assert langid.train_dictionaries(train.where("false")) == {}


# --- quality ----------------------------------------------------------------------
def test_quality_held_out(spark):
    got = joined(spark, queries.op10_quality_classifier(spark, SF01)).where("held_out and quality is not null")
    rows = got.select("predicted", "quality").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.93 * len(rows) > 0


def test_contexts_match_a_plain_loop():
    docs = [[3, 5, 3, 9], [7], [], [5, 5]]
    positions, signs = quality_net.index_vectors()
    table = np.zeros(quality_net.BUCKETS * quality_net.DIM, dtype=np.int64)
    quality_net.add_contexts(table, docs, positions, signs)
    plain = np.zeros((quality_net.BUCKETS, quality_net.DIM), dtype=np.int64)
    for d in docs:
        for i, a in enumerate(d):
            for j in range(max(0, i - quality_net.REACH), min(len(d), i + quality_net.REACH + 1)):
                if i != j:
                    for at, sign in zip(positions[d[j]], signs[d[j]], strict=True):
                        plain[a, at] += sign
    assert (table.reshape(plain.shape) == plain).all()


def test_quality_edge_cases(spark):
    docs = odd(spark)
    vectors = quality_net.word_vectors(spark, docs)
    nothing = docs.where("false").select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.lit(1.0).alias("label"))
    network = quality_net.fit_quality(nothing, vectors)
    rows = quality_net.score_quality(spark, docs, vectors, network).collect()
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == len(ODD) + 2
    assert not quality_net.word_vectors(spark, docs.where("false")).any()


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic")).unionByName(
        spark.createDataFrame([(None, 1), (3, None), (5, 1)], "doc_id long, toxic int"))
    picks = [sorted(r["_id"] for r in training.labelled_sample(docs, labels, "toxic", 300, F.lit(True)).collect()) for _ in range(2)]
    assert picks[0] == picks[1] and 220 < len(picks[0]) < 380 and len(set(picks[0])) == len(picks[0])
