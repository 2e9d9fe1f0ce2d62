"""The corpus pipeline against a brute-force version of its stages."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from test_line_dedup import brute as brute_lines
from test_mixing import brute as brute_mix
from test_simhash import roots, slow_fingerprint
from tripstar.llm import sentencepiece_codec, toxicity
from tripstar.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def fixture(tmp_path, spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "se", "to") for b in ("ba", "do", "fe", "gi", "hu", "na")]
    rows, labels = [], []
    for i in range(240):
        lines = [" ".join(rng.choices(words, k=rng.randint(8, 30))) for _ in range(rng.randint(1, 4))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                at = rng.randrange(len(lines))
                lines[at] = f"vileword {lines[at]} nastyword"
        rows.append((i, "\n".join(lines), "en", rng.choice(["a", "b", None]), 1))
        labels.append((i, 1, int(toxic)))
    clean = [r for r in rows if r[0] % 4]
    rows += [(1000 + k, r[1], "en", "a", 1) for k, r in enumerate(clean[:10])]
    rows += [(1100 + k, r[1] + " " + " ".join(rng.choices(words, k=2)), "en", "b", 1) for k, r in enumerate(clean[10:25])]
    rows += [(1200, None, None, None, None), (1201, "", "en", "a", 0), (1202, clean[3][1].split("\n")[0], "en", "c", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows


def test_stages_match_brute_force(spark, tmp_path):
    rows = fixture(tmp_path, spark)
    by_id = {r[0]: r for r in rows}
    docs = table(spark, str(tmp_path), "documents")

    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert kept.columns == COLUMNS
    stay = {r["doc_id"] for r in kept.collect()}
    clean = {i for i in by_id if i >= 1000 or i % 4}
    assert len(clean - stay) <= 4 and len(stay - clean) <= 4
    model = toxicity.fit_toxicity(corpus_pipeline.labelled_sample(
        docs, table(spark, str(tmp_path), "labels"), "toxic", toxicity.SAMPLE, corpus_pipeline.doc_remainder(F.col("doc_id"), 5) != 0))
    scores = model.probability(toxicity.Scorer(model).texts([r[1] for r in rows]))
    assert stay == {r[0] for r, s in zip(rows, scores, strict=True) if s < 0.5}

    expected = dict(brute_lines(spark, [(i, by_id[i][1]) for i in sorted(stay)]))
    points = {i: slow_fingerprint(t) for i, t in expected.items()}
    root = roots(sorted(set(points.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    groups = {}
    for i, p in points.items():
        groups.setdefault(root[p], []).append(i)
    survivors = sorted(min(g) for g in groups.values())
    mixed = brute_mix([(i, by_id[i][3], expected[i]) for i in survivors])
    codec = sentencepiece_codec.Codec(sentencepiece_codec.Vocabulary.read(sentencepiece_codec.DEFAULT_MODEL))

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(i for i, *_, n in mixed for _ in range(n))
    for r in out:
        text = expected[r["doc_id"]]
        assert r["ids"] == (None if text is None else codec.encode(text))
        assert r["source"] == by_id[r["doc_id"]][3]
        assert text is None or (r["round_trip"] and codec.decode(r["ids"]) == text)


def test_stages_and_empty_documents(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_odd_columns(spark, tmp_path):
    fixture(tmp_path, spark)
    docs = table(spark, str(tmp_path), "documents").limit(40).withColumns(
        {"score": F.lit(9), "_row": F.lit("r"), "_fp": F.lit(1), "tok": F.lit("t"), "label": F.lit(0)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert {(r["score"], r["_row"], r["_fp"], r["tok"]) for r in out.collect()} == {(9, "r", 1, "t")}
