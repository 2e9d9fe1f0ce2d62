"""Registered queries of the operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripstar.llm import (
    embedding_dedup,
    importance,
    langid,
    line_dedup,
    mixing,
    periodic_runs,
    pii,
    quality_net,
    quality_rules,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    toxicity,
)
from tripstar.llm.common import cut_lineage, doc_remainder, table, word_count
from tripstar.llm.training import labelled_sample


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = mixing.mix_rows(docs, word_count(F.col("text")), mixing.letter_weight(F.col("text"))).drop("text")
    rows = cut_lineage(spark, rows)
    taken = mixing.mix_apply(rows, mixing.mix_plan(spark, rows))
    return taken.select(
        "doc_id",
        F.col("_mix_size").alias("size"),
        F.col("_mix_total").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"),
        F.col("_mix_copies").alias("copies"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_chars")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit_trees(spark, docs))

    def count(kind: int):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
        F.sha2(pii.listing(F.col("base")), 256).alias("base_sha256"), pii.listing(F.col("spans")).alias("spans"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_groups(spark, docs).select(
        F.col("_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode_documents(spark, docs)
    return coded.select("doc_id", F.size("ids").alias("n_ids"), "n_byte_ids", F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.dedup_lines(spark, docs)
    return cleaned.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_removed").cast("long").alias("n_removed"),
                          F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(doc_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", toxicity.SAMPLE, ~held_out)
    scored = toxicity.score_toxicity(spark, docs, toxicity.fit_toxicity(sample))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(doc_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    known = langid.train_dictionaries(docs.where(~held_out))
    scored = langid.identify(spark, docs.drop("lang"), known)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(doc_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    vectors = quality_net.word_vectors(spark, docs)
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", quality_net.SAMPLE, ~held_out)
    network = quality_net.fit_quality(sample, vectors)
    scored = quality_net.score_quality(spark, docs, vectors, network)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, n, h = F.col("text"), word_count(F.col("text")), F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(h / 10)
    first = g % n
    planted = F.when((h % 10 == 0) & (n > 0), periodic_runs.repeat_from(text, first, 1 + F.floor((n - first) / (3 + g % 8))))
    docs = table(spark, sf_dir, "documents").select("doc_id", planted.otherwise(text).alias("text"))
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda most, r: F.when(
        most.isNull() | (r["length"] * most["period"] > most["length"] * r["period"]), r).otherwise(most))
    listing = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))))
    found = periodic_runs.detect_runs(docs, F.col("text"), keep=["doc_id"]).withColumn("best", best)
    return found.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    per_text = suffix_dedup.cut_texts(spark, docs).select(
        "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"),
        (F.octet_length("text") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return suffix_dedup.for_rows(docs, per_text).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranked = importance.resample(spark, docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return ranked.select("row.doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_quality_rules": op2_quality_rules,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_personal_data": op4_personal_data,
        "op5_simhash": op5_simhash,
        "op6_line_dedup": op6_line_dedup,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_toxicity": op8_toxicity,
        "op9_language_id": op9_language_id,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_importance_resampling": op13_importance_resampling,
        "pipeline": corpus_pipeline.run,
    }
