"""Corpus pipeline over the documents table, from five training-data operators.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run`
writes it as Parquet into the shared folder and reads it again for the next
stage, so a lost executor never repeats an earlier stage.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm import line_dedup, mixing, sentencepiece_codec, simhash, toxicity
from tripstar.llm.common import doc_remainder, table, word_count
from tripstar.llm.training import labelled_sample
from tripstar.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network scores below one half."""
    allowed = doc_remainder(F.col("doc_id"), 5) != 0
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", toxicity.SAMPLE, allowed)
    model = toxicity.fit_toxicity(sample)
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    return toxicity.score_toxicity(spark, rows, model, "_text").where(F.col("score") < 0.5).select("_row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches."""
    return line_dedup.dedup_lines(spark, docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.simhash_dedup(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their targets."""
    return mixing.mix(spark, docs, word_count(F.col("text")), mixing.letter_weight(F.col("text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, checked by decoding them."""
    coded = sentencepiece_codec.encode_documents(spark, docs.select("doc_id", "source", "text"))
    return coded.select("doc_id", "source", F.size("ids").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# The network, the fingerprints and the best paths are not expressible in SQL;
# tests/llm/test_corpus_pipeline.py compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    root = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
