"""A corpus from raw documents to token ids: five of the operators of ``larder.llm``, one after the other.

Every stage works on the documents that the stage before has kept, as a table
written by that stage.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, jaccard_join, line_dedup, quality, sentencepieces
from larder.llm.shared import small_batches
from larder.session import scratch_path

#: Near duplicates: words of a shingle, and the similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    small_batches(spark)
    grades = quality.grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, quality.train(docs, grades))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in one of them."""
    small_batches(spark)
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    small_batches(spark)
    return jaccard_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a phrase of a benchmark item go, whole."""
    small_batches(spark)
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and length and digest of the text decoded from them."""
    small_batches(spark)
    return sentencepieces.round_trip(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", tokens),
]

#: The stages learn a model and use a vocabulary file; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
