"""Corpus pipeline: language ID, quality rules, one document of each near-duplicate group, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowquarry.llm import jaccard, langid, packing, quality
from flowquarry.llm.common import shared_folder
from flowquarry.llm.queries import PIECE_MODEL, WORD_MODEL, vocabulary_path

#: Documents whose language is less certain than this go, as do those without a letter.
MIN_LANGUAGE_SCORE = 0.5
#: Near-duplicates share this many percent of their shingles of so many words.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the model learns from what the stage is given."""
    verdict = langid.predict(docs, langid.train(docs, vocabulary_path(PIECE_MODEL)), carry=True)
    return verdict.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(docs, quality.train(docs, labels), carry=True).where("kept").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return jaccard.first_of_groups(docs, NEAR_PERCENT, NEAR_WORDS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack_documents(docs, vocabulary_path(WORD_MODEL), lasting=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("packing", packing_stage),
]

#: Neither the trained stages nor the tokenizer can be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    folder, docs = shared_folder(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
