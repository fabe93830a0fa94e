"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard, langid, licenses, maintext, packing, pieces, quality, shards, vectors
from .common import shared_folder, table

#: Vocabulary files, by the names of the public tokenizer collection; a parameter of each operator.
PIECE_MODEL, WORD_MODEL = "piece_bpe_32k.model", "word_bpe_49k.json"


def vocabulary_path(name: str) -> str:
    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs, vocabulary_path(PIECE_MODEL)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(WORD_MODEL))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(PIECE_MODEL))


#: Batches in which op4 lets the documents arrive.
ARRIVALS = 8


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that arrive in batches, appended and compacted, as the last version has them."""
    docs = table(spark, sf_dir, "documents")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS))
    store = shards.shard_arrivals(docs, batch, ARRIVALS, shared_folder(spark))
    return store.read().select("doc_id", "lang", "source", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract_pages(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like marks."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), tricky.alias("text"))
    return chat.read_back(chat.format_examples(turns.unionByName(added)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


_TRICKY = r"SELECT -7 AS conv_id, turn, role, '\### Assistant: </turn> ok' AS text FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_sharding": op4_sharding,
    "op5_license_scans": op5_license_scans,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_extraction": op7_html_extraction,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_embedding_dedup": op10_embedding_dedup,
}

ORACLES: dict[str, str] = {
    "op9_chat_formatting": chat.ORACLE.format(turns=f"(SELECT conv_id, turn, role, text FROM conversations UNION ALL {_TRICKY})"),
    "op10_embedding_dedup": vectors.ORACLE,
    "op4_sharding": "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents",
    "op5_license_scans": licenses.oracle(),
}
