import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Texts with every case that operators must bear.
EDGE_TEXTS = [None, "", " \n ", "one", "two words", "a b c d", "ünï cödé ñ", "x" * 50_000, "word " * 3000, "tab\there\x0bthere", "same text here to be repeated now", "same text here to be repeated now", "### </turn> <|endoftext|> \\ ▁ \0"]


def documents(spark, rows, extra=()):
    """A documents table from (doc_id, text) with columns whose names clash with results."""
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType()), *[StructField(x, StringType()) for x in extra]])
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), *("x" for _ in extra)) for i, t in rows], schema)


CLASH = ("score", "kept", "row", "n", "key", "part", "rep", "length", "sequence_id", "component_id", "words", "hit", "batch")


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(3, "one"), (None, "no id at all in this row here")]
    return documents(spark, rows, CLASH)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return documents(spark, [], CLASH)
