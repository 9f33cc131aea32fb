import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of ``(doc_id, text)`` or ``(doc_id, text, lang)``."""

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] else None) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls in any column, empty and blank texts, ties, repeated rows, a long text."""
    long = " ".join(f"word{k % 977} thing{k % 1013}" for k in range(30_000))
    return docs_of([(1, None), (2, ""), (3, " \n\t "), (None, "a lonely text without any id, a few words long"), (4, "same text here"), (4, "same text here"), (5, "same text here", None), (6, long), (7, long + " end"), (None, None, None), (None, "same text here")])


@pytest.fixture(scope="session")
def clashing(docs_of):
    """Columns named like those that operators make."""
    docs = docs_of([(2, "one two three four five six seven"), (1, "one two three  four five six seven"), (3, None)])
    for name in ("hash", "norm", "row", "salt", "kept", "keep_id", "q_words", "q_text", "rep", "component", "version", "doc", "deal", "ids", "spans", "lookup_salt", "text_a", "group_size", "sketch"):
        docs = docs.withColumn(name, docs["source"])
    return docs


@pytest.fixture(scope="session")
def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
