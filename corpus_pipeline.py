"""Corpus pipeline: documents are judged, made unique, cleaned of personal data and packed.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
again as the ``docs`` of the next. All but the last return the columns of ``docs``, whatever these are:

* ``quality``      documents that the quality rules reject go; the others stay as they are
* ``exact_dedup``  of equal texts the row with the smallest id stays
* ``near_dedup``   of each group of near duplicates the document with the smallest id stays
* ``pii``          personal data in the text is replaced by its kind; ``n_chars`` is counted anew
* ``packing``      the pieces of all documents and where they lie in sequences of 1024 tokens

Empty tables pass through all stages; nulls, ties and repeated rows are treated as the operators say.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from quarrylens.llm import exact_dedup, near_dedup, packing, pii, quality_rules
from quarrylens.llm.common import checkpoint_folder

#: Clusters by near duplicates and the packing of groups can't be expressed in SQL; the tests hold the
#: stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All of ``docs`` are judged, by references fitted on the labelled documents of ``sf_dir``; by general ones where it has no such tables."""
    try:
        documents, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return quality_rules.keep_good(docs)
    return quality_rules.keep_good(docs, references=quality_rules.fitted(documents, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digests(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("pii", private), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``.

    The tables between stages are written to ``folder``, by default a new one in the checkpoint folder that
    the executors share."""
    folder = folder or f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
