"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.session import checkpoint_folder, checkpointed

__all__ = ["BLANKS", "checkpoint_folder", "checkpointed", "documents", "forget", "free_name", "looked_up", "scratch_folder", "shuffle_partitions", "text_of", "written"]

#: Java regular expression of a run of the six ASCII white-space bytes.
BLANKS = r"[\x20\x09-\x0D]+"


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with null texts as empty ones; other columns are left out."""
    return df.select(df[id_col].cast("long").alias("doc_id"), text_of(df, text_col).alias("text"))


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that does not clash with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def looked_up(rows: DataFrame, found: DataFrame, keys: list[str], salts: int = 8, how: str = "left") -> DataFrame:
    """``rows`` joined with ``found`` (at most one row per key), with the rows of a key dealt to
    ``salts`` tasks: a key may hold a large part of ``rows``."""
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    rest = [c for c in rows.columns if c not in keys]
    dealt = rows.withColumn("lookup_salt", F.pmod(F.xxhash64(*rest) if rest else F.lit(0), F.lit(salts)).cast("int"))
    return dealt.join(found.withColumn("lookup_salt", spread), [*keys, "lookup_salt"], how).drop("lookup_salt")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a Parquet table to the shared folder and read again: lineage ends there, and columns can be read alone."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`written` made and that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
