"""Exact duplicates: group by a 128-bit content hash, keep the smallest id, compare bytes.

Texts are equal when they are identical after every run of ASCII white space is replaced by one
space. All work is done by DataFrame operators.

1. Rows are grouped by (MD5 of the normalised text, normalised text). The grouping key holds the
   bytes themselves, so Spark compares them inside each hash group and two texts with one hash
   stay apart. Map-side aggregation turns the copies within a task into one row before the
   shuffle, so a text that fills a third of the table costs one row per task.
2. What is left of a text is its hash, its smallest id and its count; that table is checkpointed.
3. Rows are joined back by hash, without their text. Texts that make up more than one of ``HOT_GROUPS``
   parts of all copies are fewer than ``HOT_GROUPS``, whatever the size of the table: these are
   broadcast, and their rows, whose result is known then, are dealt to all tasks of the join that
   gives the others theirs. So no task of it gets a larger part than that of one text. Only if two
   different texts share a hash, their rows are joined by hash and bytes.

Defined results: a null text counts as empty; empty texts are equal to each other. A null id
is larger than every id, and stays only where all copies have a null id. Rows that repeat the
smallest id of a group all stay: they are one document. An empty table gives an empty table.
Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import BLANKS, checkpointed, text_of

#: Texts with more than one of so many parts of all copies are broadcast; there are fewer of them.
HOT_GROUPS = 1000


def normalised(df: DataFrame, text_col: str = "text") -> Column:
    return F.regexp_replace(text_of(df, text_col), BLANKS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, hot_groups: int = HOT_GROUPS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256`` and, in a
    struct ``row``, the columns named in ``carry`` (none by default)."""
    norm = normalised(docs, text_col)
    keyed = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        norm.alias("norm"),
        F.struct(*[docs[c] for c in carry]).alias("row") if carry else F.lit(None).cast("boolean").alias("row"),
    ).withColumn("hash", F.unhex(F.md5("norm")))
    texts = keyed.groupBy("hash", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = texts.groupBy("hash").agg(F.count(F.lit(1)).alias("n_texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    groups = checkpointed(groups.filter("group_size > 1"))

    copies = groups.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") * hot_groups > copies
    one = groups.filter("n_texts = 1")
    hot = one.filter(is_hot).select("hash", F.col("keep_id").alias("hot_keep"), F.col("group_size").alias("hot_size"))
    same = one.filter(~is_hot).select("hash", "keep_id", "group_size", F.lit(0).cast("long").alias("salt"))
    rows = keyed.select("doc_id", "row", "hash", F.sha2("norm", 256).alias("text_sha256"))
    mixed = groups.filter("n_texts > 1").select("hash")
    parts = []
    if not mixed.isEmpty():
        parts = [_by_bytes(keyed, texts, mixed).withColumns({"hot_keep": F.lit(None).cast("long"), "hot_size": F.lit(None).cast("long")})]
        rows = rows.join(mixed, "hash", "left_anti")
    # rows of hot texts meet no other row below, so they are dealt anywhere
    anywhere = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(1 << 30)) + 1
    rows = rows.join(F.broadcast(hot), "hash", "left").withColumn("salt", F.when(F.col("hot_size").isNull(), 0).otherwise(anywhere).cast("long"))
    parts.insert(0, rows.join(same, ["hash", "salt"], "left"))
    out = None
    for part in parts:
        keep = F.when(F.col("hot_size").isNotNull(), F.col("hot_keep")).when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
        part = part.select("row", "doc_id", keep.alias("keep_id"), F.coalesce("hot_size", "group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
        out = part if out is None else out.unionByName(part)
    out = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return out.select(*columns, "row") if carry else out.select(*columns)


def _by_bytes(keyed: DataFrame, texts: DataFrame, mixed: DataFrame) -> DataFrame:
    """Rows whose hash belongs to more than one text, joined by hash and bytes."""
    inside = keyed.join(mixed, "hash", "left_semi")
    return inside.join(texts.join(mixed, "hash", "left_semi"), ["hash", "norm"]).withColumn("text_sha256", F.sha2("norm", 256))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    return exact_dedup(docs, id_col, text_col, carry=docs.columns).filter("kept").select("row.*")
