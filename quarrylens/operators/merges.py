"""Set operations and ordering where the last or first of several rows counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(parts: list[DataFrame], key: str) -> DataFrame:
    """Rows of all parts; of those with one key the one from the last part stays (of one part, any one)."""
    columns = [c for c in parts[0].columns if c != key]
    rows = None
    for number, part in enumerate(parts):
        part = part.select(key, *columns).withColumn("part_ord", F.lit(number))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), "part_ord").alias("x")).select(key, "x.*")


def ordered_union(a: Column, b: Column) -> Column:
    return F.array_distinct(F.concat(a, b))


def merged_status(responses: DataFrame) -> DataFrame:
    """One row, ``status, message, n_files``: the last status that isn't a success, or success; ``n_files`` counts responses with files.

    ``responses`` has ``answer_ord, status, message, n_files``."""
    failed = F.when(F.coalesce("status", F.lit("SUCCESS")) != "SUCCESS", F.col("answer_ord"))
    last = responses.agg(F.max_by(F.struct("status", "message"), failed).alias("x"), F.count_if(F.col("n_files") > 0).alias("n_files"))
    return last.select(F.coalesce("x.status", F.lit("SUCCESS")).alias("status"), F.when(F.col("x").isNull(), "Success").otherwise(F.col("x.message")).alias("message"), "n_files")


def violation_rank(kind: Column) -> Column:
    """Security first, then licences, then all others."""
    return F.when(kind == "SECURITY", 3).when(kind == "LICENSE", 2).otherwise(1)


def violations_sorted(rows: DataFrame) -> DataFrame:
    return rows.orderBy(violation_rank(F.col("type")).desc(), "place")
