"""Dependency inventories: both formats of the inventory tool, requirements, scopes and path patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.columns import clean_purl, clean_requirement
from quarrylens.functions.fixed_values import DEV_SCOPES
from quarrylens.operators.gitignore import ignored

_DEPENDENCY = "struct<purl:string,requirement:string,extracted_requirement:string,scope:string>"
INVENTORY = f"files array<struct<path:string,type:string,packages:array<struct<dependencies:array<{_DEPENDENCY}>>>,package_data:array<struct<dependencies:array<{_DEPENDENCY}>>>>>"


def flattened(inventory: DataFrame) -> DataFrame:
    """``file, dep_ord, purl, requirement, scope`` of an inventory document (schema ``INVENTORY``).

    An empty ``package_data`` falls back to ``packages``; only entries of type ``file`` count."""
    files = inventory.select(F.explode("files").alias("f")).filter("f.type = 'file'")
    data = F.col("f.package_data")
    packages = F.when(F.coalesce(F.size(data), F.lit(-1)) > 0, data).otherwise(F.col("f.packages"))
    rows = files.select(F.col("f.path").alias("file"), F.posexplode(packages).alias("package_ord", "package"))
    rows = rows.select("file", "package_ord", F.posexplode("package.dependencies").alias("item_ord", "d"))
    raw = F.coalesce(F.col("d.extracted_requirement"), F.col("d.requirement"))
    purl = clean_purl(F.col("d.purl"))
    return rows.filter("d.purl IS NOT NULL").select("file", F.struct("package_ord", "item_ord").alias("dep_ord"), purl.alias("purl"), clean_requirement(F.col("d.purl"), raw).alias("requirement"), F.when(F.col("d.scope") != "", F.col("d.scope")).alias("scope"))


def grouped(rows: DataFrame) -> DataFrame:
    """``file, purls`` with the dependencies of a file in order."""
    items = F.sort_array(F.collect_list(F.struct("dep_ord", "purl", "requirement", "scope")))
    return rows.groupBy("file").agg(F.transform(items, lambda x: F.struct(x["purl"].alias("purl"), x["requirement"].alias("requirement"), x["scope"].alias("scope"))).alias("purls"))


def without_scopes(files: DataFrame) -> DataFrame:
    return files.withColumn("purls", F.transform("purls", lambda p: p.dropFields("scope")))


def in_scope(rows: DataFrame, scope: str | None = None, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """Dependencies of the wanted scopes, without the scope column. ``prod`` keeps rows whose scope isn't one of
    development (none is production), ``dev`` the others; lists override it, and exclusion beats inclusion."""
    if scope not in (None, "prod", "dev"):
        raise ValueError(f"unknown scope {scope}")
    is_dev = F.coalesce(F.col("scope").isin(*DEV_SCOPES), F.lit(False))
    kept = F.lit(True)
    if include or exclude:
        if exclude:
            kept = ~F.coalesce(F.col("scope").isin(*exclude), F.lit(False))
        if include:
            kept = kept & F.coalesce(F.col("scope").isin(*include), F.lit(False))
    elif scope:
        kept = is_dev if scope == "dev" else ~is_dev
    return rows.filter(kept).drop("scope")


def outside_patterns(rows: DataFrame, patterns: list[str], path: str = "file") -> DataFrame:
    return rows.filter(~ignored(F.col(path), patterns))
