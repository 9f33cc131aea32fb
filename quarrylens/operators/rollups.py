"""Components and licences of scan results.

Order matters in some rules, so rows carry their place (``file_ord, match_ord`` and the like) instead of
relying on an order of rows. All are hash aggregations with partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.columns import selected_licenses


def component_rows(matches: DataFrame) -> DataFrame:
    """Matches that count as components: ``key, purl, version, status, place, licenses``."""
    rows = matches.filter("id IS NOT NULL AND id NOT IN ('none', 'dependency') AND status IS NOT NULL AND size(purl) > 0")
    version = F.when(F.coalesce("version", F.lit("")) == "", "unknown").otherwise(F.col("version"))
    rows = rows.withColumn("purl", F.element_at("purl", 1)).withColumn("version", version)
    return rows.select(F.concat_ws("@", "purl", "version").alias("key"), "purl", "version", "status", F.struct("file_ord", "match_ord").alias("place"), "licenses")


def dependency_rows(deps: DataFrame) -> DataFrame:
    """The same of dependencies, which have no status; a missing version is an empty one."""
    version = F.coalesce("version", F.lit(""))
    licenses = F.when(F.col("license").isNull(), F.array().cast("array<struct<name:string,source:string>>")).otherwise(F.array(F.struct(F.col("license").alias("name"), F.lit(None).cast("string").alias("source"))))
    return deps.filter("purl IS NOT NULL").select(F.concat_ws("@", "purl", version).alias("key"), "purl", version.alias("version"), F.lit(None).cast("string").alias("status"), F.struct("file_ord", F.col("dep_ord").alias("match_ord")).alias("place"), licenses.alias("licenses"))


def components(rows: DataFrame) -> DataFrame:
    """``key, purl, version, status, n, declared, undeclared, place``.

    The first row of a key is declared if identified and undeclared if pending; later ones are declared
    if identified and undeclared otherwise. The status is the first row's, or pending if a later row is.
    Written without a window, so that hot components are pre-aggregated: the first row is a minimum, and the
    others are all rows less the first."""
    first = F.min(F.struct("place", "status"))
    grouped = rows.groupBy("key", "purl", "version").agg(
        first.alias("first"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "identified").alias("identified"), F.count_if(F.col("status") == "pending").alias("pending")
    )
    status = F.col("first.status")
    was_pending, was_identified = (F.coalesce(status == s, F.lit(False)) for s in ("pending", "identified"))
    other = F.col("n") - F.col("identified") - F.when(was_pending | was_identified, 0).otherwise(1)
    later_pending = F.col("pending") - F.when(was_pending, 1).otherwise(0) > 0
    return grouped.select("key", "purl", "version", F.when(later_pending, "pending").otherwise(status).alias("status"), "n", F.col("identified").alias("declared"), other.alias("undeclared"), F.col("first.place").alias("place"))


def component_licenses(rows: DataFrame, sources: list[str] = ()) -> DataFrame:
    """``key, purl, spdxid, source, n``: licences of a component, with the first source and the count.

    Which of a match's licences count is a matter of each match (:func:`~quarrylens.functions.columns.selected_licenses`)."""
    chosen = rows.select("key", "purl", "place", F.posexplode(selected_licenses(F.col("licenses"), sources)).alias("lic_ord", "license"))
    chosen = chosen.filter("license.name IS NOT NULL")
    return chosen.groupBy("key", "purl", F.col("license.name").alias("spdxid")).agg(F.min(F.struct("place", "lic_ord", F.coalesce("license.source", F.lit("unknown")).alias("source"))).getField("source").alias("source"), F.count(F.lit(1)).alias("n"))


def purl_licenses(found: DataFrame, licenses: DataFrame) -> DataFrame:
    """``purl, spdxid, status``: one row per purl and licence ('unknown' without any); the status of the last component counts."""
    joined = found.join(licenses.select("key", "spdxid"), "key", "left").withColumn("spdxid", F.coalesce("spdxid", F.lit("unknown")))
    return joined.groupBy("purl", "spdxid").agg(F.max(F.struct("place", "key", "status")).getField("status").alias("status"))


def component_summary(found: DataFrame, licenses: DataFrame) -> DataFrame:
    """One row: totals of (purl, licence) rows by status, and of files."""
    rows = purl_licenses(found, licenses).agg(F.count(F.lit(1)).alias("total_components"), F.count_if(F.col("status") == "pending").alias("undeclared_components"))
    files = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_files"), F.coalesce(F.sum("undeclared"), F.lit(0)).alias("undeclared_files"), F.coalesce(F.sum("declared"), F.lit(0)).alias("declared_files"))
    return rows.crossJoin(F.broadcast(files)).withColumn("declared_components", F.col("total_components") - F.col("undeclared_components"))  # two tables of one row


def license_summary(purls: DataFrame, copyleft_rows: DataFrame) -> DataFrame:
    """``spdxid, n_components, is_copyleft``"""
    known = purls.filter("spdxid <> 'unknown'").groupBy("spdxid").agg(F.count(F.lit(1)).alias("n_components"))
    return known.join(copyleft_rows, F.lower("spdxid") == F.col("license_key"), "left").select("spdxid", "n_components", F.coalesce("listed_copyleft", F.lit(False)).alias("is_copyleft"))


def file_types(files: DataFrame, suffix) -> DataFrame:
    """``extension, n_files, size_mb`` of files that aren't empty."""
    named = files.filter("size > 0").withColumn("extension", F.when(suffix == "", "no_suffix").otherwise(suffix))
    return named.groupBy("extension").agg(F.count(F.lit(1)).alias("n_files"), F.format_number(F.sum("size") / 1048576, 2).alias("size_mb"))


def file_type_lines(types: DataFrame) -> DataFrame:
    """``line``: the rows of :func:`file_types` as CSV; a size with a comma is quoted."""
    return types.select(F.to_csv(F.struct("extension", "n_files", "size_mb")).alias("line"))


def wfp_file_counts(blocks: DataFrame) -> DataFrame:
    """``n_files``: files in fingerprint texts, by their lines with ``file=``."""
    lines = F.size(F.filter(F.split("wfp", "\n"), lambda x: x.contains("file=")))
    return blocks.agg(F.coalesce(F.sum(lines), F.lit(0)).alias("n_files"))
