"""Rules on bills of materials: the most specific rule of a match, and what it does.

A rule names a path prefix, a purl, or both. Instead of a nested loop over matches and rules, matches are
joined by equality: on their purls, and on all prefixes of their path. Either join is a hash join that Spark
broadcasts or shuffles by size, so neither side need be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.columns import purl_part, purl_url
from quarrylens.operators.filters import path_prefixes, under

def _named(rules: DataFrame) -> DataFrame:
    rows = rules.select("rule_ord", F.col("path").alias("rule_path"), F.col("purl").alias("rule_purl"), "replace_with", F.col("license").alias("rule_license"))
    return rows.withColumn("prefix", F.regexp_replace(F.coalesce("rule_path", F.lit("")), "/+$", "")).withColumn("has_purl", F.coalesce("rule_purl", F.lit("")) != "")


def best_rules(matches: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule of each match: both path and purl before purl before path, then the longer path, then the
    first listed. A rule with neither never matches. Columns of ``matches`` and ``rule_ord, replace_with, rule_license``."""
    named = _named(rules)
    keys = matches.select("file_ord", "match_ord", "path", "purl")
    by_purl = keys.withColumn("rule_purl", F.explode(F.array_distinct("purl"))).join(named.filter("has_purl"), "rule_purl").filter(under(F.col("path"), F.col("prefix")))
    by_path = keys.withColumn("prefix", F.explode(path_prefixes(F.col("path")))).join(named.filter("NOT has_purl AND prefix <> ''"), "prefix")
    score = F.when(F.col("has_purl"), F.when(F.col("prefix") != "", 4).otherwise(2)).otherwise(1)
    columns = ["file_ord", "match_ord", F.struct((-score).alias("score"), (-F.length("prefix")).alias("length"), "rule_ord", "replace_with", "rule_license").alias("rule")]
    best = by_purl.select(*columns).unionByName(by_path.select(*columns)).groupBy("file_ord", "match_ord").agg(F.min("rule").alias("rule"))
    return matches.join(best.select("file_ord", "match_ord", "rule.rule_ord", "rule.replace_with", "rule.rule_license"), ["file_ord", "match_ord"])


def without_removed(matches: DataFrame, rules: DataFrame) -> DataFrame:
    """All matches of files whose first match no removal rule fits."""
    hit = best_rules(matches.filter("match_ord = 0"), rules).select("file_ord")
    return matches.join(hit, "file_ord", "left_anti")


def component_map(matches: DataFrame) -> DataFrame:
    """``map_purl`` and the component fields of its last file, from first matches as they were before any rule."""
    first = matches.filter("match_ord = 0").withColumn("map_purl", F.explode("purl"))
    fields = F.struct("component", "version", "latest", "url")
    return first.groupBy("map_purl").agg(F.max_by(fields, "file_ord").alias("entry"))


def replaced(matches: DataFrame, rules: DataFrame, known: DataFrame) -> DataFrame:
    """First matches that a replacement rule fits, with the new purl and the fields of the known component, or
    fields derived from the purl; ``status`` becomes identified. Values of ``known`` are those before any replacement.
    A target that is no purl changes nothing."""
    hit = best_rules(matches.filter("match_ord = 0"), rules)
    target = F.col("replace_with")
    hit = hit.withColumn("map_purl", target).join(known, "map_purl", "left")
    new = target.rlike("^pkg:[^/]+/.+")
    pick = lambda field, other: F.when(new, F.coalesce(F.col("entry")[field], other)).otherwise(F.col(field))
    return hit.select(
        "file_ord", "path", F.when(new, target).otherwise(F.element_at("purl", 1)).alias("new_purl"),
        pick("component", purl_part(target, "name")).alias("component"), pick("version", F.lit("")).alias("version"), pick("url", purl_url(target)).alias("url"),
        F.when(new, "identified").otherwise(F.col("status")).alias("status"), F.when(new, F.col("rule_license")).alias("license_override"),
    )


def sbom_contexts(paths: DataFrame, include: DataFrame, replace: DataFrame, exclude: DataFrame) -> DataFrame:
    """``file_ord, path, purls, scan_type``: purls that go along with a file's scan.

    Include rules whose prefix holds, and targets of replacements, give ``identify``; else exclude rules give
    ``blacklist``. A purl has its best score (2, or 4 with a path, plus the length of the path); purls come in
    falling score, then as listed, each once. With no rule at all the type is null.

    Rules without a path are the same list for every file: they are ranked once and appended as one array (a row no
    larger than what every file gets anyway); only rules with a path are joined, by the prefixes of the file's path."""

    def named(rules: DataFrame, purl: str, part: int) -> DataFrame:
        rows = _named(rules).withColumn("context_purl", F.col(purl)).filter("coalesce(context_purl, '') <> ''")
        return rows.select(F.lit(part).alias("part"), "context_purl", "rule_ord", "prefix")

    rules = named(include, "rule_purl", 0).unionByName(named(replace, "replace_with", 1)).unionByName(named(exclude, "rule_purl", 2))
    keys = paths.select("file_ord", "path")
    below = keys.withColumn("prefix", F.explode(path_prefixes(F.col("path")))).join(rules.filter("prefix <> ''"), "prefix")
    rank = F.struct((-4 - F.length("prefix")).alias("score"), "rule_ord").alias("rank")
    best = below.groupBy("file_ord", "part", "context_purl").agg(F.min(rank).alias("rank"))
    own = best.groupBy("file_ord").agg(F.collect_list(F.struct("part", "rank", "context_purl")).alias("own"))
    first = rules.filter("prefix = ''").groupBy("part", "context_purl").agg(F.min(F.struct(F.lit(-2).alias("score"), "rule_ord")).alias("rank"))
    everywhere = first.agg(F.collect_list(F.struct("part", "rank", "context_purl")).alias("shared"))
    joined = keys.join(own, "file_ord", "left").crossJoin(F.broadcast(everywhere))  # the other table has one row
    keyed = lambda xs: F.transform(xs, lambda x: F.struct(x["part"], x["context_purl"]))
    none = F.filter("shared", lambda x: F.lit(False))
    given = joined.withColumn("own", F.coalesce("own", none)).withColumn("known", keyed(F.col("own")))
    given = given.withColumn("found", F.sort_array(F.concat("own", F.filter("shared", lambda x: ~F.array_contains("known", F.struct(x["part"], x["context_purl"]))))))
    names = lambda keep: F.array_distinct(F.transform(F.filter("found", keep), lambda x: x["context_purl"]))
    identify, block = names(lambda x: x["part"] < 2), names(lambda x: x["part"] == 2)
    return given.select(
        "file_ord", "path", F.when(F.size(identify) > 0, identify).when(F.size(block) > 0, block).otherwise(F.array().cast("array<string>")).alias("purls"),
        F.when(F.size(identify) > 0, "identify").when(F.size(block) > 0, "blacklist").alias("scan_type"),
    )


def deepest_claims(files: DataFrame, path_ids: DataFrame) -> DataFrame:
    """``path, path_id``: each file goes to the deepest folder of ``path_ids`` above it (``.`` last)."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.when(n == 0, F.lit(".")).otherwise(F.array_join(F.slice(parts, 1, n), "/")))
    keyed = files.select("path", F.posexplode(above).alias("depth", "path_id"))
    return keyed.join(path_ids.select("path_id").distinct(), "path_id").groupBy("path").agg(F.max_by("path_id", "depth").alias("path_id"))
