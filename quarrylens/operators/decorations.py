"""Answers of remote services as tables: results are joined with a table that the caller supplies.

The services themselves (vulnerabilities, dependencies, cryptography, provenance, licences, static analysis,
catalogue) are remote and no part of this package.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.columns import purl_base


def decorated(requests: DataFrame, answers: DataFrame, on: str = "purl") -> DataFrame:
    """Requests with the columns of their answers (null without one); an answer holds for all versions of its purl."""
    keyed = answers.withColumn("answer_key", purl_base(F.col(on))).drop(on)
    return requests.join(keyed, purl_base(requests[on]) == F.col("answer_key"), "left").drop("answer_key")


def in_range(version: Column, requirement: Column) -> Column:
    """Whether a dotted version fulfils requirements such as ``>=1.0,<2``; parts are compared as numbers."""
    key = lambda v: F.transform(F.regexp_extract_all(v, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("int"))
    clauses = F.filter(F.split(F.coalesce(requirement, F.lit("")), ","), lambda x: F.trim(x) != "")

    def holds(clause: Column) -> Column:
        sign, bound = F.regexp_extract(F.trim(clause), r"^([<>=!^~]*)", 1), key(clause)
        have = key(version)
        return (
            F.when(sign == ">=", have >= bound).when(sign == ">", have > bound).when(sign == "<=", have <= bound).when(sign == "<", have < bound).when(sign == "!=", have != bound).otherwise(have == bound)
        )

    return F.forall(clauses, holds)


def component_search(catalogue: DataFrame, text: str | None = None, vendor: str | None = None, component: str | None = None, package: str | None = None, limit: int = 0, offset: int = 0) -> DataFrame:
    """Components of a supplied catalogue that match all given words, in order of purl; limit and offset if over 0."""
    found = catalogue
    for column, value in (("vendor", vendor), ("component", component), ("package", package)):
        if value:
            found = found.filter(F.lower(column) == value.lower())
    if text:
        found = found.filter(F.lower("component").contains(text.lower()) | F.lower("purl").contains(text.lower()))
    found = found.orderBy("purl")
    found = found.offset(offset) if offset > 0 else found
    return found.limit(limit) if limit > 0 else found


def component_versions(catalogue: DataFrame, purl: str, limit: int = 0) -> DataFrame:
    found = catalogue.filter(F.col("purl") == purl).orderBy(F.col("version").desc())
    return found.limit(limit) if limit > 0 else found
