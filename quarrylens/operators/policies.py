"""Policies on scan results and their verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.columns import copyleft
from quarrylens.functions.fixed_values import COPYLEFT_SOURCES
from quarrylens.operators.rollups import component_licenses, components

PASSED, FAILED, ERROR = 0, 2, 1


def copyleft_components(rows: DataFrame, listed: DataFrame, sources: list[str] = COPYLEFT_SOURCES, **lists) -> DataFrame:
    """``purl, version, spdxid, source`` of the copyleft licences of components; ``rows`` of matches and dependencies."""
    licenses = component_licenses(rows, list(sources)).join(listed, F.lower("spdxid") == F.col("license_key"), "left")
    bad = licenses.filter(copyleft(F.col("spdxid"), F.col("listed_copyleft"), **lists))
    return bad.select("key", "purl", "spdxid", "source").join(rows.select("key", "version").distinct(), "key").select("purl", "version", "spdxid", "source")


def undeclared_components(rows: DataFrame) -> DataFrame:
    """``purl, version`` of components that are pending; ``rows`` of matches alone."""
    return components(rows).filter("status = 'pending'").select("purl", "version")


def undeclared_settings(found: DataFrame) -> str:
    """The settings fragment that would declare the components: a list of purls for people, read one by one."""
    import json

    purls = [r.purl for r in found.select("purl").distinct().orderBy("purl").toLocalIterator()]
    return json.dumps({"bom": {"include": [{"purl": p} for p in purls]}}, indent=2)


def counts(**violations: DataFrame) -> DataFrame:
    """``policy, n_violations, exit_status`` of each policy."""
    out = None
    for name, found in violations.items():
        row = found.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("policy"), "n_violations", F.when(F.col("n_violations") > 0, FAILED).otherwise(PASSED).alias("exit_status"))
        out = row if out is None else out.unionByName(row)
    return out


def exit_status(violations: DataFrame) -> int:
    """Passed, failed, or an error where the violations can't be found (an unreadable result, a wrong form)."""
    from pyspark.errors import PySparkException

    try:
        return PASSED if violations.isEmpty() else FAILED
    except PySparkException:
        return ERROR
