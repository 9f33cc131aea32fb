"""Version ranges: keys of versions that sort as versions do, bounds of requirements, and a join of requests with the versions in their range.

A version is cut into numbers and, after a dash, the identifiers of a pre-release: ``1.2.0-rc.10``. Its key is an array of texts that compare as versions do: numbers padded to one
width, zeros at the end left out, pre-releases before their release, numeric identifiers by number and before others, and what stands after a plus left out.

Requests of a package are not compared with each of its versions. Versions and bounds of a package, each once, are ranked together by key in one window; a request then asks for
an interval of ranks. Ranks are cut into buckets of ``BUCKET``, a request takes part in the buckets of its interval, and the join is by package and bucket. So what a join looks at is the
result and at most two buckets a request besides, and a package that a third of all requests ask for is spread over its buckets and versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH, BUCKET = 20, 64
#: What ends the numbers of a pre-release, and those of a release: both before any digit.
_PRE, _RELEASE = "-", "."


def version_key(version: Column) -> Column:
    """An array that sorts as the version does; null for a null version."""
    bare = F.regexp_replace(F.trim(version), r"^[vV=]+|\+.*$", "")
    numbers, pre = F.regexp_extract(bare, r"^([0-9.]*)", 1), F.regexp_extract(bare, r"^[0-9.]*[-_]?(.*)$", 1)
    padded = F.transform(F.filter(F.split(numbers, r"\."), lambda x: x != ""), lambda x: F.lpad(F.regexp_replace(x, "^0+(?=.)", ""), WIDTH, "0"))
    last = F.aggregate(F.transform(padded, lambda x, k: F.when(x != "0" * WIDTH, k + 1).otherwise(0)), F.lit(0), lambda a, k: F.greatest(a, k))
    identifiers = F.transform(F.filter(F.split(pre, r"[.\-_]"), lambda x: x != ""), lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("0"), F.lpad(F.regexp_replace(x, "^0+(?=.)", ""), WIDTH, "0"))).otherwise(F.concat(F.lit("1"), x)))
    return F.concat(F.slice(padded, 1, last), F.when(pre == "", F.array(F.lit(_RELEASE))).otherwise(F.concat(F.array(F.lit(_PRE)), identifiers)))


def _raised(version: Column, caret: bool) -> Column:
    """The first version beyond ``^version`` (the first number that isn't 0 goes up) or ``~version`` (the second one goes up, of a single number that one)."""
    numbers = F.transform(F.filter(F.split(F.regexp_extract(F.regexp_replace(version, "^[vV=]+", ""), r"^([0-9.]*)", 1), r"\."), lambda x: x != ""), lambda x: x.cast("decimal(38,0)"))
    places = F.transform(numbers, lambda x, k: F.when(x > 0, k + 1))
    at = F.coalesce(F.array_min(F.filter(places, lambda k: k.isNotNull())), F.size(numbers)) if caret else F.least(F.size(numbers), F.lit(2))
    up = F.transform(F.slice(numbers, 1, at), lambda x, k: F.when(k + 1 == at, x + 1).otherwise(x))
    return F.array_join(F.transform(up, lambda x: x.cast("string")), ".")


def bounds(requests: DataFrame) -> DataFrame:
    """``requirement, low, over, high, within, without`` of every distinct ``requirement``: the keys between which versions lie (null: no bound), whether the lower one is left out and the upper one in, and keys that are excluded.

    A requirement is a list of ``>=1.0``, ``>1``, ``<=2``, ``<2``, ``=1``, ``!=1``, ``^1.2``, ``~1.2`` or a bare version, joined by commas or blanks, all of which must hold; null, empty and ``*`` hold for every version."""
    clause = F.explode_outer(F.filter(F.split(F.regexp_replace("requirement", r"([<>=!^~])\s+", "$1"), r"[,\s]+"), lambda x: (x != "") & (x != "*")))
    parts = requests.select("requirement").distinct().select("requirement", clause.alias("c"))
    sign, version = F.regexp_extract("c", r"^([<>=!^~]*)", 1), F.regexp_replace("c", r"^[<>=!^~]*", "")
    key, one = version_key(version), F.lit(True)
    raised = F.when(sign == "^", version_key(_raised(version, True))).otherwise(version_key(_raised(version, False)))
    span = sign.isin("^", "~", "~=", "~>")
    exact = sign.isin("", "=", "==")
    low = F.when(sign.isin(">=", ">") | span | exact, F.struct(key.alias("key"), (sign == ">").alias("over")))
    high = F.when(sign.isin("<=", "<") | exact, F.struct(key.alias("key"), (sign != "<").alias("within"))).when(span, F.struct(raised.alias("key"), (~one).alias("within")))
    out = parts.groupBy("requirement").agg(F.max(low).alias("low"), F.min(high).alias("high"), F.collect_set(F.when(sign == "!=", key)).alias("without"))
    return out.select("requirement", F.col("low.key").alias("low"), F.coalesce("low.over", F.lit(False)).alias("over"), F.col("high.key").alias("high"), F.coalesce("high.within", F.lit(False)).alias("within"), "without")


def versions_in_range(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``purl, requirement, version``: the versions of the ``catalogue`` (``purl, version``) that fulfil each distinct request (``purl, requirement``). Requests without such a version have no row; versions that are null or
    have no catalogue entry don't either. Spellings of one version are rows of their own."""
    asked = requests.select("purl", "requirement").distinct()
    asked = asked.join(bounds(requests).withColumnRenamed("requirement", "of"), F.col("requirement").eqNullSafe(F.col("of"))).drop("of")
    known = catalogue.filter("version IS NOT NULL").select("purl", "version").distinct().withColumn("key", version_key(F.col("version")))
    keys = known.select("purl", "key").unionByName(asked.select("purl", F.col("low").alias("key"))).unionByName(asked.select("purl", F.col("high").alias("key"))).filter("key IS NOT NULL").distinct()
    ranked = keys.withColumn("rank", F.row_number().over(Window.partitionBy("purl").orderBy("key")))
    most = ranked.groupBy("purl").agg(F.max("rank").alias("most"))
    at = lambda rows, key, name: rows.join(ranked.select("purl", F.col("key").alias(key), F.col("rank").alias(name)), ["purl", key], "left")
    asked = at(at(asked, "low", "from"), "high", "to").join(most, "purl")
    asked = asked.withColumn("from", F.coalesce(F.col("from") + F.col("over").cast("int"), F.lit(1))).withColumn("to", F.coalesce(F.col("to") - (~F.col("within")).cast("int"), F.col("most"))).filter("`from` <= `to`")
    asked = asked.select("purl", "requirement", "from", "to", "without", F.explode(F.sequence(F.floor(F.col("from") / BUCKET), F.floor(F.col("to") / BUCKET))).alias("bucket"))
    known = at(known, "key", "rank").withColumn("bucket", F.floor(F.col("rank") / BUCKET))
    found = asked.join(known, ["purl", "bucket"]).filter((F.col("rank") >= F.col("from")) & (F.col("rank") <= F.col("to")) & ~F.array_contains("without", F.col("key")))
    return found.select("purl", "requirement", "version")
