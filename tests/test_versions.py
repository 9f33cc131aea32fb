"""Version keys and ranges against loops."""

import itertools
import random
import re

from pyspark.sql import functions as F

from quarrylens.operators import versions


def key(version):
    """Numbers without zeros at their end, whether it is a release, identifiers of the pre-release."""
    bare = re.sub(r"^[vV=]+|\+.*$", "", version.strip())
    numbers = [int(x) for x in re.match(r"[0-9.]*", bare)[0].split(".") if x]
    while numbers and numbers[-1] == 0:
        numbers.pop()
    pre = re.sub(r"^[0-9.]*[-_]?", "", bare)
    return numbers, [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"[.\-_]", pre) if x], not pre


def less(a, b):
    """Whether a comes before b: the first number that differs, with 0 for missing ones; then pre-releases, by their identifiers; then the release."""
    (n, p, release), (m, q, other) = key(a), key(b)
    for x, y in itertools.zip_longest(n, m, fillvalue=0):
        if x != y:
            return x < y
    if release or other:
        return other and not release
    return p < q


def fulfils(version, requirement):
    clauses = [c for c in re.split(r"[,\s]+", re.sub(r"([<>=!^~])\s+", r"\1", requirement or "")) if c not in ("", "*")]
    for clause in clauses:
        sign, bound = re.match(r"([<>=!^~]*)(.*)", clause).groups()
        below, equal = less(version, bound), not less(version, bound) and not less(bound, version)
        if sign in ("^", "~"):
            numbers = [int(x) for x in re.match(r"[0-9.]*", bound)[0].split(".") if x]
            at = next((k for k, x in enumerate(numbers) if x), len(numbers) - 1) if sign == "^" else min(len(numbers), 2) - 1
            top = ".".join(map(str, [*numbers[:at], numbers[at] + 1]))
            good = not below and less(version, top)
        else:
            good = {">=": not below, ">": not below and not equal, "<=": below or equal, "<": below, "!=": not equal}.get(sign, equal)
        if not good:
            return False
    return True


VERSIONS = ["1", "1.0", "1.0.0", "v1.0.1", "1.0.10", "1.0.9", "1.2.0-rc.1", "1.2.0-rc.10", "1.2.0-rc.9", "1.2.0-alpha", "1.2.0-alpha.1", "1.2.0-1", "1.2.0", "1.2", "1.2.0+build5", "2.0.0", "10.0", "0.0.3", "0.2.3", "0.0", "20240101", "1.10.0", "3.99999999999.1", "1.2.0-beta"]


def test_keys_sort_as_versions_do(spark):
    rows = {r.v: r.k for r in spark.createDataFrame([(v,) for v in VERSIONS], "v string").withColumn("k", versions.version_key(F.col("v"))).collect()}
    for a, b in itertools.product(VERSIONS, VERSIONS):
        assert (rows[a] < rows[b]) == less(a, b), (a, b)
    assert spark.createDataFrame([(None,)], "v string").select(versions.version_key(F.col("v"))).first()[0] is None


def test_ranges(spark, monkeypatch):
    monkeypatch.setattr(versions, "BUCKET", 4)  # intervals of several buckets
    rng = random.Random(4)
    requirements = [None, "", "*", ">=1.0", "> 1.0.1", "<1.2.0", "<=1.2", "=1.0.0", "==1", "1.0", "!=1.2.0", ">=1.0,<2", ">=1 <1.2.0 !=1.0.9", "^1.0.1", "^0.2", "^0.0.3", "~1.2.0-alpha", "~1", "~1.0.9", ">9", "<0", ">=1.2.0-alpha.1,<1.2.0-rc.9", ">=2,<1"]
    catalogue = [(f"p{k % 3}", v) for k in range(3) for v in VERSIONS if rng.random() < 0.8] + [("p0", None), ("p9", "1")] + [("hot", f"{a}.{b}") for a in range(6) for b in range(12)]
    requests = [(p, r) for p in ("p0", "p1", "p2", "none", "hot") for r in requirements] * 2
    found = versions.versions_in_range(spark.createDataFrame(requests, "purl string, requirement string"), spark.createDataFrame(catalogue, "purl string, version string")).collect()
    want = {(p, r, v) for p, r in set(requests) for q, v in catalogue if p == q and v is not None and fulfils(v, r)}
    assert len(found) == len(want) and {tuple(r) for r in found} == want
