import json

import pytest
from pyspark.sql import functions as F

from quarrylens.functions import columns as C
from quarrylens.functions import udfs
from quarrylens.operators import batching, decorations, dependencies, filters, folders, gitignore, merges, policies, reports, rollups, rules


@pytest.mark.parametrize(
    ("pattern", "path", "hit"),
    [
        ("*.js", "a/b.js", True), ("*.js", "a/b.jsx", False), ("/venv", "venv/x", True), ("/venv", "a/venv/x", False), ("build/", "a/build/x", True), ("build/", "build", False),
        ("a/**/b.c", "a/b.c", True), ("a/**/b.c", "a/x/y/b.c", True), ("**/t.py", "t.py", True), ("doc/**", "doc/x/y", True), ("x?.py", "xa.py", True), ("x?.py", "x/.py", False),
        ("[ab].c", "b.c", True), ("[!ab].c", "b.c", False), ("a.b", "aXb", False), ("\\!x", "!x", True), ("foo", "foo/bar", True),
    ],
)
def test_ignore_patterns(spark, pattern, path, hit):
    found = spark.createDataFrame([(path,)], "path string").select(gitignore.ignored(F.col("path"), [pattern])).first()[0]
    assert found is hit


def test_last_pattern_wins(spark):
    rows = spark.createDataFrame([("a.log",), ("keep.log",)], "path string")
    assert [r[0] for r in rows.select(gitignore.ignored(F.col("path"), ["*.log", "!keep.log", "# c", ""])).collect()] == [True, False]


def match(file_ord, purl, version="1", status="pending", kind="file", match_ord=0, licenses=(), path=None, **more):
    return dict(file_ord=file_ord, match_ord=match_ord, path=path or f"src/f{file_ord}.c", id=kind, status=status, purl=purl, component="c", version=version, latest="2", url="u", file="f", file_hash="h",
                lines="all", oss_lines="all", matched="100%", licenses=[{"name": n, "source": s} for n, s in licenses], **more)


MATCH = "file_ord long, match_ord int, path string, id string, status string, purl array<string>, component string, version string, latest string, url string, file string, file_hash string, lines string, oss_lines string, matched string, licenses array<struct<name:string,source:string>>"


def matches_of(spark, *rows):
    return spark.createDataFrame(list(rows), MATCH)


def test_component_rollup_counts(spark):
    rows = matches_of(
        spark, match(0, ["p"], status="identified"), match(1, ["p"], status="pending"), match(2, ["p"], status="identified"), match(3, ["p"], status="other"), match(4, ["q"], "", status="other"),
        match(5, [], status="pending"), match(6, ["r"], kind="none"), match(7, ["s"], status=None), match(8, ["p"], kind="dependency"),
    )
    found = {r.key: r for r in rollups.components(rollups.component_rows(rows)).collect()}
    assert set(found) == {"p@1", "q@unknown"}
    assert (found["p@1"].n, found["p@1"].declared, found["p@1"].undeclared, found["p@1"].status) == (4, 2, 2, "pending")
    # the first row of a key counts on neither side if it is neither identified nor pending
    assert (found["q@unknown"].n, found["q@unknown"].declared, found["q@unknown"].undeclared, found["q@unknown"].status) == (1, 0, 0, "other")


def test_license_selection_and_last_status(spark):
    listed = [("A", "scancode"), ("B", "license_file"), ("B", "license_file"), ("C", None)]
    rows = rollups.component_rows(matches_of(spark, match(0, ["p"], "1", "identified", licenses=listed), match(1, ["p"], "2", "pending", licenses=listed)))
    assert {(r.spdxid, r.source, r.n) for r in rollups.component_licenses(rows).filter("key = 'p@1'").collect()} == {("B", "license_file", 1)}
    assert {(r.spdxid, r.n) for r in rollups.component_licenses(rows, ["component_declared"]).filter("key = 'p@1'").collect()} == {("C", 1)}
    purls = rollups.purl_licenses(rollups.components(rows), rollups.component_licenses(rows)).collect()
    assert [(r.purl, r.spdxid, r.status) for r in purls] == [("p", "B", "pending")]


def test_policies(spark):
    rows = rollups.component_rows(matches_of(spark, match(0, ["p"], licenses=[("GPL-2.0-only", "component_declared"), ("MIT", "license_file")]), match(1, ["q"], status="identified", licenses=[("MIT", "component_declared")])))
    listed = spark.createDataFrame([("gpl-2.0-only", True), ("mit", False)], "license_key string, listed_copyleft boolean")
    assert [(r.purl, r.spdxid) for r in policies.copyleft_components(rows, listed).collect()] == [("p", "GPL-2.0-only")]
    assert policies.copyleft_components(rows, listed, ["file_header"]).count() == 0
    assert policies.copyleft_components(rows, listed, explicit=["MIT"]).count() == 2
    undeclared = policies.undeclared_components(rows)
    assert json.loads(policies.undeclared_settings(undeclared))["bom"]["include"] == [{"purl": "p"}]
    assert policies.exit_status(undeclared) == policies.FAILED
    assert policies.exit_status(undeclared.filter("false")) == policies.PASSED


def rule_table(spark, *rows):
    return spark.createDataFrame([(k, kind, path, purl, to, None) for k, (kind, path, purl, to) in enumerate(rows)], "rule_ord int, kind string, path string, purl string, replace_with string, license string")


def test_most_specific_rule(spark):
    rows = matches_of(spark, match(0, ["p"], path="a/b/x.c"), match(1, ["p"], path="a/y.c"), match(2, ["q"], path="z.c"), match(3, ["q"], path="a/b"))
    listed = rule_table(spark, ("x", None, "p", None), ("x", "a/", None, None), ("x", "a", "p", None), ("x", "a/b", "p", None), ("x", "a/b", "p", None), ("x", None, None, None), ("x", "a/b", None, None))
    found = {r.file_ord: r.rule_ord for r in rules.best_rules(rows, listed).collect()}
    assert found == {0: 3, 1: 2, 3: 6}


def test_remove_then_replace(spark):
    rows = matches_of(spark, match(0, ["pkg:github/o/a"], path="x/a.c"), match(1, ["pkg:github/o/b"], path="x/b.c"), match(2, ["pkg:github/o/c"], "9", path="y/c.c"))
    left = rules.without_removed(rows, rule_table(spark, ("remove", "x", "pkg:github/o/a", None)))
    assert {r.file_ord for r in left.collect()} == {1, 2}
    to = rule_table(spark, ("replace", "x", None, "pkg:github/o/c"), ("replace", "y", None, "pkg:npm/n"))
    found = {r.file_ord: r for r in rules.replaced(left, to, rules.component_map(rows)).collect()}
    assert (found[1].new_purl, found[1].version, found[1].status) == ("pkg:github/o/c", "9", "identified")
    assert (found[2].component, found[2].url) == ("n", "https://www.npmjs.com/package/n")


def test_contexts(spark):
    files = spark.createDataFrame([(0, "a/b/x.c"), (1, "c.c"), (2, "d/e.c")], "file_ord long, path string")
    include = rule_table(spark, ("include", None, "p", None), ("include", "a", "q", None), ("include", "a/b", "r", None))
    nothing = include.filter("false")
    exclude = rule_table(spark, ("exclude", "d", "z", None))
    found = {r.file_ord: (r.purls, r.scan_type) for r in rules.sbom_contexts(files, include, nothing, exclude).collect()}
    assert found[0] == (["r", "q", "p"], "identify") and found[1] == (["p"], "identify")
    assert {r.file_ord: r.scan_type for r in rules.sbom_contexts(files, nothing, nothing, exclude).collect()} == {0: None, 1: None, 2: "blacklist"}


def test_batches():
    assert batching.cut([10] * 5, [None] * 5, max_bytes=100, max_files=2) == [0, 0, 0, 1, 1]  # one more than the limit
    assert batching.cut([60, 60, 60], ["a"] * 3, max_bytes=100, max_files=9) == [0, 1, 2]
    assert batching.cut([1, 1, 1], ["a", "b", "b"], max_bytes=100, max_files=9) == [0, 1, 1]
    assert batching.cut([500, 1], ["a", "a"], max_bytes=100, max_files=9) == [0, 1]


def test_numbering_is_gapless(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"))
    assert sorted((r.k, r.n) for r in reports.numbered(rows, ["k"], "n").collect()) == [(k, k + 1) for k in range(5000)]


def test_scopes(spark):
    rows = spark.createDataFrame([("f", "a", "dev"), ("f", "b", None), ("g", "c", "test"), ("g", "d", "compile")], "file string, purl string, scope string")
    kept = lambda **k: {r.purl for r in dependencies.in_scope(rows, **k).collect()}
    assert kept(scope="prod") == {"b", "d"} and kept(scope="dev") == {"a", "c"} and kept() == set("abcd")
    assert kept(include=["dev", "test"], exclude=["test"]) == {"a"} and kept(exclude=["dev"]) == {"b", "c", "d"}
    with pytest.raises(ValueError):
        dependencies.in_scope(rows, "other")


def test_scalars(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(C.clean_requirement(F.lit("pkg:pypi/a"), F.lit("a>=1.0"))) == ">=1.0"
    assert value(C.clean_requirement(F.lit("pkg:pypi/a@3"), F.lit("3"))) is None
    assert value(C.clean_requirement(F.lit("pkg:npm/a"), F.lit("file:../x"))) is None
    assert value(C.purl_url(F.lit("pkg:npm/%40electron/rebuild@1"))) == "https://www.npmjs.com/package/@electron/rebuild"
    assert value(C.severity(F.lit(None).cast("string"))) == "unknown"
    assert value(decorations.in_range(F.lit("1.10.0"), F.lit(">=1.9, <2"))) is True
    assert value(decorations.in_range(F.lit("2.0"), F.lit("<2"))) is False
    assert value(F.lpad(F.lower(F.hex(udfs.crc64(F.encode(F.lit("123456789"), "UTF-8")))), 16, "0")) == "995dc9bbdf1939fa"
    assert value(udfs.decoded(F.unhex(F.lit("61ff62")))) == "ab"


def test_filters_refuse_unknown_values(spark):
    with pytest.raises(ValueError):
        filters.results_filtered(matches_of(spark, match(0, ["p"])), ["folder"])


def test_folder_hashes(spark):
    from quarrylens.functions import codecs

    files = spark.createDataFrame([(f"root/dir{k % 2}/some_file_{k}.c", f"text {k}", 6) for k in range(10)], "path string, text string, size long")
    found = {r.dir: r for r in folders.folder_simhashes(files, depth=3).collect()}
    assert found["root/dir0"].sim_hash_content is None  # fewer than eight files
    keys = [codecs.crc64(f"text {k}".encode()).to_bytes(8, "big") for k in range(10)]
    assert found["."].sim_hash_content == f"{codecs.simhash(codecs.fnv1_all(keys)):02x}"
    names = " ".join(sorted(f"some_file_{k}" for k in range(10)))
    assert found["."].sim_hash_names == f"{codecs.simhash(codecs.fnv1_all(codecs.word_features(names.encode()))):02x}"


def test_last_part_wins(spark):
    part = lambda *rows: spark.createDataFrame(list(rows), "k string, v int")
    assert {(r.k, r.v) for r in merges.last_wins([part(("a", 1), ("b", 1)), part(("a", 2))], "k").collect()} == {("a", 2), ("b", 1)}


def test_tables_for_people():
    assert reports.markdown_table(["a", "b"], [["1", "2"]], (1,)) == "a | b\n- | :-:\n1 | 2"
    assert reports.jira_table(["a", "b"], [["1", "2"], ["3"]]) == "|*a*|*b*|\n|1|2|"


def test_catalogue_search(spark):
    rows = spark.createDataFrame([("pkg:a/x", "x", "v", "1"), ("pkg:a/xy", "xy", "w", "2")], "purl string, component string, vendor string, version string")
    assert [r.purl for r in decorations.component_search(rows, "x", limit=1, offset=1).collect()] == ["pkg:a/xy"]
    assert decorations.component_search(rows, vendor="V").count() == 1
    assert decorations.component_versions(rows, "pkg:a/x").count() == 1
    requests = spark.createDataFrame([("pkg:a/x@2",), ("pkg:b@1",)], "purl string")
    assert {(r.purl, r.vendor) for r in decorations.decorated(requests, rows.select("purl", "vendor")).collect()} == {("pkg:a/x@2", "v"), ("pkg:b@1", None)}


KNOWN = [("Foo-1.0", "Foo License 1.0"), ("MIT", "MIT License"), ("GPL-2.0-only", "GNU General Public License v2.0 only"), ("Apache-1.0", "Apache License 1.0"), ("Apache-2.0", "Apache License 2.0"), ("Foo", "A-foo-of-old"), ("MIT-0", "MIT License"), ("Bar-1", None)]


def test_licenses_are_looked_up_in_four_steps(spark):
    known = spark.createDataFrame([(k, i.lower(), i, n) for k, (i, n) in enumerate(KNOWN)], "place int, spdx_key string, spdx_name string, license_name string")
    expected = {
        "GPL- 2.0-only": "GPL-2.0-only", "apache": "Apache-1.0", "gpl": "GPL-2.0-only", "foo": "Foo", "bar": "Bar-1",  # ids without white space, and short ones
        "apache 2.0": "Apache-2.0", "Apache \t\n2.0": "Apache-2.0", "gpl\u00a02.0 only": "GPL-2.0-only",  # with dashes
        "MIT License": "MIT-0", "gnu general  public license v2.0\tONLY": "GPL-2.0-only", "apachelicense2.0": "Apache-2.0",  # names
        "a foo of old": "Foo",  # a name with dashes
        "Other Name": "LicenseRef-Other-Name", "LicenseRef-own": "LicenseRef-own", "": "LicenseRef-",
    }
    names = spark.createDataFrame([(n,) for n in expected], "name string")
    assert {r.name: r.spdxid for r in reports.spdx_licenses(names, known).collect()} == expected
    rows = matches_of(spark, match(0, ["pkg:a"], licenses=[("MIT License", None), ("apache", "license_file"), ("Other Name", "file_header")]), match(1, ["pkg:b"], licenses=[("GPL- 2.0-only", "")]), match(2, ["pkg:c"]))
    deps = spark.createDataFrame([], "file_ord long, dep_ord int, path string, purl string, component string, version string, requirement string, scope string, license string")
    packages = reports.spdx_packages(rows, deps, known)
    assert {r.purl: r.license for r in packages.collect()} == {"pkg:a": "(Apache-1.0 AND LicenseRef-Other-Name AND MIT-0)", "pkg:b": "GPL-2.0-only", "pkg:c": "NOASSERTION"}
    assert [r.license_ref for r in reports.license_references(packages).collect()] == ["LicenseRef-Other-Name"]
