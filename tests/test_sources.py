import json

import pytest
from pyspark.sql import functions as F

from quarrylens.functions import codecs, udfs
from quarrylens.operators import dependencies, fingerprints
from quarrylens.sources import readers, writers
from quarrylens.streaming import fingerprint_stream


def test_source_tree(spark, tmp_path):
    for name, text in {"src/a.c": "int a;", "src/b.md": "x", "venv/c.c": "x", "src/.d.c": "x", "src/empty.c": ""}.items():
        (tmp_path / "tree" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / name).write_text(text)
    rows = readers.source_tree(spark, str(tmp_path / "tree")).collect()
    assert [(r.path, r.size, bytes(r.content)) for r in rows] == [("src/a.c", 6, b"int a;")]
    listed = [str(tmp_path / "tree" / n) for n in ("src/a.c", "venv/c.c", "src/b.md", "src/.d.c", "src/empty.c", "src/none.c", "src")]
    assert sorted(r.path.rpartition("/")[2] for r in readers.listed_files(spark, listed).collect()) == ["a.c", "c.c"]
    assert readers.listed_files(spark, listed[-2:]).count() == 0
    assert sorted(r.path for r in readers.source_tree(spark, str(tmp_path / "tree"), folder_hash=True).collect()) == ["src/a.c", "src/b.md", "venv/c.c"]
    assert readers.contents(spark, [("x", b"y")]).first().size == 1


def test_wfp_round_trip(spark, tmp_path):
    text = "".join(f"int value_{k} = {k};\n" for k in range(200))
    files = spark.createDataFrame([("a,b.c", text), ("c.c", text[::-1])], "path string, text string")
    writers.write_wfp(fingerprints.wfp_blocks(files), str(tmp_path / "wfp"))
    back = {r.path: r for r in readers.wfp_records(spark, str(tmp_path / "wfp")).collect()}
    assert set(back) == {"a,b.c", "c.c"}
    assert [(s.line, list(s.hashes)) for s in back["a,b.c"].snippets] == codecs.snippet_lines(text.encode())
    assert back["a,b.c"].size == len(text)


def test_wfp_table_function(spark):
    udfs.register(spark)
    text = "x".join(str(k) for k in range(300))
    assert spark.sql(f"SELECT count(*) FROM wfp_lines(encode('{text}', 'UTF-8'))").first()[0] > 0


def test_results_reader(spark, tmp_path):
    data = {"b.c": [{"id": "file", "status": "pending", "purl": ["p"], "licenses": [{"name": "MIT", "source": "scancode"}]}, {"id": "none"}], "a.c": []}
    (tmp_path / "r.json").write_text(json.dumps(data))
    rows = readers.scan_results(spark, str(tmp_path / "r.json")).orderBy("file_ord", "match_ord").collect()
    assert [(r.path, r.match_ord, r.id) for r in rows] == [("b.c", 0, "file"), ("b.c", 1, "none")]
    written = json.loads(writers.result_json(readers.scan_results(spark, str(tmp_path / "r.json")).drop("doc_path")).first().json)
    assert written["b.c"][0]["purl"] == ["p"]


def test_inventories(spark, tmp_path):
    old = {"files": [{"path": "p.json", "type": "file", "packages": [{"dependencies": [{"purl": "pkg:npm/a%22", "requirement": "a>=1", "scope": "dev"}]}], "package_data": []}, {"path": "d", "type": "directory"}]}
    (tmp_path / "i.json").write_text(json.dumps(old, indent=1))
    rows = dependencies.flattened(readers.inventory(spark, str(tmp_path / "i.json"))).collect()
    assert [(r.file, r.purl, r.requirement, r.scope) for r in rows] == [("p.json", "pkg:npm/a", ">=1", "dev")]
    (tmp_path / "bom.json").write_text(json.dumps({"components": [{"purl": "pkg:a/b", "version": ""}, {"name": "x"}]}))
    assert [tuple(r) for r in readers.cyclonedx_requests(spark, str(tmp_path / "bom.json")).collect()] == [("pkg:a/b", None)]
    (tmp_path / "c.json").write_text(json.dumps({"artifacts": [{"purl": "q", "name": "n", "version": "1", "licenses": [{"value": "MIT"}]}, {"purl": "q", "name": "later"}]}))
    assert [(r.purl, r.name, r.license) for r in readers.container_artifacts(spark, str(tmp_path / "c.json")).collect()] == [("q", "n", "MIT")]
    (tmp_path / "v.json").write_text(json.dumps([{"type": "SECURITY", "timestamp": 1, "component": {"name": "n"}, "policyCondition": {"policy": {"name": "x", "violationState": "FAIL"}}}]))
    assert readers.violations(spark, str(tmp_path / "v.json")).first().policy == "x"


def test_settings(spark, tmp_path):
    assert readers.settings(str(tmp_path / "none.json")) == {}
    (tmp_path / "s.json").write_text(json.dumps({"bom": {"remove": [{"path": "a"}], "include": [{"purl": "p"}]}}))
    found = readers.settings_rules(spark, readers.settings(str(tmp_path / "s.json"))).collect()
    assert [(r.rule_ord, r.kind) for r in found] == [(0, "include"), (1, "remove")]
    assert readers.merged_settings({"ranking": "true", "min_snippet_hits": 3}, {"min_snippet_hits": -5}, {"ranking_threshold": 99}) == {"ranking": True, "min_snippet_hits": 0, "ranking_threshold": 10}
    assert readers.json_problem(str(tmp_path / "none.json"))[0] == 2
    (tmp_path / "bad.json").write_text("{")
    assert readers.json_problem(str(tmp_path / "bad.json"))[0] == 1
    assert readers.json_problem(str(tmp_path / "s.json")) is None
    for wrong in ({"bom": {"remove": {}}}, {"bom": {"include": [{"purl": 1}]}}, {"settings": {"file_snippet": {"min_snippet_hits": "x"}}}, {"settings": {"skip": {"sizes": {"scanning": [{"min": True}]}}}}, {"bom": []}):
        (tmp_path / "w.json").write_text(json.dumps(wrong))
        with pytest.raises(ValueError, match="must be"):
            readers.settings(str(tmp_path / "w.json"))
    with pytest.raises(ValueError):
        readers.purl_requests(spark)


def test_documents(spark, tmp_path):
    components = spark.createDataFrame([("pkg:a/b", "b", "1", "MIT,ISC")], "purl string, component string, version string, licenses string")
    vulns = spark.createDataFrame([("CVE-1", "high", "NVD", "pkg:a/b")], "vuln_id string, severity string, source string, affects string")
    whole = lambda lines: json.loads("\n".join(r.line for r in lines.orderBy("part", "place").collect()))
    bom = whole(writers.cyclonedx(components, vulns, "s", "t"))
    assert bom["components"][0]["licenses"] == [{"license": {"id": "MIT"}}, {"license": {"id": "ISC"}}] and bom["vulnerabilities"][0]["id"] == "CVE-1" and bom["metadata"] == {"timestamp": "t"}
    packages = spark.createDataFrame([("pkg:a/b", "SPDXRef-1", "MIT"), ("pkg:a/c", "SPDXRef-2", "ISC")], "purl string, spdx_id string, license string")
    lines = writers.spdx_lite(packages, spark.createDataFrame([("LicenseRef-x",)], "license_ref string"), "n", "c")
    assert [p["licenseDeclared"] for p in whole(lines)["packages"]] == ["MIT", "ISC"]
    writers.write_document(lines, str(tmp_path / "spdx"))
    assert json.loads("".join(f.read_text() for f in (tmp_path / "spdx").glob("part-*"))) == whole(lines)
    assert whole(writers.document(packages, ["purl"], "rows")) == {"rows": [{"spdx_id": "SPDXRef-1", "license": "MIT"}, {"spdx_id": "SPDXRef-2", "license": "ISC"}]}
    assert whole(writers.document(packages.filter("false"), ["purl"], "rows")) == {"rows": []}
    payload = json.loads(writers.upload_payload(spark.createDataFrame([("{}",)], "json string"), {"name": "n", "version": "1"}).first().json)
    assert payload["bom"] == "e30="
    (tmp_path / "root").mkdir()
    (tmp_path / "root/a.txt").write_text("x")
    assert writers.copy_listed(["/a.txt", "../b", "missing"], str(tmp_path / "root"), str(tmp_path / "out")) == [("/a.txt", True), ("../b", False), ("missing", False)]
    with pytest.raises(ValueError):
        writers.presenter("pdf")
    assert writers.presenter(None) is writers.plain and writers.presenter("raw") is writers.raw


def test_stream_gives_the_batch_result(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    files = fingerprint_stream.arriving_documents(spark, str(tmp_path / "in"), docs.schema)
    fingerprint_stream.start(files, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = fingerprints.fingerprints(docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".py")).alias("path"), F.coalesce("text", F.lit("")).alias("text")))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch.select(*streamed.columns)).isEmpty()


def test_spdx_list(spark, tmp_path):
    document = {"licenseListVersion": "3", "licenses": [{"licenseId": "Foo-1.0", "name": "Foo License", "isDeprecatedLicenseId": False}, {"licenseId": "", "name": "none"}, {"name": "no id"}, {"licenseId": "Bar"}]}
    (tmp_path / "list.json").write_text(json.dumps(document, indent=2))
    assert sorted(map(tuple, readers.spdx_list(spark, str(tmp_path / "list.json")).collect())) == [(0, "foo-1.0", "Foo-1.0", "Foo License"), (3, "bar", "Bar", None)]
    (tmp_path / "empty.json").write_text("{}")
    assert readers.spdx_list(spark, str(tmp_path / "empty.json")).count() == 0


def test_plain_results_have_nested_values_and_sorted_keys(spark, sf_dir):
    import json

    from quarrylens.sources import inputs, writers

    matches = inputs.matches(spark, sf_dir)
    plain = {r.path: r.json for r in writers.plain(matches).collect()}
    raw = {r.path: json.loads(r.json) for r in writers.result_json(matches).collect()}
    assert len(plain) == len(raw) > 0
    for path, text in plain.items():
        pairs = []
        assert json.loads(text, object_pairs_hook=lambda p: pairs.append([k for k, _ in p]) or dict(p)) == raw[path]
        assert all(keys == sorted(keys) for keys in pairs) and "\n" in text
        assert all(isinstance(x, str) for m in raw[path][path] for x in m["purl"])


def test_documents_are_json_with_every_field(spark, sf_dir):
    import json

    from quarrylens.plans import documents
    from quarrylens.plans.catalog import queries

    whole = lambda name: json.loads("".join(r.line for r in sorted(queries()[name](spark, sf_dir).collect(), key=lambda r: (r.part, r.place))))
    bill = whole("B4_spdx_lines")
    assert set(bill) == {"spdxVersion", "dataLicense", "SPDXID", "name", "creationInfo", "documentNamespace", "packages", "documentDescribes", "hasExtractedLicensingInfos"}
    assert [p["SPDXID"] for p in bill["packages"]] == bill["documentDescribes"] and len(bill["packages"]) > 50
    fields = {"name", "SPDXID", "versionInfo", "downloadLocation", "homepage", "licenseDeclared", "licenseConcluded", "filesAnalyzed", "copyrightText", "supplier", "externalRefs", "checksums"}
    assert all(set(p) == fields and len(p["checksums"][0]["checksumValue"]) == 32 for p in bill["packages"])
    assert {r["licenseId"] for r in bill["hasExtractedLicensingInfos"]} <= {x for p in bill["packages"] for x in p["licenseDeclared"].strip("()").split(" AND ")}
    found = whole("B3_cyclonedx_lines")
    listed = [x["license"] for c in found["components"] for x in c["licenses"]]
    assert {tuple(x) for x in listed} == {("id",), ("name",)} and all(x.get("id") in (None, "MIT", "GPL-2.0-only", "Apache-2.0", "BSD-2-Clause") for x in listed)
    assert all(c["bom-ref"] == c["purl"] and "publisher" in c for c in found["components"]) and any("cpe" in c for c in found["components"])
    assert all(v["source"]["url"].startswith("https://") and v["affects"] for v in found["vulnerabilities"])
    assert documents.matches(spark, sf_dir).limit(0).count() == 0


def test_purl_locators(spark):
    from pyspark.sql import functions as F

    from quarrylens.sources.writers import purl_locator

    rows = [("pkg:github/Org/Lib", "v1+a b", "pkg:github/org/lib@v1%2Ba%20b"), ("pkg:pypi/My_Lib", "1~2:3", "pkg:pypi/my-lib@1~2:3"), ("pkg:npm/%40Scope/X", "", "pkg:npm/%40Scope/X"), ("pkg:npm/x", None, "pkg:npm/x")]
    for r in spark.createDataFrame(rows, "purl string, version string, want string").withColumn("got", purl_locator(F.col("purl"), F.col("version"))).collect():
        assert r.got == r.want


def test_licence_references_name_their_detector(spark):
    import json

    from quarrylens.sources import writers

    packages = spark.createDataFrame([("pkg:a/b", "SPDXRef-1", "MIT")], "purl string, spdx_id string, license string")
    refs = spark.createDataFrame([("LicenseRef-scancode-some-form",), ("LicenseRef-own",)], "license_ref string")
    lines = sorted(writers.spdx_lite(packages, refs, "n", "now").collect(), key=lambda r: (r.part, r.place))
    found = json.loads("".join(r.line for r in lines))
    assert [(r["name"], r["comment"]) for r in found["hasExtractedLicensingInfos"]] == [("own", "Detected license."), ("some form", "Detected license by scancode.")]
    assert found["packages"][0]["supplier"] == "Organization: NOASSERTION" and found["packages"][0]["name"] is None


def test_copies_by_executors(spark, tmp_path):
    root = tmp_path / "root"
    for k in range(40):
        (root / f"d{k % 5}").mkdir(parents=True, exist_ok=True)
        (root / f"d{k % 5}" / f"f{k}.txt").write_text(str(k) * k)
    paths = [f"/d{k % 5}/f{k}.txt" for k in range(40)] + ["d0/./f0.txt", "d1/../../x", "../root/d0/f0.txt", "gone", "d2", ""]
    listed = spark.createDataFrame([(p,) for p in paths + paths[:3]], "path string").repartition(4)
    copies = writers.copied_files(listed, str(root), str(tmp_path / "out"))
    done = {r.path: (r.copied, r["size"], r.problem) for r in copies.collect()}
    assert done["/d3/f13.txt"] == (True, 26, None) and done["d0/./f0.txt"][0] and done["d2"] == (False, None, "no file") and done["gone"] == (False, None, "missing")
    assert {p for p, x in done.items() if x[2] == "not in the tree"} == {"d1/../../x", "../root/d0/f0.txt", ""}
    (tmp_path / "out" / writers.PENDING).mkdir(exist_ok=True)
    (tmp_path / "out" / writers.PENDING / "half").write_text("what a lost task left")
    assert writers.commit_copies(copies, str(tmp_path / "out")) == (41, ": not in the tree")
    found = {str(f.relative_to(tmp_path / "out")): f.read_text() for f in (tmp_path / "out").rglob("*.txt") if "_manifest" not in str(f)}
    assert found == {f"d{k % 5}/f{k}.txt": str(k) * k for k in range(40)} and not (tmp_path / "out" / writers.PENDING).exists()
    lines = [json.loads(x) for f in sorted((tmp_path / "out/_manifest").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["path"] for x in lines] == sorted(set(paths))
    with pytest.raises(FileExistsError):
        writers.copied_files(listed, str(root), str(tmp_path / "out"))


def test_a_copy_that_is_repeated_leaves_one_file(tmp_path):
    """A task that runs twice, or at the same time as another one."""
    from concurrent.futures import ThreadPoolExecutor

    from pyarrow import fs

    (tmp_path / "a.txt").write_text("x" * 100_000)
    local, to, pending = fs.LocalFileSystem(), str(tmp_path / "out/sub/a.txt"), str(tmp_path / "out" / writers.PENDING)
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda _: writers._copied(local, str(tmp_path / "a.txt"), local, to, pending), range(24)))
    assert set(done) == {(True, 100_000, None)}
    assert [f.name for f in (tmp_path / "out").rglob("*") if f.is_file()] == ["a.txt"] and len((tmp_path / "out/sub/a.txt").read_text()) == 100_000


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_folder_lines_are_the_nested_document(spark, sf_dir, depth):
    from quarrylens.operators import folders
    from quarrylens.sources import inputs

    tree = inputs.tree(spark, sf_dir)
    whole = folders.folder_documents(tree, depth).filter("dir = '.'").first().json
    lines = folders.folder_lines(tree, depth).collect()
    assert "".join(r.line for r in sorted(lines, key=lambda r: r.place)) == whole
    assert sorted(r.place for r in lines) == list(range(1, len(lines) + 1)) and len(lines) % 2 == 0
