"""Named queries on readers, writers, checksums of short texts and small reports, and the SQL that gives the same rows.

Readers and writers are driven by documents made from the tables: a text form is written and read back, and must give the rows it was
made from. Registered with the queries of :mod:`.catalog`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrylens.functions import columns as C
from quarrylens.functions import fixed_values as V
from quarrylens.functions import udfs
from quarrylens.operators import decorations, dependencies, filters, fingerprints, folders, merges, policies, reports, rollups
from quarrylens.plans import catalog as Q
from quarrylens.plans.catalog import query
from quarrylens.session import table
from quarrylens.sources import inputs as I
from quarrylens.sources import readers, writers
from quarrylens.sources.inputs import COPYLEFT_SQL, DEPS_SQL, FILES_SQL, MATCHES_SQL, TREE_SQL

# Readers


@query("A2_listed_files", f"WITH {TREE_SQL} SELECT path, size FROM tree WHERE file_ord % 3 = 0 AND NOT {Q._FILE_SKIPPED} AND size > 0")
def _a2(spark, d):
    tree = I.tree(spark, d)
    names = tree.filter("file_ord % 3 = 0").select("path").unionByName(tree.select(F.concat("path", F.lit(".gone")).alias("path")))
    return filters.listed(tree, names).select("path", "size")


_HASH_SKIPPED = f"(len(list_filter(string_split(path, '/'), lambda d: starts_with(d, '.') AND d <> '.')) > 0 OR lower({Q._NAME}) IN ({', '.join(repr(x) for x in V.SKIPPED_FILES_FOLDER_HASH)}))"


@query("A3_folder_hash_files", f"WITH {TREE_SQL} SELECT path FROM tree WHERE NOT {_HASH_SKIPPED} AND size > 0")
def _a3(spark, d):
    return filters.hashed_files(I.tree(spark, d)).select("path")


@query("A4_A5_content_rows", f"WITH {FILES_SQL} SELECT path, md5(text) AS md5, size FROM files")
def _a5(spark, d):
    """Contents that are in memory as bytes, without any filter."""
    rows = readers.content_rows(I.files(spark, d).select("path", F.encode("text", "UTF-8").alias("content")))
    return rows.select("path", F.md5("content").alias("md5"), "size")


@query("A6_wfp_records", f"WITH {TREE_SQL} SELECT path, md5(text) AS md5, size, {Q._FH2_OF_TEXT} AS fh2 FROM tree")
def _a6(spark, d):
    blocks = fingerprints.wfp_blocks(I.tree(spark, d), skip_snippets=True).select("wfp")
    return readers.parsed_wfp(blocks).select("path", "md5", "size", "fh2")


_MATCH_FIELDS = "path, match_ord, id, status, purl[1] AS purl, version, lines, len(licenses)::INT AS n_licenses, licenses[1].name AS license"


@query("A7_results_read_back", f"WITH {MATCHES_SQL} SELECT {_MATCH_FIELDS} FROM matches")
def _a7(spark, d):
    back = readers.parsed_results(writers.result_json(I.matches(spark, d)).select(F.col("json").alias("value")), F.col("value"))
    first = lambda c: F.try_element_at(c, F.lit(1))
    return back.select("path", "match_ord", "id", "status", first("purl").alias("purl"), "version", "lines", F.size("licenses").alias("n_licenses"), first(F.transform("licenses", lambda x: x["name"])).alias("license"))


@query("B1_raw_rows", f"WITH {MATCHES_SQL} SELECT path, id, status, version FROM matches")
def _b1(spark, d):
    return writers.raw(I.matches(spark, d)).select("path", F.from_json("json", "id string, status string, version string").alias("m")).select("path", "m.*")


_CLEAN = r"""clean AS (SELECT path AS file, dep_ord, purl, scope, regexp_replace(requirement, '^\s*[^<>=!^]+\s*([<>=!^])', '\1') AS bare FROM deps)"""


@query("A8_inventory", f"WITH {MATCHES_SQL}, {DEPS_SQL}, {_CLEAN} SELECT file, purl, CASE WHEN bare <> '' AND NOT ends_with(purl, bare) AND NOT starts_with(bare, 'file:') THEN bare END AS requirement, scope FROM clean")
def _a8(spark, d):
    items = I.deps(spark, d).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("dep_ord", "purl", F.col("requirement").alias("extracted_requirement"), "scope"))).alias("dependencies"))
    document = F.to_json(F.struct(F.array(F.struct("path", F.lit("file").alias("type"), F.array(F.struct("dependencies")).alias("package_data"))).alias("files")))
    read = items.select(F.from_json(document, dependencies.INVENTORY).alias("x")).select("x.files")
    return dependencies.flattened(read).drop("dep_ord")


@query("A9_parsed_dependencies", f"WITH {MATCHES_SQL}, {DEPS_SQL} SELECT path AS file, dep_ord AS place, purl, requirement, scope FROM deps")
def _a9(spark, d):
    purls = F.transform(F.sort_array(F.collect_list(F.struct("dep_ord", "purl", "requirement", "scope"))), lambda x: F.struct(x["purl"].alias("purl"), x["requirement"].alias("requirement"), x["scope"].alias("scope")))
    files = I.deps(spark, d).groupBy(F.col("path").alias("file")).agg(purls.alias("purls"))
    return readers.parsed_dependencies(files.select(F.to_json(F.struct(F.array(F.struct("file", "purls")).alias("files"))).alias("value")), F.col("value"))


@query("A13_E4_cyclonedx_requests", f"WITH {MATCHES_SQL}, {DEPS_SQL} SELECT purl, nullif(version, '') AS requirement FROM deps")
def _a13(spark, d):
    bom = F.to_json(F.struct(F.array(F.struct(F.col("component").alias("name"), "version", "purl"), F.struct(F.lit("x").alias("name"), "version", F.lit(None).cast("string").alias("purl"))).alias("components")))
    return readers.parsed_cyclonedx(I.deps(spark, d).select(bom.alias("value")), F.col("value"))


@query("A14_purl_requests", f"WITH {MATCHES_SQL}, {DEPS_SQL} SELECT purl, requirement FROM deps")
def _a14(spark, d):
    return readers.parsed_purls(I.deps(spark, d).select(F.to_json(F.struct(F.array(F.struct("purl", "requirement")).alias("purls"))).alias("value")), F.col("value"))


@query("A15_copyleft_table", f"WITH {MATCHES_SQL}, {COPYLEFT_SQL}, l AS (SELECT path, match_ord, unnest(licenses).name AS license FROM matches) SELECT path, match_ord, license, license_key, listed_copyleft FROM l LEFT JOIN copyleft ON lower(license) = license_key")
def _a15(spark, d):
    """What the reference table says of every licence of a match."""
    names = I.matches(spark, d).select("path", "match_ord", F.explode("licenses").alias("l")).select("path", "match_ord", F.col("l.name").alias("license"))
    return names.join(I.copyleft_table(spark), F.lower("license") == F.col("license_key"), "left")


@query("J7_copyleft_lookup", f"WITH {MATCHES_SQL}, {COPYLEFT_SQL}, l AS (SELECT DISTINCT unnest(licenses).name AS license FROM matches) SELECT license, coalesce(listed_copyleft, false) AS is_copyleft FROM l LEFT JOIN copyleft ON lower(license) = license_key")
def _j7(spark, d):
    names = I.matches(spark, d).select(F.explode("licenses").alias("l")).select(F.col("l.name").alias("license")).distinct()
    found = names.join(I.copyleft_table(spark), F.lower("license") == F.col("license_key"), "left")
    return found.select("license", C.copyleft(F.col("license"), F.col("listed_copyleft")).alias("is_copyleft"))


@query("A16_delta_list", "SELECT source || '/' || lang || '/f' || doc_id AS path FROM documents WHERE doc_id % 4 <> 3")
def _a16(spark, d):
    name = F.concat("source", F.lit("/"), "lang", F.lit("/f"), F.col("doc_id").cast("string"))
    line = F.when(F.col("doc_id") % 4 == 3, "   ").otherwise(F.concat(F.repeat(F.lit("/"), (F.col("doc_id") % 3).cast("int")), name, F.lit("  ")))
    return readers.delta_paths(table(spark, d, "documents").select(line.alias("value")), F.col("value"))


_JSON = """CASE doc_id % 4 WHEN 0 THEN '{"a": [1, 2]}' WHEN 1 THEN '  ' WHEN 2 THEN '{"a": ' ELSE concat('"', CAST(doc_id AS STRING), '"') END"""


@query("A17_json_state", f"SELECT doc_id, CASE WHEN trim(v) = '' THEN 3 WHEN NOT json_valid(v) THEN 1 END::VARCHAR AS state FROM (SELECT doc_id, {_JSON.replace('STRING', 'VARCHAR')} AS v FROM documents)")
def _a17(spark, d):
    return table(spark, d, "documents").select("doc_id", readers.json_state(F.expr(_JSON)).cast("string").alias("state"))


_SETTING = ("CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id % 40 - 20 AS INT) END", "CASE WHEN doc_id % 5 = 0 THEN 3 END", "CASE WHEN doc_id % 2 = 0 THEN -7 END")


@query("D27_settings_merge", f"""WITH s AS (SELECT doc_id, coalesce({', '.join(_SETTING)}) AS v FROM documents)
SELECT doc_id, CASE WHEN v IS NOT NULL THEN greatest(v, 0) END::VARCHAR AS hits, CASE WHEN v IS NOT NULL THEN least(greatest(v, -1), 10) END::VARCHAR AS threshold FROM s""")
def _d27(spark, d):
    given = [F.expr(x) for x in _SETTING]
    return table(spark, d, "documents").select("doc_id", readers.merged_setting(*given, least=0).cast("string").alias("hits"), readers.merged_setting(*given, least=-1, most=10).cast("string").alias("threshold"))


# Writers


@query("B2_csv_read_back", Q._CSV_SQL)
def _b2(spark, d):
    rows = reports.csv_rows(I.matches(spark, d), I.deps(spark, d))
    line = rows.select(F.to_csv(F.struct(*rows.columns), {"emptyValue": ""}).alias("line"))
    back = line.select(F.from_csv("line", ", ".join(f"{c} {t}" for c, t in rows.dtypes), {"emptyValue": ""}).alias("r")).select("r.*")
    # an empty cell comes back as null
    return back.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in back.dtypes])


def _item(lines, part: int, schema: str):
    """Items of a part of a document, read back from its lines."""
    return lines.filter((F.col("part") == part) & F.col("line").rlike(r"^,?\{")).select(F.from_json(F.regexp_replace("line", "^,", ""), schema).alias("x"))


@query("B3_cyclonedx_document", Q._SQL["E6_cdx_components"])
def _b3(spark, d):
    found = reports.cyclonedx_components(I.matches(spark, d), I.deps(spark, d))
    none = spark.createDataFrame([], "vuln_id string, severity string, source string, affects string")
    items = _item(writers.cyclonedx(found, none, "id", "now"), 1, "name string, purl string, version string, licenses array<struct<license:struct<id:string>>>")
    return items.select("x.purl", F.col("x.name").alias("component"), "x.version", F.array_join(F.transform("x.licenses", lambda l: l["license"]["id"]), ",").alias("licenses"))  # noqa: E741


@query("B4_spdx_document", Q._SQL["E7_spdx_packages"])
def _b4(spark, d):
    packages = Q._spdx(spark, d)
    lines = writers.spdx_lite(packages, reports.license_references(packages), "name", "now")
    locator = F.element_at("x.externalRefs", 1)["referenceLocator"]
    return _item(lines, 1, "SPDXID string, licenseDeclared string, externalRefs array<struct<referenceLocator:string>>").select(F.regexp_replace(locator, "@[^@/]*$", "").alias("purl"), F.col("x.SPDXID").alias("spdx_id"), F.col("x.licenseDeclared").alias("license"))


@query("B6_markdown_lines", f"""WITH {MATCHES_SQL}, s AS (SELECT lang, count(*) AS n FROM matches GROUP BY lang)
SELECT -1::BIGINT AS place, 'lang | n' AS line UNION ALL SELECT 0, '- | -' UNION ALL SELECT row_number() OVER (ORDER BY lang), lang || ' | ' || n FROM s""")
def _b6(spark, d):
    return reports.markdown_lines(I.matches(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("n")), ["lang", "n"], ["lang"])


@query("B9_folder_documents")
def _b9(spark, d):
    return folders.folder_documents(I.tree(spark, d), depth=2)


@query("B12_file_type_lines", f"WITH t AS ({Q._SQL['F7_file_types']}) SELECT extension || ',' || n_files || ',' || CASE WHEN contains(size_mb, ',') THEN '\"' || size_mb || '\"' ELSE size_mb END AS line FROM t")
def _b12(spark, d):
    return rollups.file_type_lines(rollups.file_types(I.tree(spark, d), C.suffix(F.col("path"))))


# Filters and counts


@query("C9_binary", "SELECT doc_id, doc_id % 7 = 0 AS is_binary FROM documents")
def _c9(spark, d):
    content = F.encode("text", "UTF-8")
    content = F.when(F.col("doc_id") % 7 == 0, F.concat(F.coalesce(content, F.unhex(F.lit(""))), F.unhex(F.lit("00")))).otherwise(F.coalesce(content, F.unhex(F.lit(""))))
    return table(spark, d, "documents").select("doc_id", filters.is_binary(content).alias("is_binary"))


@query("C11_valid_matches", f"WITH {MATCHES_SQL} SELECT path, match_ord FROM matches WHERE id NOT IN ('none', 'dependency') AND status IS NOT NULL AND len(purl) > 0")
def _c11(spark, d):
    return filters.valid_matches(I.matches(spark, d)).select("path", "match_ord")


@query("F11_wfp_file_counts", "SELECT count(*) AS n_files FROM documents")
def _f11(spark, d):
    return rollups.wfp_file_counts(fingerprints.wfp_blocks(I.files(spark, d), skip_snippets=True))


@query("P3_F12_policy_counts", f"""WITH a AS ({Q._SQL['P1_copyleft']}), b AS ({Q._SQL['P2_undeclared']}), c AS (SELECT 'copyleft' AS policy, count(*) AS n_violations FROM a UNION ALL SELECT 'undeclared', count(*) FROM b UNION ALL SELECT 'none', 0)
SELECT policy, n_violations, CASE WHEN n_violations > 0 THEN 2 ELSE 0 END::INT AS exit_status FROM c""")
def _p3(spark, d):
    undeclared = policies.undeclared_components(Q._rows(spark, d))
    return policies.counts(copyleft=policies.copyleft_components(Q._all_rows(spark, d), I.copyleft_table(spark)), undeclared=undeclared, none=undeclared.filter("false"))


_KINDS = "CASE doc_id % 3 WHEN 0 THEN 'SECURITY' WHEN 1 THEN 'LICENSE' ELSE 'OPERATIONAL' END"


@query("P6_violations", f"SELECT doc_id, place::INT AS place, {_KINDS} AS type, doc_id AS timestamp, 'p' || (doc_id % 5) AS policy, CASE WHEN place = 0 THEN 'FAIL' ELSE 'WARN' END AS state FROM documents, range(2) t(place)")
def _p6(spark, d):
    one = lambda state: F.struct(F.expr(_KINDS).alias("type"), F.col("doc_id").alias("timestamp"), F.struct(F.struct(F.concat(F.lit("p"), (F.col("doc_id") % 5).cast("string")).alias("name"), F.lit(state).alias("violationState")).alias("policy")).alias("policyCondition"))
    rows = table(spark, d, "documents").select(F.to_json(F.array(one("FAIL"), one("WARN"))).alias("value"))
    found = readers.parsed_violations(rows, F.col("value"))
    return found.select(F.col("timestamp").alias("doc_id"), "place", "type", "timestamp", "policy", "state")


_STATUS = "CASE WHEN doc_id % 50 = 7 THEN 'FAILED' WHEN doc_id % 50 = 9 THEN 'WARNING' ELSE 'SUCCESS' END"


@query("S2_merged_status", f"""WITH r AS (SELECT doc_id, {_STATUS} AS s, doc_id % 3 AS n FROM documents)
SELECT coalesce(arg_max(s, doc_id) FILTER (s <> 'SUCCESS'), 'SUCCESS') AS status, coalesce(arg_max('of ' || doc_id, doc_id) FILTER (s <> 'SUCCESS'), 'Success') AS message, count(*) FILTER (n > 0) AS n_files FROM r""")
def _s2(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("answer_ord"), F.expr(_STATUS).alias("status"), F.concat(F.lit("of "), F.col("doc_id").cast("string")).alias("message"), (F.col("doc_id") % 3).alias("n_files"))
    return merges.merged_status(rows)


_CATALOGUE = "SELECT DISTINCT 'pkg:github/org/' || source AS purl, source AS component, 'org' AS vendor FROM documents"


@query("S7_component_search", f"SELECT purl, component FROM ({_CATALOGUE}) WHERE contains(purl, 'src1') ORDER BY purl LIMIT 4 OFFSET 2")
def _s7(spark, d):
    known = table(spark, d, "documents").select(F.concat(F.lit("pkg:github/org/"), "source").alias("purl"), F.col("source").alias("component"), F.lit("org").alias("vendor")).distinct()
    return decorations.component_search(known, text="SRC1", vendor="ORG", limit=4, offset=2).select("purl", "component")


@query("A19_decorated", f"WITH {MATCHES_SQL}, {DEPS_SQL} SELECT path, dep_ord, purl, CASE WHEN starts_with(purl, 'pkg:pypi/base') THEN 'known' END AS answer FROM deps")
def _a19(spark, d):
    requests = I.deps(spark, d).select("path", "dep_ord", "purl")
    return decorations.decorated(requests, spark.createDataFrame([("pkg:pypi/base@9", "known")], "purl string, answer string"))


@query("E11_folder_cyclonedx", Q._BEST + " SELECT DISTINCT 'pkg:github/org/lib' || (o % 6) AS purl, 'lib' || (o % 6) AS component, 'v' || (o % 4) AS version FROM best")
def _e11(spark, d):
    return reports.folder_cyclonedx(reports.best_components(Q._folder_answers(spark, d))).select("purl", "component", "version")


@query("D25_decoded", "SELECT doc_id, md5(coalesce(text, '')) AS md5 FROM documents")
def _d25(spark, d):
    content = F.concat(F.unhex(F.lit("ff")), F.encode(F.coalesce("text", F.lit("")), "UTF-8"), F.unhex(F.lit("c3")))
    return table(spark, d, "documents").select("doc_id", F.md5(udfs.decoded(content)).alias("md5"))


# Checksums and hashes of short texts, bit by bit in SQL

_BITS = "list_transform(range(0, 8 * length(p_name)), lambda i: (ascii(p_name[(i // 8 + 1):(i // 8 + 1)]) >> (i % 8)::INT) & 1)"


def _crc_sql(kind: str, polynomial: int, start: int, final: int, digits: int) -> str:
    step = f"xor(c >> 1, (xor(c, b) & 1::{kind}) * {polynomial}::{kind})"
    bits = f"list_prepend({start}::{kind}, list_transform({_BITS}, lambda x: x::{kind}))"
    return f"SELECT p_partkey, lpad(lower(printf('%x', xor(list_reduce({bits}, lambda c, b: {step}), {final}::{kind}))), {digits}, '0') AS crc FROM part"


def _part_crc(spark, d, checksum, digits):
    rows = table(spark, d, "part")
    return rows.select("p_partkey", F.lpad(F.lower(F.hex(checksum(F.encode("p_name", "UTF-8")).cast("long"))), digits, "0").alias("crc"))


@query("D14_crc32c_names", _crc_sql("BIGINT", 0x82F63B78, 0xFFFFFFFF, 0xFFFFFFFF, 8))
def _d14n(spark, d):
    return _part_crc(spark, d, udfs.crc32c, 8)


@query("D15_crc64_names", _crc_sql("UBIGINT", 0xC96C5795D7870F42, (1 << 64) - 1, (1 << 64) - 1, 16))
def _d15n(spark, d):
    return _part_crc(spark, d, udfs.crc64, 16)


@query("D16_crc8_names", _crc_sql("BIGINT", 0x8C, 0, 0, 2))
def _d16n(spark, d):
    return _part_crc(spark, d, udfs.crc8, 2)


_FNV = "list_reduce(list_prepend(14695981039346656037::UHUGEINT, list_transform(range(1, length({w}) + 1), lambda i: ascii({w}[i:i])::UHUGEINT)), lambda h, b: xor((h * 1099511628211::UHUGEINT) % 18446744073709551616::UHUGEINT, b))"


def _simhash_sql(words: str, keys: str) -> str:
    """Simhash in hex of the ``w`` of each group of ``words``."""
    bit = "CASE WHEN sum(CASE WHEN (h >> k::UHUGEINT) & 1::UHUGEINT = 1::UHUGEINT THEN 1 ELSE -1 END) >= 0 THEN 1::UHUGEINT << k::UHUGEINT ELSE 0::UHUGEINT END"
    return f"SELECT {keys}, printf('%x', sum(b::HUGEINT)::UBIGINT) AS simhash FROM (SELECT {keys}, k, {bit} AS b FROM (SELECT {keys}, {_FNV.format(w='w')} AS h FROM ({words})), range(64) t(k) GROUP BY {keys}, k) GROUP BY {keys}"


_WORDS = r"unnest(regexp_extract_all(lower({x}), '[A-Za-z0-9_'']+(?:://[A-Za-z0-9_./]+)?')) AS w"


@query("D9_simhash_names", _simhash_sql(f"SELECT p_partkey, {_WORDS.format(x='p_name')} FROM part", "p_partkey"))
def _d9n(spark, d):
    return table(spark, d, "part").select("p_partkey", F.lower(F.hex(udfs.simhash_words("p_name"))).alias("simhash"))


_STEM = f"regexp_replace({Q._NAME}, '(.)\\.[^.]*$', '\\1')"


@query("F9_folder_name_hashes", f"""WITH {TREE_SQL}, {Q._ABOVE}, x AS (SELECT * FROM indirs WHERE depth <= 3),
 n AS (SELECT dir, count(*) AS n_files, sum(strlen({Q._NAME})) AS n_bytes FROM x GROUP BY dir),
 s AS (SELECT DISTINCT dir, {_STEM} AS name FROM x), f AS (SELECT DISTINCT dir, name FROM (SELECT dir, unnest(string_split(path, '/')[:-2]) AS name FROM x) WHERE name NOT IN ('', '.', '..')),
 a AS ({_simhash_sql(f"SELECT dir, {_WORDS.format(x='name')} FROM s", "dir")}), b AS ({_simhash_sql(f"SELECT dir, {_WORDS.format(x='name')} FROM f", "dir")})
SELECT n.dir, n_files, CASE WHEN n_files >= 8 AND n_bytes >= 32 THEN coalesce(a.simhash, 'ffffffffffffffff') END AS sim_hash_names, CASE WHEN n_files >= 8 AND n_bytes >= 32 THEN coalesce(b.simhash, 'ffffffffffffffff') END AS sim_hash_dir_names
FROM n LEFT JOIN a ON n.dir = a.dir LEFT JOIN b ON n.dir = b.dir""")
def _f9n(spark, d):
    return folders.folder_simhashes(I.tree(spark, d), depth=3).select("dir", "n_files", "sim_hash_names", "sim_hash_dir_names")
