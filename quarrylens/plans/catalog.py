"""Named queries over the driver's tables, and the SQL that gives the same rows.

Names begin with the identifiers of the operator inventory. Every query reads its whole tables. Codec queries that
SQL can't express, or only too slowly on whole tables, have no SQL and are held against loops in the tests.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.functions import columns as C
from quarrylens.functions import fixed_values as V
from quarrylens.functions import udfs
from quarrylens.operators import batching, dependencies, filters, fingerprints, folders, gitignore, merges, policies, reports, rollups, rules
from quarrylens.session import table
from quarrylens.sources import inputs as I
from quarrylens.sources import readers
from quarrylens.sources.inputs import COPYLEFT_SQL, DEPS_SQL, FILES_SQL, MATCHES_SQL, RULES_SQL, TREE_SQL

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents that snippets are made for."""
    return fingerprints.fingerprints(I.files(spark, sf_dir))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.component_rows(I.matches(spark, sf_dir))


def _all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).unionByName(rollups.dependency_rows(I.deps(spark, sf_dir)))


def _endings(name: str, endings: list[str]) -> str:
    return f"regexp_matches({name}, '{filters.endings_pattern(endings)}')"


_NAME = "regexp_extract(path, '[^/]*$')"
_LISTED_DIRS = ", ".join(f"'{d}'" for d in V.SKIPPED_DIRS)
_FOLDER_SKIPPED = f"""(len(list_filter(string_split(path, '/')[:-2], lambda d: (starts_with(d, '.') AND d <> '.') OR lower(d) IN ({_LISTED_DIRS}) OR ends_with(lower(d), '.egg-info'))) > 0)"""
_FILE_SKIPPED = f"""(len(list_filter(string_split(path, '/'), lambda d: starts_with(d, '.') AND d <> '.')) > 0
  OR lower({_NAME}) IN ({', '.join(repr(x) for x in V.SKIPPED_FILES)}) OR {_endings(f'lower({_NAME})', V.SKIPPED_ENDINGS)})"""
_SIZE_RULES = [(["*.py"], 200, 4000), (["*.rs", "*.go"], None, 2500), (["src1/**"], 1000, None)]
_SIZE_SQL = "size > 0 AND CASE " + " ".join(f"WHEN {gitignore.ignored_sql('lower(path)', p)} THEN size >= {a or 0}" + (f" AND size <= {b}" if b is not None else "") for p, a, b in _SIZE_RULES) + " ELSE true END"
_ELIGIBLE = rf"""NOT ({_endings('lower(path)', V.SNIPPETLESS_ENDINGS)} OR length(text) <= {V.MIN_SNIPPET_CHARS}
  OR regexp_matches(lower(regexp_replace(left(text, {V.MIN_SNIPPET_CHARS - 1}), '^\s+|\s+$', '', 'g')), '^(?:\{{|\[|<\?xml|<html|<ac3d|<!doc)')
  OR CASE WHEN strpos(text, chr(10)) > 0 THEN strpos(text, chr(10)) - 1 ELSE length(text) - 1 END > {V.MAX_FIRST_LINE})"""


# Filters


@query("C1_dir_skip", f"WITH {TREE_SQL} SELECT path, NOT {_FOLDER_SKIPPED} AS kept FROM tree")
def _c1(spark, d):
    return I.tree(spark, d).select("path", (~filters.folder_skipped(F.col("path"))).alias("kept"))


@query("C2_file_skip", f"WITH {TREE_SQL} SELECT path, NOT {_FILE_SKIPPED} AS kept FROM tree")
def _c2(spark, d):
    return I.tree(spark, d).select("path", (~filters.file_skipped(F.col("path"))).alias("kept"))


@query("C3_size_range", f"WITH {TREE_SQL} SELECT path, size, {_SIZE_SQL} AS kept FROM tree")
def _c3(spark, d):
    return I.tree(spark, d).select("path", "size", filters.size_kept(F.col("path"), F.col("size"), rules=_SIZE_RULES).alias("kept"))


@query("C4_gitignore", f"WITH {TREE_SQL} SELECT path, {gitignore.ignored_sql('path', I.PATTERNS)} AS ignored FROM tree")
def _c4(spark, d):
    return I.tree(spark, d).select("path", gitignore.ignored(F.col("path"), I.PATTERNS).alias("ignored"))


@query("A1_scanned_files", f"WITH {TREE_SQL} SELECT path, size FROM tree WHERE NOT {_FOLDER_SKIPPED} AND NOT {_FILE_SKIPPED} AND size > 0")
def _a1(spark, d):
    return filters.scanned_files(I.tree(spark, d)).select("path", "size")


_SCOPED = f"WITH {MATCHES_SQL}, {DEPS_SQL} SELECT path AS file, purl FROM deps WHERE "
_DEV = ", ".join(repr(x) for x in V.DEV_SCOPES)


def _deps_as_files(spark, d):
    return I.deps(spark, d).select(F.col("path").alias("file"), "purl", "scope")


@query("C5_dep_path_filter", _SCOPED + f"NOT {gitignore.ignored_sql('path', I.PATTERNS)}")
def _c5(spark, d):
    return dependencies.outside_patterns(_deps_as_files(spark, d).drop("scope"), I.PATTERNS)


@query("C6_scope_prod", _SCOPED + f"scope IS NULL OR scope NOT IN ({_DEV})")
def _c6p(spark, d):
    return dependencies.in_scope(_deps_as_files(spark, d), "prod")


@query("C6_scope_dev", _SCOPED + f"scope IN ({_DEV})")
def _c6d(spark, d):
    return dependencies.in_scope(_deps_as_files(spark, d), "dev")


@query("C6_scope_include", _SCOPED + "scope IN ('compile', 'dev')")
def _c6i(spark, d):
    return dependencies.in_scope(_deps_as_files(spark, d), include=["compile", "dev"])


@query("C6_scope_exclude", _SCOPED + "scope IS NULL OR scope NOT IN ('test')")
def _c6e(spark, d):
    return dependencies.in_scope(_deps_as_files(spark, d), "dev", exclude=["test"])


@query("C7_snippet_eligible", f"WITH {TREE_SQL} SELECT path, {_ELIGIBLE} AS eligible FROM tree")
def _c7(spark, d):
    return I.tree(spark, d).select("path", filters.snippets_made(F.col("path"), F.col("text")).alias("eligible"))


_PAGES_SQL = "pages_files AS (SELECT 'pages/' || page_id || '.page' AS path, coalesce(html, '') AS text FROM pages)"


@query("C7_snippet_eligible_pages", f"WITH {_PAGES_SQL} SELECT path, {_ELIGIBLE} AS eligible FROM pages_files")
def _c7p(spark, d):
    pages = table(spark, d, "pages").select(F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".page")).alias("path"), F.coalesce("html", F.lit("")).alias("text"))
    return pages.select("path", filters.snippets_made(F.col("path"), F.col("text")).alias("eligible"))


@query("C8_md5_skip", f"WITH {FILES_SQL} SELECT path FROM files WHERE md5(text) NOT IN (SELECT md5(text) FROM benchmark)")
def _c8(spark, d):
    known = table(spark, d, "benchmark").select(F.md5("text").alias("md5"))
    return I.files(spark, d).withColumn("md5", F.md5("text")).join(known, "md5", "left_anti").select("path")


@query("C10_results_filter", f"WITH {MATCHES_SQL} SELECT path AS file, status, id AS match_type, matched, coalesce(purl[1], 'N/A') AS purl, coalesce(licenses[1].name, 'N/A') AS license FROM matches WHERE match_ord = 0 AND id IN ('file', 'snippet') AND status = 'identified'")
def _c10(spark, d):
    return reports.result_rows(filters.results_filtered(reports.first_matches(I.matches(spark, d)), ["file", "snippet"], ["identified"]))


@query("P7_pending", f"WITH {MATCHES_SQL} SELECT path AS file, status, id AS match_type, matched, coalesce(purl[1], 'N/A') AS purl, coalesce(licenses[1].name, 'N/A') AS license FROM matches WHERE match_ord = 0 AND id IN ('file', 'snippet') AND status = 'pending'")
def _p7(spark, d):
    return reports.result_rows(filters.results_filtered(reports.first_matches(I.matches(spark, d)), ["file", "snippet"], ["pending"]))


@query("B7_results", f"WITH {MATCHES_SQL} SELECT path AS file, status, id AS match_type, matched, coalesce(purl[1], 'N/A') AS purl, coalesce(licenses[1].name, 'N/A') AS license FROM matches WHERE match_ord = 0")
def _b7(spark, d):
    return reports.result_rows(I.matches(spark, d))


@query("C12_path_prefix", f"WITH {FILES_SQL} SELECT path, path = 'src1/en' OR starts_with(path, 'src1/en/') AS ok FROM files")
def _c12(spark, d):
    return I.files(spark, d).select("path", filters.under(F.col("path"), F.lit("src1/en/")).alias("ok"))


_DELTA = "CASE doc_id % 4 WHEN 0 THEN '/' || source || '/a.c' WHEN 1 THEN source || '/../../x' WHEN 2 THEN './' || source || '/../ok.c' ELSE '../' || lang END"


@query("C13_delta_safe", f"SELECT {_DELTA} AS path, doc_id % 4 IN (0, 2) AS ok FROM documents")
def _c13(spark, d):
    return table(spark, d, "documents").select(F.expr(_DELTA.replace("'/' || source || '/a.c'", "concat('/', source, '/a.c')")).alias("path")).select("path", filters.delta_safe(F.col("path")).alias("ok"))


@query("C14_not_hidden", f"WITH {TREE_SQL} SELECT path FROM tree WHERE NOT starts_with({_NAME}, '.') AND size > 0")
def _c14(spark, d):
    return I.tree(spark, d).filter(~filters.file_name(F.col("path")).startswith(".") & (F.col("size") > 0)).select("path")


# Fingerprints and scalar functions


@query("D1_file_md5", f"WITH {FILES_SQL} SELECT path, md5(text) AS md5, size FROM files")
def _d1(spark, d):
    return I.files(spark, d).select("path", F.md5("text").alias("md5"), "size")


@query("D2_normalised_length", f"WITH {FILES_SQL} SELECT path, length(regexp_replace(text, '[^0-9A-Za-z]', '', 'g'))::INT AS n_norm, md5(lower(regexp_replace(text, '[^0-9A-Za-z]', '', 'g'))) AS md5_norm FROM files")
def _d2(spark, d):
    norm = C.normalised(F.col("text"))
    return I.files(spark, d).select("path", F.length(norm).alias("n_norm"), F.md5(norm).alias("md5_norm"))


@query("D3_winnow_udf")
def _d3(spark, d):
    return fingerprints.fingerprints(I.files(spark, d))


@query("B8_wfp_blocks")
def _b8(spark, d):
    return fingerprints.wfp_blocks(I.files(spark, d), hpsm=True)


_FH2_SQL = r"""CASE WHEN strpos({t}, chr(10)) = 0 AND strpos({t}, chr(13)) = 0 THEN NULL
  WHEN strpos({t}, chr(13) || chr(10)) > 0 AND strpos(replace({t}, chr(13) || chr(10), ''), chr(10)) = 0 AND strpos(replace({t}, chr(13) || chr(10), ''), chr(13)) = 0 THEN md5({unix})
  ELSE md5(replace({unix}, chr(10), chr(13) || chr(10))) END"""
_UNIX_SQL = "replace(replace({t}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_FH2_OF_TEXT = _FH2_SQL.format(t="text", unix=_UNIX_SQL.format(t="text"))
_HEAD_SQL = f"'file=' || md5(text) || ',' || size || ',' || path || chr(10) || coalesce('fh2=' || {_FH2_OF_TEXT} || chr(10), '')"


@query("B8_wfp_heads", f"WITH {TREE_SQL} SELECT path, {_HEAD_SQL} AS wfp FROM tree")
def _b8h(spark, d):
    return fingerprints.wfp_blocks(I.tree(spark, d), skip_snippets=True)


_LINE_SIZES = "lines AS (SELECT path, i AS line, strlen(l)::BIGINT + 1 AS size FROM (SELECT path, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM files))"


@query("D4_wfp_size_cap")
def _d4(spark, d):
    return fingerprints.capped_blocks(I.files(spark, d), 2048)


@query("D4_capped_lines", f"""WITH {FILES_SQL}, {_LINE_SIZES}, t AS (SELECT path, line, 60 + sum(size) OVER (PARTITION BY path ORDER BY line) - 1 AS total, lead(line) OVER (PARTITION BY path ORDER BY line) IS NULL AS is_last FROM lines)
SELECT path, count(*) AS n_lines_kept FROM t WHERE CASE WHEN is_last THEN total < 2048 ELSE total <= 2048 END GROUP BY path""")
def _d4l(spark, d):
    lines = I.files(spark, d).select("path", F.posexplode(F.split("text", "\n")).alias("line", "l")).select("path", "line", (F.octet_length("l") + 1).cast("long").alias("size"), F.lit(60).alias("head"))
    return batching.capped_lines(lines, 2048).groupBy("path").agg(F.count(F.lit(1)).alias("n_lines_kept"))


_EOL = "CASE file_ord % 4 WHEN 1 THEN replace(text, chr(10), chr(13) || chr(10)) WHEN 2 THEN replace(text, chr(10), chr(13)) ELSE text END"


@query("D5_fh2_opposite_eol", f"WITH {FILES_SQL}, e AS (SELECT path, {_EOL} AS t FROM files) SELECT path, {_FH2_SQL.format(t='t', unix=_UNIX_SQL.format(t='t'))} AS fh2 FROM e")
def _d5(spark, d):
    text = F.when(F.col("file_ord") % 4 == 1, F.replace("text", F.lit("\n"), F.lit("\r\n"))).when(F.col("file_ord") % 4 == 2, F.replace("text", F.lit("\n"), F.lit("\r"))).otherwise(F.col("text"))
    return I.files(spark, d).withColumn("text", text).select("path", C.opposite_eol_md5(F.col("text")).alias("fh2"))


@query("D6_hpsm_lines")
def _d6(spark, d):
    return I.files(spark, d).select("path", udfs.hpsm(F.encode("text", "UTF-8")).alias("hpsm"))


@query("D7_hpsm_strip")
def _d7(spark, d):
    hashes = udfs.hpsm(F.encode("text", "UTF-8"))
    return I.files(spark, d).select("path", udfs.stripped_hpsm(hashes, F.array(F.lit("ff"), F.lit("00a1"))).alias("value"))


@query("D8_snippet_strip")
def _d8(spark, d):
    return fingerprints.wfp_blocks(I.files(spark, d)).select("path", udfs.stripped_snippets(F.col("wfp"), F.array(F.lit("0000"), F.lit("ffff"))).alias("value"))


@query("D8_header_strip")
def _d8h(spark, d):
    return fingerprints.wfp_blocks(_with_header(I.files(spark, d)), skip_headers=True)


def _with_header(files: DataFrame) -> DataFrame:
    """Files with some lines of licence, comment and import at their start, by place."""
    head = F.when(F.col("file_ord") % 3 == 0, "# Copyright\n# All rights reserved\nimport os\n\n").when(F.col("file_ord") % 3 == 1, '"""Notes.\n\nmore\n"""\nfrom a import (\n  b,\n)\n').otherwise("")
    return files.withColumn("text", F.concat(head, "text"))


@query("D9_simhash_words")
def _d9(spark, d):
    return I.files(spark, d).select("path", F.lower(F.hex(udfs.simhash_words("text"))).alias("simhash"))


_HASHED = "SELECT doc_id, ('0x' || left(md5(coalesce(text, '')), 15))::BIGINT AS h FROM documents"


@query("D10_hamming_pairs", f"WITH h AS ({_HASHED}), p AS (SELECT doc_id, h, lag(h) OVER (ORDER BY doc_id) AS g, lag(doc_id) OVER (ORDER BY doc_id) AS other FROM h) SELECT other AS doc_a, doc_id AS doc_b, bit_count(xor(h, g))::INT AS distance FROM p WHERE other = doc_id - 1")
def _d10(spark, d):
    h = table(spark, d, "documents").select("doc_id", F.conv(F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 15), 16, 10).cast("long").alias("h"))
    before = h.select((F.col("doc_id") + 1).alias("doc_id"), F.col("doc_id").alias("doc_a"), F.col("h").alias("g"))
    return h.join(before, "doc_id").select("doc_a", F.col("doc_id").alias("doc_b"), C.hamming(F.col("h"), F.col("g")).alias("distance"))


_FEATURES = r"regexp_extract_all(lower(text), '([A-Za-z0-9_'']+(?:://[A-Za-z0-9_./]+)?)')"


@query("D11_word_features", f"WITH {FILES_SQL}, w AS (SELECT path, unnest({_FEATURES}) AS feature FROM files) SELECT path, feature, count(*) AS n FROM w GROUP BY path, feature")
def _d11(spark, d):
    return I.files(spark, d).select("path", F.explode(C.word_features(F.col("text"))).alias("feature")).groupBy("path", "feature").agg(F.count(F.lit(1)).alias("n"))


@query("D11_shingles")
def _d11s(spark, d):
    return I.files(spark, d).select("path", F.size(F.array_distinct(C.shingles(C.word_features(F.col("text")), 3))).alias("n_shingles"))


_SQL["D11_shingles"] = f"""WITH {FILES_SQL}, w AS (SELECT path, {_FEATURES} AS w FROM files),
s AS (SELECT path, CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + least(3, len(w)) - 1], ' ')) END AS s FROM w)
SELECT path, len(list_distinct(s))::INT AS n_shingles FROM s"""


@query("D12_header_offset")
def _d12(spark, d):
    return I.tree(spark, d).select("path", udfs.header_offset("path", "text").alias("header_offset"))


@query("D13_obfuscated_names", f"WITH {FILES_SQL} SELECT row_number() OVER (ORDER BY file_ord) || '.py' AS obf, path FROM files")
def _d13(spark, d):
    rows = reports.numbered(I.files(spark, d).select("file_ord", "path"), ["file_ord"], "number")
    return rows.select(F.concat(F.col("number").cast("string"), C.suffix(F.col("path"))).alias("obf"), "path")


@query("J9_deobfuscated", f"WITH {FILES_SQL}, o AS (SELECT row_number() OVER (ORDER BY file_ord) || '.py' AS obf, path FROM files), k AS (SELECT doc_id || '.py' AS obf FROM documents) SELECT k.obf, coalesce(o.path, k.obf) AS path FROM k LEFT JOIN o ON k.obf = o.obf")
def _j9(spark, d):
    keys = table(spark, d, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".py")).alias("obf"))
    return keys.join(_d13(spark, d), "obf", "left").select("obf", F.coalesce("path", "obf").alias("path"))


@query("D15_crc64")
def _d15(spark, d):
    return I.files(spark, d).select("path", F.lpad(F.lower(F.hex(udfs.crc64(F.encode("text", "UTF-8")))), 16, "0").alias("crc"))


@query("D14_crc32c")
def _d14(spark, d):
    return I.files(spark, d).select("path", F.lpad(F.lower(F.hex(udfs.crc32c(F.encode("text", "UTF-8")))), 8, "0").alias("crc"))


@query("D17_line_ranges", f"WITH {MATCHES_SQL}, n AS (SELECT path, match_ord, list_transform(list_filter(regexp_split_to_array(lines, '[,-]'), lambda x: regexp_matches(x, '^[0-9]+$')), lambda x: x::INT) AS n FROM matches) SELECT path, match_ord, n[1]::VARCHAR AS first_line, n[-1]::VARCHAR AS last_line, len(n)::INT AS n_numbers FROM n")
def _d17(spark, d):
    n = C.line_numbers(F.col("lines"))
    return I.matches(spark, d).select("path", "match_ord", F.try_element_at(n, F.lit(1)).cast("string").alias("first_line"), F.try_element_at(n, F.lit(-1)).cast("string").alias("last_line"), F.size(n).alias("n_numbers"))


@query("D18_purl_parts", f"""WITH {MATCHES_SQL}, p AS (SELECT DISTINCT purl[1] || '@' || version AS purl FROM matches WHERE len(purl) > 0), b AS (SELECT purl, string_split(regexp_replace(regexp_replace(purl, '^pkg:/*', ''), '[?#@].*$', ''), '/') AS x FROM p)
SELECT purl, string_split(purl, '@')[1] AS base, string_split(purl, '@')[-1] AS version, lower(x[1]) AS kind, url_decode(array_to_string(x[2:-2], '/')) AS namespace, url_decode(x[-1]) AS name,
 CASE lower(x[1]) WHEN 'github' THEN 'https://github.com/' || url_decode(array_to_string(x[2:], '/')) WHEN 'npm' THEN 'https://www.npmjs.com/package/' || url_decode(array_to_string(x[2:], '/')) END AS url FROM b""")
def _d18(spark, d):
    p = I.matches(spark, d).filter("size(purl) > 0").select(F.concat_ws("@", F.element_at("purl", 1), "version").alias("purl")).distinct()
    c = F.col("purl")
    return p.select("purl", C.purl_base(c).alias("base"), C.purl_version(c).alias("version"), C.purl_part(c, "type").alias("kind"), C.purl_part(c, "namespace").alias("namespace"), C.purl_part(c, "name").alias("name"), C.purl_url(c).alias("url"))


@query("D19_requirement", rf"""WITH {MATCHES_SQL}, {DEPS_SQL}, r AS (SELECT path, dep_ord, '"' || purl || '%22' AS raw, replace(replace('"' || purl || '%22', '"', ''), '%22', '') AS purl, regexp_replace(requirement, '^\s*[^<>=!^]+\s*([<>=!^])', '\1') AS bare FROM deps)
SELECT path, dep_ord, purl, CASE WHEN bare <> '' AND NOT ends_with(purl, bare) AND NOT starts_with(bare, 'file:') THEN bare END AS requirement FROM r""")
def _d19(spark, d):
    raw = F.concat(F.lit('"'), F.col("purl"), F.lit("%22"))
    return I.deps(spark, d).select("path", "dep_ord", C.clean_purl(raw).alias("purl"), C.clean_requirement(raw, F.col("requirement")).alias("requirement"))


_SEVERITY = "CASE doc_id % 6 WHEN 0 THEN 'Moderate' WHEN 1 THEN 'HIGH' WHEN 2 THEN NULL WHEN 3 THEN 'low' WHEN 4 THEN 'strange' ELSE 'Critical' END"


@query("D21_severity", f"SELECT doc_id, CASE WHEN lower(s) = 'moderate' THEN 'medium' WHEN lower(s) IN ('critical', 'high', 'medium', 'low', 'info', 'none') THEN lower(s) ELSE 'unknown' END AS severity FROM (SELECT doc_id, {_SEVERITY} AS s FROM documents)")
def _d21(spark, d):
    return table(spark, d, "documents").select("doc_id", C.severity(F.expr(_SEVERITY)).alias("severity"))


@query("D22_spdx_url", f"WITH {MATCHES_SQL} SELECT DISTINCT l.name AS spdxid, 'https://spdx.org/licenses/' || l.name || '.html' AS url FROM (SELECT unnest(licenses) AS l FROM matches)")
def _d22(spark, d):
    names = I.matches(spark, d).select(F.explode("licenses").alias("l")).select(F.col("l.name").alias("spdxid")).distinct()
    return names.select("spdxid", C.spdx_url(F.col("spdxid")).alias("url"))


# Ids and names of some licences of the public SPDX list.
_KNOWN = [("MIT", "MIT License"), ("GPL-2.0-only", "GNU General Public License v2.0 only"), ("Apache-2.0", "Apache License 2.0"), ("BSD-2-Clause", 'BSD 2-Clause "Simplified" License')]


def _known_licenses(spark):
    document = json.dumps({"licenses": [{"licenseId": i, "name": n} for i, n in _KNOWN]})
    return readers.parsed_spdx_list(spark.createDataFrame([(document,)], "value string"), F.col("value"))


_BARE, _DASHED = (rf"lower(regexp_replace(name, '\s+', '{by}', 'g'))" for by in ("", "-"))
#: The list by ids (whole and short ones) and by names, and the four steps of a look-up of ``name``.
_LOOKUP = rf"""k AS (SELECT * FROM {I.values([(place, i.lower(), i, n) for place, (i, n) in enumerate(_KNOWN)], 'place, spdx_key, spdx_name, name')}),
by_id AS (SELECT key, coalesce(arg_max(spdx_name, place) FILTER (whole), arg_min(spdx_name, place)) AS found FROM (SELECT place, spdx_key AS key, spdx_name, true AS whole FROM k UNION ALL SELECT place, split_part(spdx_key, '-', 1), spdx_name, false FROM k WHERE contains(spdx_key, '-')) GROUP BY key),
by_name AS (SELECT {_BARE} AS key, arg_max(spdx_name, place) AS found FROM k GROUP BY 1)"""
_STEPS = f"LEFT JOIN by_id i0 ON {_BARE} = i0.key LEFT JOIN by_id i1 ON {_DASHED} = i1.key LEFT JOIN by_name m0 ON {_BARE} = m0.key LEFT JOIN by_name m1 ON {_DASHED} = m1.key"
_FOUND = "coalesce(i0.found, i1.found, m0.found, m1.found, CASE WHEN starts_with(name, 'LicenseRef') THEN '' ELSE 'LicenseRef-' END || replace(name, ' ', '-'))"

#: Licences of matches as people spell them: as they are, with blanks in ids, by short ids, by names, and by names that no list has.
_SPELLED = ["replace(name, '-', '- ')", "replace(name, '-', ' ')", "lower(split_part(name, '-', 1))", "'Apache License  2.0'", "'BSD 2-Clause \"Simplified\" License'", "'LicenseRef-own form'", "'Some Other Licence'"]
_SPELL = "CASE file_ord % 8 " + " ".join(f"WHEN {k} THEN {e}" for k, e in enumerate(_SPELLED)) + " ELSE name END"


@query("D20_license_id", f"WITH {MATCHES_SQL}, {_LOOKUP}, n AS (SELECT path, match_ord, {_SPELL} AS name FROM (SELECT file_ord, path, match_ord, unnest(licenses).name AS name FROM matches)) SELECT path, match_ord, name, {_FOUND} AS spdxid FROM n {_STEPS}")
def _d20(spark, d):
    names = I.matches(spark, d).select("file_ord", "path", "match_ord", F.explode(F.transform("licenses", lambda x: x["name"])).alias("name"))
    return reports.spdx_licenses(names.withColumn("name", F.expr(_SPELL)), _known_licenses(spark)).select("path", "match_ord", "name", "spdxid")


@query("D23_copyleft_flag", f"""WITH {MATCHES_SQL}, {COPYLEFT_SQL}, n AS (SELECT DISTINCT l.name AS spdxid FROM (SELECT unnest(licenses) AS l FROM matches))
SELECT spdxid, coalesce(listed_copyleft, false) AS by_table, lower(spdxid) IN ('mit') AS explicit, CASE WHEN lower(spdxid) = 'mit' THEN true ELSE coalesce(listed_copyleft, false) END AS included, CASE WHEN lower(spdxid) = 'gpl-2.0-only' THEN false ELSE coalesce(listed_copyleft, false) END AS excluded FROM n LEFT JOIN copyleft ON lower(spdxid) = license_key""")
def _d23(spark, d):
    rows = _d22(spark, d).join(I.copyleft_table(spark), F.lower("spdxid") == F.col("license_key"), "left")
    flag = lambda **k: C.copyleft(F.col("spdxid"), F.col("listed_copyleft"), **k)
    return rows.select("spdxid", flag().alias("by_table"), flag(explicit=["MIT"]).alias("explicit"), flag(include=["MIT"]).alias("included"), flag(exclude=["GPL-2.0-only"]).alias("excluded"))


@query("D24_suffix", f"WITH {TREE_SQL} SELECT path, regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1) AS suffix FROM tree")
def _d24(spark, d):
    return I.tree(spark, d).select("path", C.suffix(F.col("path")).alias("suffix"))


@query("D26_settings_header", "SELECT doc_id, base64(encode('{\"min_snippet_hits\":' || (doc_id % 7) || ',\"ranking\":' || CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END || '}')) AS header FROM documents")
def _d26(spark, d):
    settings = F.struct((F.col("doc_id") % 7).alias("min_snippet_hits"), (F.col("doc_id") % 2 == 0).alias("ranking"))
    return table(spark, d, "documents").select("doc_id", C.settings_header(settings).alias("header"))


@query("D28_project_fresh", "SELECT doc_id, CASE WHEN a > 0 AND a <= c AND n < 1 THEN true WHEN a = 0 OR b = 0 OR c = 0 THEN false ELSE b >= a AND c >= a END AS fresh FROM (SELECT doc_id, doc_id % 5 AS a, doc_id % 7 AS b, doc_id % 6 AS c, doc_id % 3 AS n FROM documents)")
def _d28(spark, d):
    x = F.col("doc_id")
    return table(spark, d, "documents").select("doc_id", C.project_fresh(x % 5, x % 7, x % 6, x % 3).alias("fresh"))


@query("D29_epoch_ms", "SELECT event_id, strftime(ts, '%d %b %Y at %H:%M:%S') AS text FROM events")
def _d29(spark, d):
    return table(spark, d, "events").select("event_id", C.epoch_ms_text(F.unix_millis(F.col("ts").cast("timestamp"))).alias("text"))


# Flattening and reports


@query("E1_first_match", f"WITH {MATCHES_SQL} SELECT path AS filename, id, status FROM matches WHERE match_ord = 0")
def _e1(spark, d):
    return reports.first_matches(I.matches(spark, d)).select(F.col("path").alias("filename"), "id", "status")


def _inventory(spark, d):
    docs = I.files(spark, d).select("file_ord", "path")
    return docs.select(F.from_json(F.expr(_inventory_expr()), dependencies.INVENTORY).alias("x")).select("x.files")


def _inventory_expr() -> str:
    return """concat('{"files":[{"path":"', path, '","type":"', CASE WHEN file_ord % 4 = 3 THEN 'directory' ELSE 'file' END,
  '","packages":[{"dependencies":[{"purl":"pkg:npm/a', CAST(file_ord % 9 AS STRING), '@1.0","requirement":"a>=1.0","scope":"dev"}]}],"package_data":',
  CASE WHEN file_ord % 2 = 0 THEN '[]' ELSE concat('[{"dependencies":[{"purl":"pkg:pypi/b%22","extracted_requirement":"b==2.', CAST(file_ord % 3 AS STRING), '","scope":""},{"purl":"pkg:pypi/c@3","requirement":"3"}]}]') END, '}]}')"""


_FLAT = f"""WITH {FILES_SQL}, flat AS (
 SELECT path AS file, 'pkg:npm/a' || (file_ord % 9) || '@1.0' AS purl, '>=1.0' AS requirement, 'dev' AS scope FROM files WHERE file_ord % 4 <> 3 AND file_ord % 2 = 0
 UNION ALL SELECT path, 'pkg:pypi/b', '==2.' || (file_ord % 3), NULL FROM files WHERE file_ord % 4 <> 3 AND file_ord % 2 = 1
 UNION ALL SELECT path, 'pkg:pypi/c@3', NULL, NULL FROM files WHERE file_ord % 4 <> 3 AND file_ord % 2 = 1)"""


@query("E2_dep_flatten", _FLAT + " SELECT file, purl, requirement, scope FROM flat")
def _e2(spark, d):
    return dependencies.flattened(_inventory(spark, d)).drop("dep_ord")


@query("E3_scope_drop", _FLAT + " SELECT file, purl, requirement FROM flat")
def _e3(spark, d):
    files = dependencies.without_scopes(dependencies.grouped(dependencies.flattened(_inventory(spark, d))))
    return files.select("file", F.explode("purls").alias("p")).select("file", "p.purl", "p.requirement")


_CSV_SQL = f"""WITH {MATCHES_SQL}, {DEPS_SQL}, r AS (
 SELECT file_ord, match_ord, -1 AS dep_ord, path, id AS detected_usage, component AS detected_component,
  array_to_string(list_filter(list_transform(licenses, lambda x: x.name), lambda n, i: list_position(list_transform(licenses, lambda x: x.name), n) = i), ';') AS detected_license,
  version AS detected_version, latest AS detected_latest, array_to_string(purl, ';') AS detected_purls, url AS detected_url, matched AS detected_match, replace(lines, ',', ';') AS detected_lines, replace(oss_lines, ',', ';') AS detected_oss_lines, file AS detected_path
 FROM matches WHERE id NOT IN ('none', 'dependency') AND len(purl) > 0
 UNION ALL
 SELECT d.file_ord, m.match_ord, d.dep_ord, d.path, m.id, d.component, coalesce(d.license, ''), d.version, '', d.purl, '', m.matched, replace(m.lines, ',', ';'), replace(m.oss_lines, ',', ';'), ''
 FROM deps d JOIN matches m ON d.file_ord = m.file_ord AND m.id = 'dependency')
SELECT row_number() OVER (ORDER BY file_ord, match_ord, dep_ord) AS inventory_id, * EXCLUDE (file_ord, match_ord, dep_ord) FROM r"""


@query("E5_csv_rows", _CSV_SQL)
def _e5(spark, d):
    return reports.csv_rows(I.matches(spark, d), I.deps(spark, d))


_SIGHTED = f"""{MATCHES_SQL}, {DEPS_SQL}, sighted AS (
 SELECT file_ord, match_ord, -1 AS dep_ord, purl[1] AS purl, component, version, licenses FROM matches WHERE id NOT IN ('none', 'dependency') AND len(purl) > 0
 UNION ALL SELECT file_ord, 0, dep_ord, purl, component, version, CASE WHEN license IS NULL THEN [] ELSE [{{name: license, source: NULL::VARCHAR}}] END FROM deps),
firsts AS (SELECT * FROM sighted QUALIFY row_number() OVER (PARTITION BY purl ORDER BY file_ord, match_ord, dep_ord) = 1)"""
_LISTED = "x.source IN ('component_declared', 'license_file', 'file_header')"


@query("E6_cdx_components", f"WITH {_SIGHTED} SELECT purl, component, version, array_to_string(list_sort(list_distinct(list_transform(list_filter(licenses, lambda x: CASE WHEN dep_ord >= 0 THEN true ELSE coalesce({_LISTED}, false) END), lambda x: x.name))), ',') AS licenses FROM firsts")
def _e6(spark, d):
    return reports.cyclonedx_components(I.matches(spark, d), I.deps(spark, d))


_SPDX = f"""WITH {_SIGHTED}, {_LOOKUP},
n AS (SELECT purl, version, unnest(list_distinct(list_transform(list_filter(licenses, lambda x: x.source IS NULL OR {_LISTED}), lambda x: x.name))) AS name FROM firsts),
i AS (SELECT purl, list_sort(list_distinct(list({_FOUND}))) AS ids FROM n {_STEPS} GROUP BY purl),
p AS (SELECT f.purl, 'SPDXRef-' || md5(f.purl || '@' || f.version) AS spdx_id, CASE WHEN ids IS NULL THEN 'NOASSERTION' WHEN len(ids) = 1 THEN ids[1] ELSE '(' || array_to_string(ids, ' AND ') || ')' END AS license FROM firsts f LEFT JOIN i ON f.purl = i.purl)"""


def _spdx(spark, d):
    return reports.spdx_packages(I.matches(spark, d), I.deps(spark, d), _known_licenses(spark))


@query("E7_spdx_packages", _SPDX + " SELECT purl, spdx_id, license FROM p")
def _e7(spark, d):
    return _spdx(spark, d).select("purl", "spdx_id", "license")


@query("E7_license_refs", _SPDX + " SELECT DISTINCT license_ref FROM (SELECT unnest(string_split(replace(replace(license, '(', ''), ')', ''), ' AND ')) AS license_ref FROM p) WHERE license_ref LIKE 'LicenseRef-%'")
def _e7r(spark, d):
    return reports.license_references(_spdx(spark, d))


_VULN_ID = "CASE WHEN file_ord % 4 = 0 THEN 'CPE:2.3:a' WHEN file_ord % 4 = 1 THEN 'GHSA-' || CAST(file_ord % 7 AS {T}) WHEN file_ord % 4 = 2 THEN '' ELSE 'CVE-1-' || CAST(file_ord % 5 AS {T}) END"
_CVE = "CASE WHEN file_ord % 8 = 0 THEN NULL ELSE 'CVE-2-' || CAST(file_ord % 3 AS {T}) END"
_SEVERITY2 = "CASE file_ord % 3 WHEN 0 THEN 'Moderate' WHEN 1 THEN 'high' ELSE NULL END"


@query("E6_cdx_vulns", f"""WITH {MATCHES_SQL}, v AS (SELECT file_ord, match_ord, purl[1] AS purl, {_VULN_ID.format(T='VARCHAR')} AS vid, {_CVE.format(T='VARCHAR')} AS cve, {_SEVERITY2} AS s, CASE WHEN file_ord % 2 = 0 THEN 'nvd' ELSE 'github' END AS source FROM matches WHERE len(purl) > 0),
n AS (SELECT *, CASE WHEN starts_with(upper(vid), 'CPE:') THEN cve ELSE vid END AS vuln FROM v), f AS (SELECT * FROM n WHERE coalesce(vuln, '') <> '')
SELECT vuln AS vuln_id, CASE WHEN lower(x.s) = 'moderate' THEN 'medium' WHEN lower(x.s) = 'high' THEN 'high' ELSE 'unknown' END AS severity, CASE WHEN x.source = 'nvd' THEN 'NVD' ELSE 'GitHub Advisories' END AS source, n_affects, affects
FROM (SELECT vuln, min({{file_ord: file_ord, match_ord: match_ord, s: s, source: source}}) AS x, count(DISTINCT purl) AS n_affects, array_to_string(list_sort(list_distinct(list(purl))), ',') AS affects FROM f GROUP BY vuln)""")
def _e6v(spark, d):
    rows = I.matches(spark, d).filter("size(purl) > 0").select(
        F.struct("file_ord", "match_ord").alias("place"), F.element_at("purl", 1).alias("purl"), F.expr(_VULN_ID.format(T="STRING")).alias("vuln_id"), F.expr(_CVE.format(T="STRING")).alias("cve"), F.expr(_SEVERITY2).alias("severity"),
        F.when(F.col("file_ord") % 2 == 0, "nvd").otherwise("github").alias("source"),
    )
    return reports.vulnerabilities(rows).select("vuln_id", "severity", "source", F.size("affects").cast("long").alias("n_affects"), F.array_join("affects", ",").alias("affects"))


@query("E8_vuln_append", """WITH e AS (SELECT 'CVE-' || (doc_id % 7) AS vuln_id, 'high' AS severity, 'NVD' AS source, 'pkg:a/' || source AS purl, 0 AS part FROM documents WHERE lang = 'en'),
a AS (SELECT CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN 'cpe:2.3' ELSE 'CVE-' || (doc_id % 11) END AS vuln_id, CASE WHEN doc_id % 2 = 0 THEN 'medium' ELSE 'unknown' END AS severity, 'GitHub Advisories' AS source, 'pkg:b/' || source AS purl, 1 AS part FROM documents),
u AS (SELECT * FROM e UNION ALL SELECT * FROM a WHERE vuln_id <> '' AND NOT starts_with(upper(vuln_id), 'CPE:'))
SELECT vuln_id, x.severity AS severity, x.source AS source, affects FROM (SELECT vuln_id, min({part: part, severity: severity, source: source}) AS x, array_to_string(list_sort(list_distinct(list(purl))), ',') AS affects FROM u GROUP BY vuln_id)""")
def _e8(spark, d):
    docs = table(spark, d, "documents")
    known = docs.filter("lang = 'en'").groupBy(F.concat(F.lit("CVE-"), (F.col("doc_id") % 7).cast("string")).alias("vuln_id")).agg(F.collect_set(F.concat(F.lit("pkg:a/"), "source")).alias("affects"))
    known = known.select("vuln_id", F.lit("high").alias("severity"), F.lit("NVD").alias("source"), "affects")
    ident = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 == 1, "cpe:2.3").otherwise(F.concat(F.lit("CVE-"), (F.col("doc_id") % 11).cast("string")))
    answers = docs.select(F.concat(F.lit("pkg:b/"), "source").alias("purl"), ident.alias("vuln_id"), F.when(F.col("doc_id") % 2 == 0, "Moderate").alias("severity"), F.lit("GitHub Advisories").alias("source"))
    return reports.appended_vulnerabilities(known, answers).withColumn("affects", F.array_join("affects", ","))


@query("B5_codequality", f"WITH {MATCHES_SQL} SELECT path, CASE id WHEN 'file' THEN 'File' ELSE 'Snippet' END || ' match found in: ' || url AS description, 'scan' AS check_name, file_hash AS fingerprint, 'info' AS severity, CASE WHEN id = 'snippet' THEN TRY_CAST(regexp_split_to_array(lines, '[,-]')[1] AS INT) ELSE 1 END AS begin FROM matches WHERE id IN ('file', 'snippet')")
def _b5(spark, d):
    return reports.code_quality(I.matches(spark, d))


_LAST = "regexp_split_to_array(lines, '[,-]')"


@query("E13_match_items", f"""WITH {MATCHES_SQL} SELECT file_ord, match_ord, path, CASE WHEN id = 'snippet' THEN 'snippet' ELSE 'file' END AS kind, CASE WHEN id = 'snippet' THEN path || '#L' || {_LAST}[1] || '-L' || {_LAST}[-1] ELSE path END AS file_url,
 CASE WHEN id = 'snippet' THEN {_LAST}[1] || '-' || {_LAST}[-1] ELSE 'all' END AS lines, licenses[1].name AS license, matched AS similarity, purl[1] AS purl FROM matches WHERE id NOT IN ('none', 'dependency') AND status IS NOT NULL AND len(purl) > 0""")
def _e13(spark, d):
    return reports.match_items(I.matches(spark, d))


@query("P5_match_summary", f"WITH {MATCHES_SQL} SELECT CASE WHEN id = 'snippet' THEN 'snippet' ELSE 'file' END AS kind, count(*) AS n FROM matches WHERE id NOT IN ('none', 'dependency') AND len(purl) > 0 GROUP BY ALL")
def _p5(spark, d):
    return reports.match_items(I.matches(spark, d)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _folder_answers(spark, d):
    """One answer per folder and document: only some have a component of order 1 with a version."""
    rows = I.files(spark, d).select(F.col("file_ord").alias("answer_ord"), F.regexp_replace("path", "/[^/]*$", "").alias("path_id"), F.col("path"))
    licenses = F.array(F.struct(F.lit("MIT").alias("name"), F.lit("MIT").alias("spdx_id")))
    version = F.struct(F.concat(F.lit("v"), (F.col("answer_ord") % 4).cast("string")).alias("version"), licenses.alias("licenses"))
    versions = F.when(F.col("answer_ord") % 5 == 0, F.array()).otherwise(F.array(version))
    component = lambda order, name: F.struct(F.concat(F.lit("pkg:github/org/"), name).alias("purl"), name.alias("name"), F.lit("org").alias("vendor"), order.cast("int").alias("order"), versions.alias("versions"))
    return rows.select("answer_ord", "path_id", F.array(component(F.lit(2), F.lit("second")), component(F.when(F.col("answer_ord") % 3 == 0, 3).otherwise(1), F.concat(F.lit("lib"), (F.col("answer_ord") % 6).cast("string")))).alias("components"))


_BEST = f"""WITH {FILES_SQL}, a AS (SELECT file_ord, regexp_replace(path, '/[^/]*$', '') AS path_id FROM files),
best AS (SELECT path_id, max(file_ord) AS o FROM a WHERE file_ord % 5 <> 0 AND file_ord % 3 <> 0 GROUP BY path_id)"""


@query("E9_best_component", _BEST + " SELECT path_id, 'pkg:github/org/lib' || (o % 6) AS purl, 'lib' || (o % 6) AS name, 'org' AS vendor, 'v' || (o % 4) AS version FROM best")
def _e9(spark, d):
    return reports.best_components(_folder_answers(spark, d)).drop("licenses")


@query("E10_hfh_entries", _BEST + " SELECT f.path, 'file' AS id, '100%' AS matched, 'pending' AS status, 'pkg:github/org/lib' || (o % 6) AS purl, 'lib' || (o % 6) AS component, 'v' || (o % 4) AS version, 'https://github.com/org/lib' || (o % 6) AS url, md5(f.text) AS file_hash, md5(f.text) AS source_hash FROM files f JOIN best b ON regexp_replace(f.path, '/[^/]*$', '') = b.path_id")
def _e10(spark, d):
    files, best = I.files(spark, d), reports.best_components(_folder_answers(spark, d))
    return reports.folder_entries(rules.deepest_claims(files, best), best, files)


@query("E12_container_purls", "SELECT 'pkg:deb/debian/' || source AS purl, source || '-' || min(doc_id) AS name, min(doc_id) AS first_ord FROM documents GROUP BY source")
def _e12(spark, d):
    rows = table(spark, d, "documents").select(F.concat(F.lit("pkg:deb/debian/"), "source").alias("purl"), F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("name"), "doc_id")
    first = rows.groupBy("purl").agg(F.min(F.struct("doc_id", "name")).alias("x"))
    return first.select("purl", "x.name", F.col("x.doc_id").alias("first_ord"))


# Rules


def _best_sql(kind: str, only_first: bool = False) -> str:
    return f"""best AS (SELECT * FROM (
 SELECT m.*, r.rule_ord, r.replace_with, r.license AS rule_license, row_number() OVER (PARTITION BY m.file_ord, m.match_ord ORDER BY
   CASE WHEN coalesce(r.purl, '') <> '' AND coalesce(rtrim(r.path, '/'), '') <> '' THEN 4 WHEN coalesce(r.purl, '') <> '' THEN 2 ELSE 1 END DESC, length(coalesce(rtrim(r.path, '/'), '')) DESC, r.rule_ord) AS rn
 FROM matches m JOIN rules r ON r.kind = '{kind}' AND (coalesce(r.purl, '') <> '' OR coalesce(rtrim(r.path, '/'), '') <> '') AND (coalesce(r.purl, '') = '' OR list_contains(m.purl, r.purl))
   AND (coalesce(rtrim(r.path, '/'), '') = '' OR m.path = rtrim(r.path, '/') OR starts_with(m.path, rtrim(r.path, '/') || '/'))
 {'WHERE m.match_ord = 0' if only_first else ''}) WHERE rn = 1)"""


_RULED = f"WITH {MATCHES_SQL}, {RULES_SQL}, "


@query("J1_rule_best_match", _RULED + _best_sql("include") + " SELECT path, match_ord, rule_ord FROM best")
def _j1(spark, d):
    return rules.best_rules(I.matches(spark, d), I.rules(spark, "include")).select("path", "match_ord", "rule_ord")


@query("J2_removed", _RULED + _best_sql("remove", True) + " SELECT path, match_ord FROM matches WHERE file_ord NOT IN (SELECT file_ord FROM best)")
def _j2(spark, d):
    return rules.without_removed(I.matches(spark, d), I.rules(spark, "remove")).select("path", "match_ord")


_MAP = "cmap AS (SELECT map_purl, arg_max({component: component, version: version, latest: latest, url: url}, file_ord) AS entry FROM (SELECT unnest(purl) AS map_purl, component, version, latest, url, file_ord FROM matches WHERE match_ord = 0) GROUP BY map_purl)"


@query("J4_component_map", f"WITH {MATCHES_SQL}, {_MAP} SELECT map_purl, entry.component AS component, entry.version AS version, entry.latest AS latest, entry.url AS url FROM cmap")
def _j4(spark, d):
    return rules.component_map(I.matches(spark, d)).select("map_purl", "entry.*")


_REMOVED_FIRST = _best_sql("remove", True).replace("best AS", "gone AS", 1)


@query("J3_replaced", _RULED + _best_sql("replace", True) + f""", {_REMOVED_FIRST}, {_MAP}
SELECT b.file_ord, b.path, b.replace_with AS new_purl, coalesce(c.entry.component, regexp_extract(b.replace_with, '[^/]*$')) AS component, coalesce(c.entry.version, '') AS version,
 coalesce(c.entry.url, CASE WHEN starts_with(b.replace_with, 'pkg:github/') THEN 'https://github.com/' || substr(b.replace_with, 12) ELSE 'https://www.npmjs.com/package/' || substr(b.replace_with, 9) END) AS url,
 'identified' AS status, b.rule_license AS license_override
FROM best b LEFT JOIN cmap c ON c.map_purl = b.replace_with WHERE b.file_ord NOT IN (SELECT file_ord FROM gone)""")
def _j3(spark, d):
    matches = I.matches(spark, d)
    left = rules.without_removed(matches, I.rules(spark, "remove"))
    return rules.replaced(left, I.rules(spark, "replace"), rules.component_map(matches))


_CONTEXT_SQL = f"""WITH {FILES_SQL}, {RULES_SQL}, s AS (
 SELECT f.file_ord, CASE WHEN kind = 'replace' THEN replace_with ELSE purl END AS p, CASE kind WHEN 'include' THEN 0 WHEN 'replace' THEN 1 ELSE 2 END AS part, r.rule_ord,
  CASE WHEN coalesce(r.path, '') <> '' THEN 4 + length(rtrim(r.path, '/')) ELSE 2 END AS score
 FROM files f JOIN rules r ON r.kind IN ('include', 'replace', 'exclude') AND (coalesce(r.path, '') = '' OR f.path = rtrim(r.path, '/') OR starts_with(f.path, rtrim(r.path, '/') || '/'))),
b AS (SELECT file_ord, p, part, min({{score: -score, rule_ord: rule_ord}}) AS rank FROM s WHERE coalesce(p, '') <> '' GROUP BY ALL),
l AS (SELECT file_ord, list({{part: part, rank: rank, p: p}} ORDER BY part, rank, p) AS found FROM b GROUP BY file_ord),
n AS (SELECT f.file_ord, f.path, list_transform(list_filter(found, lambda x: x.part < 2), lambda x: x.p) AS i, list_transform(list_filter(found, lambda x: x.part = 2), lambda x: x.p) AS e FROM files f LEFT JOIN l ON f.file_ord = l.file_ord)
SELECT file_ord, path, array_to_string(list_filter(c, lambda x, k: list_position(c, x) = k), ',') AS purls, scan_type FROM (
 SELECT file_ord, path, CASE WHEN len(i) > 0 THEN i WHEN len(e) > 0 THEN e ELSE []::VARCHAR[] END AS c, CASE WHEN len(i) > 0 THEN 'identify' WHEN len(e) > 0 THEN 'blacklist' END AS scan_type FROM n)"""


@query("J5_sbom_context", _CONTEXT_SQL)
def _j5(spark, d):
    found = rules.sbom_contexts(I.files(spark, d), I.rules(spark, "include"), I.rules(spark, "replace"), I.rules(spark, "exclude"))
    return found.withColumn("purls", F.array_join("purls", ","))


@query("J6_license_decoration", f"WITH {MATCHES_SQL}, k AS (SELECT 'pkg:github/org/' || source AS purl, 'v1' AS version, source AS license FROM documents GROUP BY source) SELECT m.path, m.match_ord, coalesce(k.license, '') AS license FROM matches m LEFT JOIN k ON m.purl[1] || '@' || m.version = k.purl || '@' || k.version")
def _j6(spark, d):
    known = table(spark, d, "documents").select(F.concat(F.lit("pkg:github/org/"), "source", F.lit("@v1")).alias("key"), F.col("source").alias("license")).distinct()
    rows = I.matches(spark, d).select("path", "match_ord", F.concat(F.try_element_at("purl", F.lit(1)), F.lit("@"), "version").alias("key"))
    return rows.join(known, "key", "left").select("path", "match_ord", F.coalesce("license", F.lit("")).alias("license"))


_CLAIMS = [("src1",), ("src1/en",), ("src2/fr",), (".",), ("src3/de",), ("src3",)]


@query("J8_deepest_claim", f"WITH {FILES_SQL}, p AS (SELECT path_id FROM {I.values(_CLAIMS, 'path_id')}) SELECT path, path_id FROM (SELECT f.path, p.path_id, row_number() OVER (PARTITION BY f.path ORDER BY CASE WHEN p.path_id = '.' THEN 0 ELSE length(p.path_id) END DESC) AS rn FROM files f JOIN p ON p.path_id = '.' OR starts_with(f.path, p.path_id || '/')) WHERE rn = 1")
def _j8(spark, d):
    return rules.deepest_claims(I.files(spark, d), spark.createDataFrame(_CLAIMS, "path_id string"))


@query("J10_md5_semi", f"WITH {FILES_SQL} SELECT path FROM files WHERE md5(text) IN (SELECT md5(text) FROM files GROUP BY 1 HAVING count(*) > 1)")
def _j10(spark, d):
    files = I.files(spark, d).withColumn("md5", F.md5("text"))
    return files.join(files.groupBy("md5").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "md5", "left_semi").select("path")


# Set operations and order


@query("S1_merge_last_wins", f"WITH {FILES_SQL} SELECT path, CASE WHEN file_ord % 6 = 0 THEN 'dependencies' WHEN file_ord % 2 = 0 THEN 'second' ELSE 'first' END AS answer FROM files")
def _s1(spark, d):
    files = I.files(spark, d)
    part = lambda rows, answer: rows.select("path", F.lit(answer).alias("answer"))
    return merges.last_wins([part(files, "first"), part(files.filter("file_ord % 2 = 0"), "second"), part(files.filter("file_ord % 6 = 0"), "dependencies")], "path")


@query("S3_ordered_union", f"WITH {MATCHES_SQL}, c AS (SELECT path, match_ord, list_concat(purl, ['pkg:npm/%40scope/en', 'pkg:github/org/src1']) AS c FROM matches) SELECT path, match_ord, array_to_string(list_filter(c, lambda x, i: list_position(c, x) = i), ',') AS purls FROM c")
def _s3(spark, d):
    more = F.array(F.lit("pkg:npm/%40scope/en"), F.lit("pkg:github/org/src1"))
    return I.matches(spark, d).select("path", "match_ord", F.array_join(merges.ordered_union(F.col("purl"), more), ",").alias("purls"))


@query("S4_unique_purls", f"WITH {MATCHES_SQL} SELECT DISTINCT unnest(purl) AS purl FROM matches")
def _s4(spark, d):
    return I.matches(spark, d).select(F.explode("purl").alias("purl")).distinct()


_KIND = "CASE doc_id % 3 WHEN 0 THEN 'LICENSE' WHEN 1 THEN 'OPERATIONAL' ELSE 'SECURITY' END"


@query("S5_violation_order", f"SELECT row_number() OVER (ORDER BY CASE kind WHEN 'SECURITY' THEN 3 WHEN 'LICENSE' THEN 2 ELSE 1 END DESC, doc_id) AS rank, doc_id, kind AS type FROM (SELECT doc_id, {_KIND} AS kind FROM documents)")
def _s5(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.expr(_KIND).alias("type"), F.lit(0).alias("x"))
    ranked = reports.numbered(rows.withColumn("x", -merges.violation_rank(F.col("type"))), ["x", "doc_id"], "rank")
    return ranked.select("rank", "doc_id", "type")


# Rollups, summaries and policies

_ROWS_SQL = """crows AS (SELECT purl[1] || '@' || CASE WHEN coalesce(version, '') = '' THEN 'unknown' ELSE version END AS key, purl[1] AS purl, CASE WHEN coalesce(version, '') = '' THEN 'unknown' ELSE version END AS version, status, file_ord, match_ord, licenses
 FROM matches WHERE id NOT IN ('none', 'dependency') AND status IS NOT NULL AND len(purl) > 0)"""
_DROWS_SQL = """drows AS (SELECT purl || '@' || version AS key, purl, version, NULL::VARCHAR AS status, file_ord, dep_ord AS match_ord, CASE WHEN license IS NULL THEN [] ELSE [{name: license, source: NULL::VARCHAR}] END AS licenses FROM deps)"""


def _rollup_sql(rows: str) -> str:
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY file_ord, match_ord) AS rn FROM {rows}),
comp AS (SELECT key, min(purl) AS purl, min(version) AS version, count(*) AS n, sum(CASE WHEN status = 'identified' THEN 1 ELSE 0 END)::BIGINT AS declared,
 sum(CASE WHEN rn = 1 THEN CASE WHEN status = 'pending' THEN 1 ELSE 0 END ELSE CASE WHEN status = 'identified' THEN 0 ELSE 1 END END)::BIGINT AS undeclared,
 CASE WHEN bool_or(rn > 1 AND coalesce(status, '') = 'pending') THEN 'pending' ELSE max(CASE WHEN rn = 1 THEN status END) END AS status, min(CASE WHEN rn = 1 THEN {{file_ord: file_ord, match_ord: match_ord}} END) AS place FROM numbered GROUP BY key)"""


_F1 = f"WITH {MATCHES_SQL}, {_ROWS_SQL}, {_rollup_sql('crows')}"
_F2 = f"WITH {MATCHES_SQL}, {DEPS_SQL}, {_ROWS_SQL}, {_DROWS_SQL}, arows AS (SELECT * FROM crows UNION ALL SELECT * FROM drows), {_rollup_sql('arows')}"


@query("F1_component_rollup", _F1 + " SELECT key, purl, version, status, n, declared, undeclared FROM comp")
def _f1(spark, d):
    return rollups.components(_rows(spark, d)).drop("place")


@query("F2_dependency_rollup", f"WITH {MATCHES_SQL}, {DEPS_SQL}, {_DROWS_SQL}, {_rollup_sql('drows')} SELECT key, purl, version, status, n, declared, undeclared FROM comp")
def _f2(spark, d):
    return rollups.components(rollups.dependency_rows(I.deps(spark, d))).drop("place")


_SOURCES = ", ".join(repr(x) for x in V.COPYLEFT_SOURCES)
_PRIORITY = " ".join(f"WHEN len(list_filter(licenses, lambda x: x.source = '{s}')) > 0 THEN list_filter(licenses, lambda x: x.source = '{s}')" for s in V.LICENSE_SOURCES)
_PICK = f"list_filter(licenses, lambda x: x.source IS NULL OR x.source IN ({_SOURCES}, 'unknown'))"


def _lic_sql(rows: str, pick: str, name: str = "lic") -> str:
    return f"{name} AS (SELECT key, min(purl) AS purl, l.name AS spdxid, count(*) AS n, arg_min(coalesce(l.source, 'unknown'), (file_ord, match_ord, i)) AS source FROM (SELECT key, purl, file_ord, match_ord, unnest({pick}) AS l, generate_subscripts({pick}, 1) AS i FROM {rows}) GROUP BY key, l.name)"


_FIRST_SOURCE = f"CASE {_PRIORITY} ELSE licenses END"


@query("F3_component_license", f"WITH {MATCHES_SQL}, {_ROWS_SQL}, {_lic_sql('crows', _PICK)} SELECT key, purl, spdxid, source, n FROM lic")
def _f3(spark, d):
    return rollups.component_licenses(_rows(spark, d), V.COPYLEFT_SOURCES)


@query("F5_license_select", f"WITH {MATCHES_SQL}, s AS (SELECT path, match_ord, {_FIRST_SOURCE} AS l FROM matches) SELECT path, match_ord, array_to_string(list_transform(l, lambda x: x.name), ',') AS names FROM s")
def _f5(spark, d):
    return I.matches(spark, d).select("path", "match_ord", F.array_join(F.transform(C.selected_licenses(F.col("licenses")), lambda x: x["name"]), ",").alias("names"))


_PURL_LIC = "pl AS (SELECT c.purl, coalesce(l.spdxid, 'unknown') AS spdxid, arg_max(c.status, (c.place.file_ord, c.place.match_ord, c.key)) AS status FROM comp c LEFT JOIN lic l ON c.key = l.key GROUP BY ALL)"


@query("F4_component_summary", _F1 + f", {_lic_sql('crows', _FIRST_SOURCE)}, {_PURL_LIC} SELECT count(*) AS total_components, count(*) FILTER (status = 'pending') AS undeclared_components, count(*) - count(*) FILTER (status = 'pending') AS declared_components, (SELECT sum(n)::BIGINT FROM comp) AS total_files, (SELECT sum(undeclared)::BIGINT FROM comp) AS undeclared_files, (SELECT sum(declared)::BIGINT FROM comp) AS declared_files FROM pl")
def _f4(spark, d):
    rows = _rows(spark, d)
    return rollups.component_summary(rollups.components(rows), rollups.component_licenses(rows))


@query("F6_license_summary", _F2 + f", {COPYLEFT_SQL}, {_lic_sql('arows', _FIRST_SOURCE)}, {_PURL_LIC} SELECT spdxid, count(*) AS n_components, bool_or(coalesce(listed_copyleft, false)) AS is_copyleft FROM pl LEFT JOIN copyleft ON lower(spdxid) = license_key WHERE spdxid <> 'unknown' GROUP BY spdxid")
def _f6(spark, d):
    rows = _all_rows(spark, d)
    return rollups.license_summary(rollups.purl_licenses(rollups.components(rows), rollups.component_licenses(rows)), I.copyleft_table(spark))


@query("F7_file_types", f"WITH {TREE_SQL}, s AS (SELECT regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1) AS e, size FROM tree WHERE size > 0) SELECT CASE WHEN e = '' THEN 'no_suffix' ELSE e END AS extension, count(*) AS n_files, format('{{:,.2f}}', sum(size) / 1048576) AS size_mb FROM s GROUP BY ALL")
def _f7(spark, d):
    return rollups.file_types(I.tree(spark, d), C.suffix(F.col("path")))


_ABOVE = "above AS (SELECT path, size, file_ord, unnest(range(0, len(string_split(path, '/')))) AS k FROM tree), indirs AS (SELECT *, CASE WHEN k = 0 THEN '.' ELSE array_to_string(string_split(path, '/')[:k], '/') END AS dir, (k + 1)::INT AS depth FROM above)"


@query("F8_folder_rollup", f"WITH {TREE_SQL}, {_ABOVE} SELECT dir, depth, count(*) AS n_files, sum(size)::BIGINT AS n_bytes FROM indirs GROUP BY ALL")
def _f8(spark, d):
    return folders.folder_totals(I.tree(spark, d))


@query("S8_depth_limit", f"WITH {TREE_SQL}, {_ABOVE} SELECT dir, depth, count(*) AS n_files, sum(size)::BIGINT AS n_bytes FROM indirs WHERE depth <= 2 GROUP BY ALL")
def _s8(spark, d):
    return folders.folder_totals(I.tree(spark, d), depth=2)


@query("F9_folder_simhash")
def _f9(spark, d):
    return folders.folder_simhashes(I.tree(spark, d), depth=3)


@query("F10_ext_histogram", f"WITH {TREE_SQL}, {_ABOVE}, e AS (SELECT dir, substr(regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1), 2) AS extension FROM indirs) SELECT dir, extension, count(*) AS n_files FROM e WHERE extension <> '' GROUP BY ALL")
def _f10(spark, d):
    return folders.extension_counts(I.tree(spark, d))


@query("P1_copyleft", _F2 + f", {COPYLEFT_SQL}, {_lic_sql('arows', _PICK)} SELECT c.purl, c.version, l.spdxid, l.source FROM lic l JOIN comp c ON l.key = c.key JOIN copyleft ON lower(l.spdxid) = license_key AND listed_copyleft")
def _p1(spark, d):
    return policies.copyleft_components(_all_rows(spark, d), I.copyleft_table(spark))


@query("P2_undeclared", _F1 + " SELECT purl, version FROM comp WHERE status = 'pending'")
def _p2(spark, d):
    return policies.undeclared_components(_rows(spark, d))


# Batches and extensions


@query("G_batches")
def _g(spark, d):
    contexts = rules.sbom_contexts(I.files(spark, d), I.rules(spark, "include"), I.rules(spark, "replace"), I.rules(spark, "exclude"))
    contexts = contexts.select("file_ord", F.concat_ws("|", F.array_join("purls", ","), "scan_type").alias("context"))
    sizes = fingerprints.wfp_blocks(I.files(spark, d)).select("path", F.octet_length("wfp").cast("long").alias("size"))
    rows = I.files(spark, d).select("file_ord", "path").join(sizes, "path").join(contexts, "file_ord")
    return batching.batches(rows).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"), F.min("file_ord").alias("first_file"))


@query("X_kb_snippet_hits")
def _x(spark, d):
    base = table(spark, d, "benchmark").select(F.concat(F.lit("kb/"), F.col("item_id").cast("string"), F.lit(".py")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    known = fingerprints.fingerprints(base).select("hash", F.col("path").alias("kb_path"))
    return fingerprints.knowledge_hits(fingerprints.fingerprints(I.files(spark, d)), known)


# The queries of the other modules are added to those above
from quarrylens.plans import documents, formats, local_base  # noqa: E402, F401
