"""Named queries on whole documents: SPDX and CycloneDX with all their fields, plain results, and licences by all spellings.

Their input gives every two files purls of their own, vendors, addresses, checksums and licence names in all spellings, so that the documents grow with the
input. The SQL makes the same lines. Registered with the queries of :mod:`.catalog`.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.operators import reports
from quarrylens.plans import catalog as Q
from quarrylens.plans.catalog import query
from quarrylens.sources import inputs as I
from quarrylens.sources import readers, writers
from quarrylens.session import table
from quarrylens.sources.inputs import DEPS_SQL, MATCHES_SQL

_OWN = {
    "purl": "CASE WHEN {n} = 0 THEN {none} WHEN match_ord = 1 THEN {a}'pkg:npm/%40scope/' || lang || CAST({half} AS {T}){z} ELSE {a}'pkg:github/Org/' || component || '_' || CAST({half} AS {T}){z} END",
    "vendor": "CASE WHEN file_ord % 5 = 0 THEN NULL ELSE 'v' || CAST(file_ord % 7 AS {T}) END",
    "url_hash": "CASE WHEN file_ord % 3 = 0 THEN '' WHEN file_ord % 3 = 1 THEN NULL ELSE md5(path) END",
    "download_url": "CASE WHEN file_ord % 4 = 0 THEN 'https://files.org/' || CAST(file_ord AS {T}) END",
}
_SPARK = {k: e.format(n="size(purl)", none="CAST(array() AS ARRAY<STRING>)", a="array(", z=")", half="file_ord div 2", T="STRING") for k, e in _OWN.items()}
_DUCK = {k: e.format(n="len(purl)", none="[]::VARCHAR[]", a="[", z="]", half="file_ord // 2", T="VARCHAR") for k, e in _OWN.items()}
_VULN = Q._VULN_ID.replace("'GHSA-' || CAST(file_ord % 7", "'GHSA-' || CAST(file_ord").replace("'CVE-1-' || CAST(file_ord % 5", "'CVE-1-' || CAST(file_ord % 50")


def matches(spark: SparkSession, d: str) -> DataFrame:
    """Matches with purls of their own, vendors, checksums and spelled licences."""
    rows = I.matches(spark, d).withColumns({k: F.expr(e) for k, e in _SPARK.items() if k != "purl"}).withColumn("purl", F.expr(_SPARK["purl"]))
    spelled = F.expr(f"transform(licenses, x -> named_struct('name', {Q._SPELL.replace('name', 'x.name')}, 'source', x.source))")
    return rows.withColumn("licenses", spelled)


def vulnerable(spark: SparkSession, d: str) -> DataFrame:
    rows = matches(spark, d).filter("size(purl) > 0")
    return rows.select(
        "file_ord", "match_ord", F.struct("file_ord", "match_ord").alias("place"), F.element_at("purl", 1).alias("purl"), F.expr(_VULN.format(T="STRING")).alias("vuln_id"), F.expr(Q._CVE.format(T="STRING")).alias("cve"),
        F.expr(Q._SEVERITY2).alias("severity"), F.when(F.col("file_ord") % 2 == 0, "nvd").otherwise("github").alias("source"),
    )


_LIST = "list_transform(licenses, lambda x: {{'name': {e}, 'source': x.source}})".format(e=Q._SPELL.replace("name", "x.name"))
_MATCHES = f"{MATCHES_SQL}, {DEPS_SQL}, own AS (SELECT * REPLACE ({_DUCK['purl']} AS purl, {_LIST} AS licenses), {', '.join(f'{e} AS {k}' for k, e in _DUCK.items() if k != 'purl')} FROM matches)"
_SIGHTED = f"""{_MATCHES}, sighted AS (
 SELECT file_ord, match_ord, -1 AS dep_ord, purl[1] AS purl, component, version, licenses, vendor, url, url_hash, download_url FROM own WHERE id NOT IN ('none', 'dependency') AND len(purl) > 0
 UNION ALL SELECT file_ord, 0, dep_ord, purl, component, version, CASE WHEN license IS NULL THEN [] ELSE [{{'name': license, 'source': NULL::VARCHAR}}] END, NULL, NULL, NULL, NULL FROM deps),
firsts AS (SELECT *, row_number() OVER (ORDER BY file_ord, match_ord, dep_ord, purl) AS place FROM (SELECT * FROM sighted QUALIFY row_number() OVER (PARTITION BY purl ORDER BY file_ord, match_ord, dep_ord) = 1))"""
_NAMES = f"n AS (SELECT purl, unnest(list_distinct(list_transform(list_filter(licenses, lambda x: coalesce(x.source, '') = '' OR {Q._LISTED}), lambda x: x.name))) AS name FROM firsts)"


@query("E7_spelled_licenses", f"WITH {_SIGHTED}, {Q._LOOKUP}, {_NAMES} SELECT purl, name, {Q._FOUND} AS spdxid FROM n {Q._STEPS} WHERE name <> ''")
def _e7s(spark, d):
    """The licences of every package, one row each."""
    rows = reports._sighted(matches(spark, d), I.deps(spark, d)).withColumn("names", reports._license_names(False))
    first = rows.groupBy("purl").agg(F.min_by("names", "place").alias("names")).select("purl", F.explode("names").alias("name"))
    return reports.spdx_licenses(first, Q._known_licenses(spark))


def _frame(head: str, parts: list[str], last: int) -> str:
    """The lines that stand around the parts of a document."""
    lines = [(0, 0, head), *[(k, 0, f",{json.dumps(name)}:[") for k, name in enumerate(parts, 1)], *[(k, 1 << 62, "]") for k in range(1, len(parts) + 1)], (last, 0, "}")]
    return " UNION ALL ".join(f"SELECT {a}::INT AS part, {b}::BIGINT AS place, {I._q(c)} AS line" for a, b, c in lines)


_COMMA = "CASE WHEN place > 1 THEN ',' ELSE '' END || "
_SPDX_HEAD = json.dumps({"spdxVersion": "SPDX-2.2", "dataLicense": "CC0-1.0", "SPDXID": "SPDXRef-DOCUMENT", "name": "bill", "creationInfo": {"created": "now", "creators": ["Tool: t"], "comment": "SBOM Build information - SBOM Type: Build"}, "documentNamespace": "https://spdx.org/spdxdocs/x"})[:-1]


@query("B4_spdx_lines", rf"""WITH {_SIGHTED}, {Q._LOOKUP}, {_NAMES}, i AS (SELECT purl, list_sort(list_distinct(list({Q._FOUND}))) AS ids FROM n {Q._STEPS} WHERE name <> '' GROUP BY purl),
 p AS (SELECT f.*, 'SPDXRef-' || md5(f.purl || '@' || f.version) AS spdx_id, CASE WHEN ids IS NULL THEN 'NOASSERTION' WHEN len(ids) = 1 THEN ids[1] ELSE '(' || array_to_string(ids, ' AND ') || ')' END AS declared, ids FROM firsts f LEFT JOIN i ON f.purl = i.purl),
 r AS (SELECT ref, row_number() OVER (ORDER BY ref) AS place FROM (SELECT DISTINCT unnest(string_split(replace(replace(declared, '(', ''), ')', ''), ' AND ')) AS ref FROM p) WHERE starts_with(ref, 'LicenseRef-')),
 bodies AS (
  SELECT 1 AS part, place, to_json({{'name': component, 'SPDXID': spdx_id, 'versionInfo': version, 'downloadLocation': coalesce(nullif(download_url, ''), url), 'homepage': url, 'licenseDeclared': declared, 'licenseConcluded': 'NOASSERTION', 'filesAnalyzed': false,
   'copyrightText': 'NOASSERTION', 'supplier': 'Organization: ' || coalesce(vendor, 'NOASSERTION'), 'externalRefs': [{{'referenceCategory': 'PACKAGE-MANAGER', 'referenceLocator': CASE WHEN starts_with(purl, 'pkg:npm') THEN purl ELSE lower(purl) END || CASE WHEN version = '' THEN '' ELSE '@' || version END, 'referenceType': 'purl'}}],
   'checksums': [{{'algorithm': 'MD5', 'checksumValue': coalesce(nullif(url_hash, ''), repeat('0', 32))}}]}})::VARCHAR AS item FROM p
  UNION ALL SELECT 2, place, '"' || spdx_id || '"' FROM p
  UNION ALL SELECT 3, place, to_json({{'licenseId': ref, 'name': replace(CASE WHEN regexp_matches(ref, '\s') THEN ref ELSE ref[12:] END, '-', ' '), 'extractedText': 'Detected license, please review component source code.', 'comment': 'Detected license.'}})::VARCHAR FROM r)
SELECT part, place, {_COMMA} item AS line FROM bodies UNION ALL {_frame(_SPDX_HEAD, ['packages', 'documentDescribes', 'hasExtractedLicensingInfos'], 4)}""")
def _b4(spark, d):
    """Every line of an SPDX document."""
    packages = reports.spdx_packages(matches(spark, d), I.deps(spark, d), Q._known_licenses(spark))
    return writers.spdx_lite(packages, reports.license_references(packages), "bill", "now", "https://spdx.org/spdxdocs/x", ("Tool: t",))


_CDX_HEAD = json.dumps({"bomFormat": "CycloneDX", "specVersion": "1.4", "serialNumber": "urn:uuid:id", "version": 1, "metadata": {"timestamp": "now", "tools": [{"vendor": "a", "name": "b", "version": "1"}], "component": {"type": "application", "name": "NOASSERTION", "version": "NOASSERTION"}}})[:-1]
_CDX_NAMES = f"n AS (SELECT purl, unnest(list_distinct(list_transform(list_filter(licenses, lambda x: CASE WHEN dep_ord >= 0 THEN true ELSE coalesce({Q._LISTED}, false) END), lambda x: x.name))) AS name FROM firsts)"
_HIT = "coalesce(i0.found, i1.found, m0.found, m1.found)"


@query("B3_cyclonedx_lines", rf"""WITH {_SIGHTED}, {Q._LOOKUP}, {_CDX_NAMES}, l AS (SELECT DISTINCT purl, {_HIT} AS id, CASE WHEN {_HIT} IS NULL THEN name END AS own FROM n {Q._STEPS} WHERE name <> ''),
 i AS (SELECT purl, string_agg('{{"license":{{"' || CASE WHEN id IS NULL THEN 'name' ELSE 'id' END || '":' || to_json(coalesce(id, own)) || '}}}}', ',' ORDER BY id IS NULL, coalesce(id, own)) AS licenses FROM l GROUP BY purl),
 v AS (SELECT file_ord, match_ord, purl[1] AS purl, {_VULN.format(T='VARCHAR')} AS vid, {Q._CVE.format(T='VARCHAR')} AS cve, {Q._SEVERITY2} AS s, CASE WHEN file_ord % 2 = 0 THEN 'nvd' ELSE 'github' END AS source FROM own WHERE len(purl) > 0),
 m AS (SELECT *, CASE WHEN starts_with(upper(vid), 'CPE:') THEN cve ELSE vid END AS vuln FROM v), c AS (SELECT file_ord, match_ord, vid AS cpe FROM v WHERE starts_with(upper(vid), 'CPE:')),
 g AS (SELECT vuln, min({{file_ord: file_ord, match_ord: match_ord, s: s, source: source, cve: cve}}) AS x, '[' || string_agg(DISTINCT '{{"ref":' || to_json(purl) || '}}', ',' ORDER BY '{{"ref":' || to_json(purl) || '}}') || ']' AS affects FROM m WHERE coalesce(vuln, '') <> '' GROUP BY vuln),
 bodies AS (
  SELECT 1 AS part, place, '{{"type":"library","name":' || to_json(component) || ',"publisher":' || to_json(coalesce(vendor, '')) || ',"version":' || to_json(version) || ',"purl":' || to_json(f.purl) || ',"bom-ref":' || to_json(f.purl) || ',"licenses":[' || coalesce(i.licenses, '') || ']'
   || CASE WHEN cpe IS NULL THEN '' ELSE ',"cpe":' || to_json(cpe) END || '}}' AS item
  FROM firsts f LEFT JOIN i ON f.purl = i.purl LEFT JOIN c ON f.file_ord = c.file_ord AND f.match_ord = c.match_ord AND f.dep_ord = -1
  UNION ALL SELECT 2, row_number() OVER (ORDER BY vuln), '{{"id":' || to_json(vuln) || ',"source":{{"name":"' || CASE WHEN x.source = 'nvd' THEN 'NVD' ELSE 'GitHub Advisories' END || '","url":"' || CASE WHEN x.source = 'nvd' THEN 'https://nvd.nist.gov/vuln/detail/' || coalesce(x.cve, '') ELSE 'https://github.com/advisories/' || vuln END
   || '"}},"ratings":[{{"severity":"' || CASE WHEN lower(x.s) = 'moderate' THEN 'medium' WHEN lower(x.s) = 'high' THEN 'high' ELSE 'unknown' END || '"}}],"affects":' || affects || '}}' FROM g)
SELECT part, place, {_COMMA} item AS line FROM bodies UNION ALL {_frame(_CDX_HEAD, ['components', 'vulnerabilities'], 3)}""")
def _b3(spark, d):
    """Every line of a CycloneDX document."""
    found = vulnerable(spark, d)
    cpes = found.filter(F.upper("vuln_id").startswith("CPE:")).select("file_ord", "match_ord", F.col("vuln_id").alias("cpe"))
    components = reports.cyclonedx_packages(matches(spark, d), I.deps(spark, d), Q._known_licenses(spark), cpes)
    return writers.cyclonedx(components, reports.vulnerabilities(found), "id", "now", ({"vendor": "a", "name": "b", "version": "1"},))


@query("B1_plain_fields", f"""WITH {MATCHES_SQL} SELECT path, match_ord::INT AS match_ord, id, array_to_string(purl, '|') AS purls, array_to_string(list_transform(licenses, lambda x: x.name || ' of ' || coalesce(x.source, 'none')), '|') AS licenses, lines FROM matches""")
def _b1(spark, d):
    """Nested fields of plain results, read back."""
    back = writers.plain(I.matches(spark, d)).select("path", F.from_json("json", "map<string,array<struct<id:string,purl:array<string>,licenses:array<struct<name:string,source:string>>,lines:string>>>").alias("x"))
    rows = back.select("path", F.posexplode(F.element_at(F.map_values("x"), 1)).alias("match_ord", "m"))
    shown = F.transform("m.licenses", lambda x: F.concat(x["name"], F.lit(" of "), F.coalesce(x["source"], F.lit("none"))))
    return rows.select("path", "match_ord", "m.id", F.array_join("m.purl", "|").alias("purls"), F.array_join(shown, "|").alias("licenses"), "m.lines")


#: Settings with something wrong, by document: the text of each kind, and its misfits.
_SETTINGS = [
    ('{"bom": {"include": [{"purl": "p"}, {"path": "N"}]}}', [("settings.bom.include[1]", "must have purl")]),
    ('{"bom": {"remove": [{"comment": "N"}, {"path": "a"}]}}', [("settings.bom.remove[0]", "must fit one of several forms")]),
    ('{"settings": {"file_snippet": {"ranking_threshold": N, "min_snippet_hits": -1}}}', [("settings.settings.file_snippet.ranking_threshold", "maximum is 10"), ("settings.settings.file_snippet.min_snippet_hits", "minimum is 0")]),
    ('{"settings": {"skip": {"patterns": {"scanning": ["a", "a"]}, "sizes": {"scanning": [{"patterns": [1], "min": 1.5}]}}}}', [("settings.settings.skip.patterns.scanning", "items must differ"), ("settings.settings.skip.sizes.scanning[0].patterns[0]", "must be of type string"), ("settings.settings.skip.sizes.scanning[0].min", "must be of type integer")]),
    ('{"settings": {"file_snippet": {"ranking_enabled": null, "ranking_threshold": 7}}, "bom": {"replace": [{"purl": "N", "replace_with": "b"}]}}', []),
    ('{"bom": ', [("settings", "is no JSON")]),
    ('[]', [("settings", "must be of type object")]),
]
_TEXT = "replace(CASE doc_id % 7 " + " ".join(f"WHEN {k} THEN '{text}'" for k, (text, _) in enumerate(_SETTINGS)) + " END, 'N', CAST(doc_id + 11 AS {T}))"


@query("A12_settings_misfits", f"SELECT doc_id, path, problem FROM documents JOIN {I.values([(k, p, q) for k, (_, found) in enumerate(_SETTINGS) for p, q in found], 'kind, path, problem')} ON doc_id % 7 = kind")
def _a12(spark, d):
    """What doesn't fit in settings documents, and where."""
    rows = table(spark, d, "documents").select("doc_id", F.expr(_TEXT.replace("{T}", "STRING")).alias("value"))
    return readers.settings_misfits(rows, F.col("value")).drop("value")
