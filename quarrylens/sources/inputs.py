"""Inputs of the queries, derived from the driver's tables: in Spark, and the same in SQL.

``files`` are the documents as source files; ``tree`` spreads them over folders and suffixes that the
filters treat differently; ``matches`` are the matches of a scan; ``deps`` the dependencies of some of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.functions import fixed_values as V
from quarrylens.session import table

PATH = "concat(source, '/', lang, '/doc_', CAST(doc_id AS STRING), '.py')"
TREE_PATH = """
CASE doc_id % 12
 WHEN 0 THEN concat(source, '/', lang, '/doc_', CAST(doc_id AS STRING), '.py')
 WHEN 1 THEN concat('venv/', source, '/doc_', CAST(doc_id AS STRING), '.py')
 WHEN 2 THEN concat(source, '/.hidden/doc_', CAST(doc_id AS STRING), '.py')
 WHEN 3 THEN concat(source, '/lib.egg-info/doc_', CAST(doc_id AS STRING), '.py')
 WHEN 4 THEN concat(source, '/Examples/', lang, '/doc_', CAST(doc_id AS STRING), '.c')
 WHEN 5 THEN concat(source, '/', lang, '/doc_', CAST(doc_id AS STRING), '.min.js')
 WHEN 6 THEN concat(source, '/', lang, '/', CAST(doc_id AS STRING), '/LICENSE.txt')
 WHEN 7 THEN concat(source, '/', lang, '/', CAST(doc_id AS STRING), '/data.json')
 WHEN 8 THEN concat(source, '/', lang, '/', CAST(doc_id AS STRING), '/.env')
 WHEN 9 THEN concat(source, '/', lang, '/', CAST(doc_id AS STRING), '/gradlew')
 WHEN 10 THEN concat(source, '/build/', lang, '/main_', CAST(doc_id AS STRING), '.GO')
 ELSE concat(source, '/', lang, '/build_', CAST(doc_id AS STRING), '.rs') END
"""
MATCH_COLUMNS = {
    "file_ord": "doc_id",
    "match_ord": "match_ord",
    "path": PATH,
    "id": "CASE WHEN match_ord = 1 THEN 'file' WHEN doc_id % 10 = 0 THEN 'none' WHEN doc_id % 10 IN (1, 2) THEN 'snippet' WHEN doc_id % 10 = 3 THEN 'dependency' ELSE 'file' END",
    "status": "CASE WHEN quality = 1 THEN 'identified' ELSE 'pending' END",
    "purl": "CASE WHEN match_ord = 1 THEN concat('pkg:npm/%40scope/', lang) WHEN doc_id % 17 = 0 THEN NULL ELSE concat('pkg:github/org/', source) END",
    "component": "source",
    "version": "CASE WHEN doc_id % 7 = 0 THEN '' ELSE concat('v', CAST(doc_id % 3 AS STRING)) END",
    "latest": "'v2'",
    "url": "concat('https://github.com/org/', source)",
    "file": "concat('src/', CAST(doc_id AS STRING), '.c')",
    "file_hash": "md5(text)",
    "lines": "CASE WHEN doc_id % 10 IN (1, 2) AND match_ord = 0 THEN concat(CAST(doc_id % 50 + 1 AS STRING), '-', CAST(doc_id % 50 + 9 AS STRING), ',70-', CAST(doc_id % 9 + 80 AS STRING)) ELSE 'all' END",
    "oss_lines": "CASE WHEN doc_id % 10 IN (1, 2) AND match_ord = 0 THEN '12-22,32-47' ELSE 'all' END",
    "matched": "CASE WHEN doc_id % 10 IN (1, 2) THEN concat(CAST(doc_id % 100 AS STRING), '%') ELSE '100%' END",
    "lang": "lang",
}
#: Licences of a match by language: name and source, several with one name or without a source.
LICENSES = {
    "en": [("MIT", "component_declared"), ("MIT", "file_header"), ("BSD-2-Clause", "scancode")],
    "fr": [("GPL-2.0-only", "component_declared"), ("MIT", "license_file"), ("GPL-2.0-only", "scancode")],
    "de": [("Apache-2.0", "license_file"), ("GPL-3.0-only", None), ("LGPL-2.1-only", "unknown")],
    "es": [],
}
COPYLEFT = {**dict.fromkeys(V.COPYLEFT_YES, "Yes"), **dict.fromkeys(V.COPYLEFT_RESTRICTED, "Yes (restricted)"), **dict.fromkeys(V.COPYLEFT_QUESTIONABLE, "Questionable"), **dict.fromkeys(V.COPYLEFT_NO, "No")}
#: Rules on bills of materials: order, kind, path, purl, replacement, licence.
RULES = [
    (0, "include", None, "pkg:github/org/src1", None, None),
    (1, "include", "src1", None, None, None),
    (2, "include", "src2/en", "pkg:github/org/src2", None, None),
    (3, "include", "src2", "pkg:github/org/src2", None, None),
    (4, "remove", "src3/fr/", None, None, None),
    (5, "remove", "src4", "pkg:github/org/src4", None, None),
    (6, "remove", None, "pkg:github/org/src19", None, None),
    (7, "remove", None, None, None, None),
    (8, "replace", "src5", None, "pkg:github/org/src6", "MIT"),
    (9, "replace", "src5/en", "pkg:github/org/src5", "pkg:github/other/lib", None),
    (10, "replace", None, "pkg:github/org/src7", "pkg:github/org/src8", None),
    (11, "replace", "src7/en", None, "pkg:npm/left-pad", "ISC"),
    (12, "exclude", None, "pkg:github/org/src9", None, None),
    (13, "exclude", "src10", "pkg:github/org/src10", None, None),
    (14, "include", None, "pkg:github/org/src1", None, None),
]
PATTERNS = ["*.js", "!src1/**/*.js", "/venv", "build/", "**/doc_1?.py", "data.json", "!/src2/en/*/data.json", "src3/*/doc_[0-4]*.py"]




def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_ord, path, text, size``"""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("file_ord"), F.expr(PATH).alias("path"), F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.octet_length("text").cast("long"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_ord, path, text, size`` with paths that filters treat differently."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("file_ord"), F.expr(TREE_PATH).alias("path"), F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.octet_length("text").cast("long"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of a scan; one or two for a file. ``purl`` and ``licenses`` are arrays."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    docs = docs.withColumn("match_ord", F.explode(F.when(F.col("doc_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = docs.select(*[F.expr(e).alias(c) for c, e in MATCH_COLUMNS.items()])
    rows = rows.withColumn("purl", F.when(F.col("purl").isNull(), F.array().cast("array<string>")).otherwise(F.array("purl")))
    licenses = F.array().cast("array<struct<name:string,source:string>>")
    for lang, items in LICENSES.items():
        if items:
            licenses = F.when(F.col("lang") == lang, F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).cast("string").alias("source")) for n, s in items])).otherwise(licenses)
    return rows.withColumn("licenses", licenses)


def deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_ord, dep_ord, path, purl, component, version, requirement, scope, license`` of dependency matches."""
    rows = matches(spark, sf_dir).filter("id = 'dependency'")
    items = [("concat('pkg:pypi/', lang)", "lang", "CASE WHEN file_ord % 11 = 0 THEN '' ELSE concat('1.', CAST(file_ord % 4 AS STRING)) END", "concat('>=1.', CAST(file_ord % 4 AS STRING))", "CASE WHEN file_ord % 3 = 0 THEN 'dev' WHEN file_ord % 3 = 1 THEN NULL ELSE 'compile' END", "'MIT'"),
             ("'pkg:pypi/base'", "'base'", "'2.0'", "'base==2.0'", "'test'", "CAST(NULL AS STRING)")]
    parts = [rows.selectExpr("file_ord", f"{k} AS dep_ord", "path", *[f"{e} AS {c}" for e, c in zip(item, ("purl", "component", "version", "requirement", "scope", "license"), strict=True)]) for k, item in enumerate(items)]
    return parts[0].unionByName(parts[1])


def rules(spark: SparkSession, kind: str | None = None) -> DataFrame:
    rows = [r for r in RULES if kind in (None, r[1])]
    return spark.createDataFrame(rows, "rule_ord int, kind string, path string, purl string, replace_with string, license string")


def copyleft_table(spark: SparkSession) -> DataFrame:
    """``license_key`` (lower case) and whether it is copyleft."""
    return spark.createDataFrame([(k.lower(), v.lower().startswith("yes")) for k, v in COPYLEFT.items()], "license_key string, listed_copyleft boolean")


def _q(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def values(rows: list[tuple], columns: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(_q(x) for x in r) + ')' for r in rows)}) AS t({columns})"


def _duck(expression: str) -> str:
    return expression.replace("AS STRING", "AS VARCHAR")


#: The same tables for the SQL oracle, as common table expressions.
FILES_SQL = f"files AS (SELECT doc_id AS file_ord, {_duck(PATH)} AS path, coalesce(text, '') AS text, strlen(coalesce(text, ''))::BIGINT AS size FROM documents)"
TREE_SQL = f"tree AS (SELECT doc_id AS file_ord, {_duck(TREE_PATH)} AS path, coalesce(text, '') AS text, strlen(coalesce(text, ''))::BIGINT AS size FROM documents)"
_LICENSE_SQL = "CASE lang " + " ".join(f"WHEN '{lang}' THEN [{', '.join('{name: ' + _q(n) + ', source: ' + _q(s) + '}' for n, s in items)}]" for lang, items in LICENSES.items() if items) + " ELSE [] END"
MATCHES_SQL = f"""matches AS (
  SELECT * REPLACE (CASE WHEN purl IS NULL THEN []::VARCHAR[] ELSE [purl] END AS purl), {_LICENSE_SQL} AS licenses FROM (
    SELECT {', '.join(f'{_duck(e)} AS {c}' for c, e in MATCH_COLUMNS.items())}
    FROM (SELECT d.doc_id, d.source, d.lang, coalesce(d.text, '') AS text, l.quality, unnest(CASE WHEN d.doc_id % 5 = 0 THEN [0, 1] ELSE [0] END) AS match_ord
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)))"""
DEPS_SQL = """deps AS (
  SELECT file_ord, 0 AS dep_ord, path, 'pkg:pypi/' || lang AS purl, lang AS component, CASE WHEN file_ord % 11 = 0 THEN '' ELSE '1.' || (file_ord % 4) END AS version,
         '>=1.' || (file_ord % 4) AS requirement, CASE WHEN file_ord % 3 = 0 THEN 'dev' WHEN file_ord % 3 = 1 THEN NULL ELSE 'compile' END AS scope, 'MIT' AS license
  FROM matches WHERE id = 'dependency'
  UNION ALL SELECT file_ord, 1, path, 'pkg:pypi/base', 'base', '2.0', 'base==2.0', 'test', NULL FROM matches WHERE id = 'dependency')"""
RULES_SQL = f"rules AS (SELECT rule_ord, kind, path, purl, replace_with, license FROM {values(RULES, 'rule_ord, kind, path, purl, replace_with, license')})"
COPYLEFT_SQL = f"copyleft AS (SELECT license_key, listed_copyleft FROM {values([(k.lower(), 1 if v.lower().startswith('yes') else 0) for k, v in COPYLEFT.items()], 'license_key, listed')}, LATERAL (SELECT listed = 1 AS listed_copyleft))"
