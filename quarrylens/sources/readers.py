"""Readers: source trees, fingerprint texts, scan results, inventories, bills of materials, settings and lists.

Documents are read by Spark from any path it knows and parsed by its own JSON functions; small files that steer a
run (settings, lists) are read on the driver. External tools are not started: their output files are read.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.functions.json_schema import misfits
from quarrylens.operators.dependencies import INVENTORY
from quarrylens.operators.filters import file_skipped, folder_skipped, size_kept

LICENSE = "struct<name:string,source:string,copyleft:string,url:string,patent_hints:string,checklist_url:string,incompatible_with:string,osadl_updated:string,spdx_id:string,is_spdx_approved:boolean>"
MATCH = (
    "struct<id:string,status:string,component:string,vendor:string,version:string,latest:string,purl:array<string>,url:string,url_hash:string,url_stats:map<string,string>,release_date:string,"
    f"file:string,file_hash:string,file_url:string,source_hash:string,lines:string,oss_lines:string,matched:string,licenses:array<{LICENSE}>,"
    f"dependencies:array<struct<purl:string,component:string,version:string,url:string,licenses:array<{LICENSE}>>>,server:struct<version:string,kb_version:struct<daily:string,monthly:string>>>"
)
RESULT = f"map<string,array<{MATCH}>>"
CYCLONEDX = "struct<bomFormat:string,specVersion:string,components:array<struct<name:string,version:string,purl:string>>>"
CONTAINER = "struct<artifacts:array<struct<name:string,version:string,type:string,purl:string,licenses:array<struct<value:string,spdxExpression:string,type:string>>>>>"
VIOLATIONS = (
    "array<struct<type:string,timestamp:bigint,uuid:string,component:struct<name:string,group:string,version:string,purl:string>,"
    "policyCondition:struct<policy:struct<name:string,violationState:string>>,project:struct<name:string,version:string,uuid:string>>>"
)


def source_tree(spark: SparkSession, root: str, patterns: tuple[str, ...] = (), folder_hash: bool = False, **size_options) -> DataFrame:
    """``path`` (below the root), ``size, content`` of the files of a tree that a scan takes, or that a folder's hash is made of. Filters
    on path and size come before the content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split("://")[-1]
    rows = found.withColumn("rel", F.element_at(F.split(F.col("path"), _quoted(base) + "/", 2), -1))
    path = F.col("rel")
    if folder_hash:
        kept = rows.filter(~file_skipped(path, patterns=patterns, folder_hash=True) & size_kept(path, F.col("length"), **size_options))
    else:
        kept = rows.filter(~folder_skipped(path, patterns=patterns) & ~file_skipped(path, patterns=patterns) & size_kept(path, F.col("length"), **size_options))
    return kept.select(path.alias("path"), F.col("length").alias("size"), "content")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def listed_files(spark: SparkSession, paths: list[str], patterns: tuple[str, ...] = (), **size_options) -> DataFrame:
    """The same of an explicit list, which people or another tool made: names that don't exist or are folders are left out, and so are
    hidden, listed and empty files; folders above them don't matter."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()

    def exists(path: str) -> bool:
        found = jvm.org.apache.hadoop.fs.Path(path)
        system = found.getFileSystem(hadoop)
        return bool(system.exists(found) and system.getFileStatus(found).isFile())

    kept = [p for p in paths if exists(p)]
    schema = "path string, size long, content binary"
    if not kept:
        return spark.createDataFrame([], schema)
    rows = spark.read.format("binaryFile").load(kept).select("path", F.col("length").alias("size"), "content")
    # the scheme and root of a path are no hidden parts
    path = F.regexp_replace("path", "^[A-Za-z0-9+.-]+:/*", "")
    return rows.filter(~file_skipped(path, patterns=patterns) & size_kept(path, F.col("size"), **size_options))


def single_file(spark: SparkSession, path: str) -> DataFrame:
    """``path, size, content`` of one file, without any filter; a path that is a folder has no rows, and a missing one is an error."""
    found = spark.read.format("binaryFile").load(path).filter(F.substring_index("path", "/", -1) == path.rstrip("/").rpartition("/")[2])
    return found.select(F.lit(path).alias("path"), F.col("length").alias("size"), "content")


def content_rows(rows: DataFrame) -> DataFrame:
    """``path, size, content`` of files that are there as rows (``path, content``), without any filter; a null content is an empty file."""
    content = F.coalesce("content", F.unhex(F.lit("")))
    return rows.select("path", F.octet_length(content).cast("long").alias("size"), content.alias("content"))


def contents(spark: SparkSession, items: list[tuple[str, bytes]]) -> DataFrame:
    """The same of files in memory."""
    return content_rows(spark.createDataFrame([(name, bytearray(data)) for name, data in items], "path string, content binary"))


def wfp_records(spark: SparkSession, path: str) -> DataFrame:
    """``path, md5, size, wfp, fh2, hpsm, start_line, snippets`` of fingerprint texts. A record begins at each line with ``file=``; the
    name is all after the second comma."""
    blocks = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"(?m)^(?=file=)")).alias("wfp")).filter("wfp LIKE 'file=%'")
    return parsed_wfp(blocks)


def parsed_wfp(blocks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of records (``wfp``), after the columns to ``keep``."""
    wfp = F.col("wfp")
    head = F.substring_index(wfp, "\n", 1)
    part = lambda pattern: F.regexp_extract(wfp, pattern, 1)
    given = lambda x: F.when(x != "", x)
    lines = F.filter(F.split(wfp, "\n"), lambda x: x.rlike(r"^\d+="))
    snippets = F.transform(lines, lambda x: F.struct(F.substring_index(x, "=", 1).cast("int").alias("line"), F.split(F.substring_index(x, "=", -1), ",").alias("hashes")))
    return blocks.select(
        *keep, F.regexp_extract(head, r"^file=[^,]*,[^,]*,(.*)$", 1).alias("path"), F.regexp_extract(head, r"^file=([^,]*)", 1).alias("md5"), given(F.regexp_extract(head, r"^file=[^,]*,(\d+),", 1)).cast("long").alias("size"),
        wfp, given(part(r"(?m)^fh2=(\w+)")).alias("fh2"), given(part(r"(?m)^hpsm=(\w+)")).alias("hpsm"), given(part(r"(?m)^start_line=(\d+)")).cast("int").alias("start_line"), snippets.alias("snippets"),
    )


def scan_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per match of result documents: ``doc_path, file_ord, match_ord, path`` and the fields of a match."""
    return parsed_results(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc_path"), "value"), F.col("value"))


def parsed_results(rows: DataFrame, value: Column) -> DataFrame:
    keep = [c for c in rows.columns if c != "value"]
    files = rows.select(*keep, F.posexplode(F.from_json(value, RESULT)).alias("file_ord", "path", "matches"))
    return files.select(*keep, "file_ord", "path", F.posexplode("matches").alias("match_ord", "m")).select(*keep, "file_ord", "match_ord", "path", "m.*")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Dependency inventories of either format, for :func:`quarrylens.operators.dependencies.flattened`."""
    return spark.read.schema(INVENTORY).json(path, multiLine=True)


def cyclonedx_requests(spark: SparkSession, path: str) -> DataFrame:
    """``purl, requirement`` of the components of a CycloneDX document."""
    return parsed_cyclonedx(spark.read.text(path, wholetext=True), F.col("value"))


def parsed_cyclonedx(rows: DataFrame, value: Column) -> DataFrame:
    bom = rows.select(F.from_json(value, CYCLONEDX).alias("b"))
    return bom.select(F.explode("b.components").alias("c")).filter("c.purl IS NOT NULL").select("c.purl", F.when(F.coalesce("c.version", F.lit("")) != "", F.col("c.version")).alias("requirement"))


def purl_requests(spark: SparkSession, path: str | None = None, purls: list[str] = ()) -> DataFrame:
    """``purl, requirement`` from a JSON file or a list; an empty request is refused."""
    if purls:
        return spark.createDataFrame([(p, None) for p in purls], "purl string, requirement string")
    if path is None:
        raise ValueError("no purls given")
    return parsed_purls(spark.read.text(path, wholetext=True), F.col("value"))


def parsed_purls(rows: DataFrame, value: Column) -> DataFrame:
    listed = rows.select(F.from_json(value, "purls array<struct<purl:string,requirement:string>>").alias("x"))
    return listed.select(F.explode("x.purls").alias("p")).select("p.purl", "p.requirement").filter("purl IS NOT NULL")


def container_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """``file, ord, purl, name, version, license``: distinct purls of a container inventory, the first of each."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.from_json("value", CONTAINER).alias("c"))
    rows = rows.select("file", F.posexplode("c.artifacts").alias("ord", "a")).filter("a.purl IS NOT NULL")
    license_ = F.try_element_at(F.transform("a.licenses", lambda x: F.coalesce(x["spdxExpression"], x["value"])), F.lit(1))
    first = rows.groupBy("file", F.col("a.purl").alias("purl")).agg(F.min(F.struct("ord", F.col("a.name").alias("name"), F.col("a.version").alias("version"), license_.alias("license"))).alias("x"))
    return first.select("file", "x.ord", "purl", "x.name", "x.version", "x.license")


#: Dependencies that another tool has parsed already.
DEPENDENCY_FILE = "files array<struct<file:string,purls:array<struct<purl:string,requirement:string,scope:string>>>>"


def dependency_file(spark: SparkSession, path: str) -> DataFrame:
    """``file, place, purl, requirement, scope`` of dependencies that another tool has parsed already."""
    return parsed_dependencies(spark.read.text(path, wholetext=True), F.col("value"))


def parsed_dependencies(rows: DataFrame, value: Column) -> DataFrame:
    files = rows.select(F.explode(F.from_json(value, DEPENDENCY_FILE)["files"]).alias("f"))
    return files.select("f.file", F.posexplode("f.purls").alias("place", "p")).select("file", "place", "p.*").filter("purl IS NOT NULL")


def violations(spark: SparkSession, path: str) -> DataFrame:
    """Policy violations of a project, flat, with their place."""
    return parsed_violations(spark.read.text(path, wholetext=True), F.col("value"))


def parsed_violations(rows: DataFrame, value: Column) -> DataFrame:
    rows = rows.select(F.posexplode(F.from_json(value, VIOLATIONS)).alias("place", "v"))
    return rows.select("place", "v.type", "v.timestamp", "v.uuid", "v.component.purl", F.col("v.component.name").alias("component"), F.col("v.component.version").alias("version"), F.col("v.policyCondition.policy.name").alias("policy"), F.col("v.policyCondition.policy.violationState").alias("state"))


def spdx_list(spark: SparkSession, path: str) -> DataFrame:
    """The public SPDX licence list (JSON): ``place, spdx_key, spdx_name, license_name`` in its order."""
    return parsed_spdx_list(spark.read.text(path, wholetext=True), F.col("value"))


def parsed_spdx_list(rows: DataFrame, value: Column) -> DataFrame:
    """The licences of a list's document; those without an id are left out."""
    read = rows.select(F.posexplode(F.from_json(value, "licenses array<struct<licenseId: string, name: string>>")["licenses"]).alias("place", "x"))
    return read.filter("x.licenseId <> ''").select("place", F.lower("x.licenseId").alias("spdx_key"), F.col("x.licenseId").alias("spdx_name"), F.col("x.name").alias("license_name"))


def settings(path: str | None = None, default: str = "settings.json") -> dict:
    """Settings from a JSON file. The default file may be missing; a named one that is missing or empty gives no settings."""
    found = Path(path or default)
    if not found.is_file() or not found.read_text().strip():
        return {}
    data = json.loads(found.read_text())
    if not isinstance(data, dict):
        raise ValueError(f"{found} must hold an object")
    if problems := list(_misfits(data, SETTINGS, "settings")):
        raise ValueError(f"{found}: {'; '.join(problems)}")
    return data


_RULE = {"path": str, "purl": str, "comment": str}
_SIZE = {"patterns": [str], "min": int, "max": int}
_NET = {"proxy": {"host": str}, "http_config": {"base_uri": str, "ignore_cert_errors": bool}}
#: Kinds of the fields of settings: a type, a list of one kind, or fields with their kinds; other fields are free.
SETTINGS = {
    "bom": {"include": [_RULE], "exclude": [_RULE], "remove": [_RULE], "replace": [{**_RULE, "replace_with": str, "license": str}]},
    "settings": {
        **_NET, "skip": {"patterns": {k: [str] for k in ("scanning", "fingerprinting", "dependencies")}, "sizes": {k: [_SIZE] for k in ("scanning", "fingerprinting")}},
        "file_snippet": {
            **_NET, "min_snippet_hits": int, "min_snippet_lines": int, "honour_file_exts": bool, "ranking_enabled": bool, "ranking_threshold": int, "skip_headers": bool,
            "skip_headers_limit": int, "dependency_analysis": bool,
        },
    },
}


def _misfits(value, kind, name: str):
    """What in ``value`` isn't of its kind; null fields of ``file_snippet`` are allowed."""
    if isinstance(kind, dict):
        if not isinstance(value, dict):
            yield f"{name} must be an object"
            return
        for key, inner in kind.items():
            if key in value and not (value[key] is None and "file_snippet" in name):
                yield from _misfits(value[key], inner, f"{name}.{key}")
    elif isinstance(kind, list):
        if not isinstance(value, list):
            yield f"{name} must be a list"
            return
        for k, item in enumerate(value):
            yield from _misfits(item, kind[0], f"{name}[{k}]")
    elif not isinstance(value, kind) or (kind is int and isinstance(value, bool)):
        yield f"{name} must be of type {kind.__name__}"


def _schema_of(kind) -> dict:
    """The JSON Schema of the kinds of fields above."""
    if isinstance(kind, dict):
        return {"type": "object", "properties": {k: _schema_of(v) for k, v in kind.items()}}
    if isinstance(kind, list):
        return {"type": "array", "items": _schema_of(kind[0])}
    return {"type": {str: "string", int: "integer", bool: "boolean"}[kind]}


def settings_schema() -> dict:
    """The JSON Schema of settings: the kinds of fields, and which may be null, which must be there, and their bounds (fixed values)."""
    schema = _schema_of({**SETTINGS, "self": {"name": str, "license": str, "description": str}})
    settings_, bom = (schema["properties"][k]["properties"] for k in ("settings", "bom"))
    for listed in settings_["skip"]["properties"]["patterns"]["properties"].values():
        listed["uniqueItems"] = True
    snippet = settings_["file_snippet"]["properties"]
    settings_["hpfm"] = _schema_of({"ranking_enabled": bool, "ranking_threshold": int})
    settings_["container"] = {"type": "object"}
    for name, kind in (("ranking_enabled", "boolean"), ("honour_file_exts", "boolean"), ("ranking_threshold", "integer")):
        snippet[name]["type"] = [kind, "null"]
    settings_["hpfm"]["properties"]["ranking_threshold"]["type"] = ["integer", "null"]
    for node, least, most in ((snippet["ranking_threshold"], -1, 10), (settings_["hpfm"]["properties"]["ranking_threshold"], -1, 99), (snippet["min_snippet_hits"], 0, None), (snippet["min_snippet_lines"], 0, None)):
        node.update({"minimum": least} if most is None else {"minimum": least, "maximum": most})
    for name, needed in (("include", ["purl"]), ("replace", ["purl", "replace_with"])):
        bom[name]["items"]["required"] = needed
    bom["remove"]["items"]["anyOf"] = [{"required": ["purl"]}, {"required": ["path"]}]
    return schema


def settings_misfits(rows: DataFrame, value: Column) -> DataFrame:
    """``rows`` with ``path`` and ``problem`` of all in the settings of ``value`` (a JSON text) that doesn't fit :func:`settings_schema`, a row each."""
    return rows.withColumn("misfit", F.explode(misfits(value, settings_schema(), "settings"))).select(*rows.columns, "misfit.*")


def settings_rules(spark: SparkSession, data: dict) -> DataFrame:
    """Rules of settings as a table, in their order."""
    rows, order = [], 0
    for kind in ("include", "exclude", "remove", "replace"):
        for r in data.get("bom", {}).get(kind, []):
            rows.append((order, kind, r.get("path"), r.get("purl"), r.get("replace_with"), r.get("license")))
            order += 1
    return spark.createDataFrame(rows, "rule_ord int, kind string, path string, purl string, replace_with string, license string")


def merged_settings(cli: dict, settings_: dict, file_snippet: dict) -> dict:
    """Scan settings by priority: those of file snippets, then general ones, then the command line; values are clamped."""
    out = {}
    for key in {*cli, *settings_, *file_snippet}:
        value = next((s[key] for s in (file_snippet, settings_, cli) if s.get(key) is not None), None)
        if isinstance(value, str) and value.lower() in ("true", "false"):
            value = value.lower() == "true"
        if value is not None and key in ("min_snippet_hits", "min_snippet_lines"):
            value = max(0, value)
        if value is not None and key == "ranking_threshold":
            value = min(10, max(-1, value))
        out[key] = value
    return out


def merged_setting(file_snippet: Column, general: Column, cli: Column, least: int | None = None, most: int | None = None) -> Column:
    """The same for one setting as columns: the first that is given, within bounds."""
    value = F.coalesce(file_snippet, general, cli)
    # a missing value stays missing: least and greatest would skip it
    value = F.when(value.isNotNull(), F.greatest(value, F.lit(least))) if least is not None else value
    return F.when(value.isNotNull(), F.least(value, F.lit(most))) if most is not None else value


def delta_list(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of each line that isn't blank, without slashes at its start."""
    return delta_paths(spark.read.text(path), F.col("value"))


def delta_paths(rows: DataFrame, value: Column) -> DataFrame:
    return rows.select(F.regexp_replace(F.rtrim(value), "^/+", "").alias("path")).filter("path <> ''")


def json_state(text: Column) -> Column:
    """Why a text isn't usable JSON: 1 parse error, 3 empty; null if it is (:func:`json_problem` for a file)."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", 3).when(F.try_parse_json(text).isNull(), 1)


def json_problem(path: str) -> tuple[int, str] | None:
    """Why a file isn't usable JSON: 1 parse error, 2 not found, 3 empty, 4 unreadable; None if it is."""
    found = Path(path)
    if not found.is_file():
        return 2, f"{path} not found"
    try:
        text = found.read_text()
    except OSError as e:
        return 4, str(e)
    if not text.strip():
        return 3, f"{path} is empty"
    try:
        json.loads(text)
    except json.JSONDecodeError as e:
        return 1, str(e)
    return None
