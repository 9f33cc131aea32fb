"""Writers of results: JSON, CSV, CycloneDX, SPDX, code quality, fingerprint files and copies of listed files.

Large outputs are written by executors as datasets; documents that are one JSON object are tables of lines, which one task
writes in order, row by row. Ids and times are parameters, so that a document can be made again.
"""

from __future__ import annotations

import json
import shutil
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.operators.filters import delta_safe
from quarrylens.operators.reports import numbered
from quarrylens.session import checkpointed
from quarrylens.sources.walks import opened


def _items(matches: DataFrame) -> DataFrame:
    """``path, items``: the matches of each file, in order."""
    fields = [c for c in matches.columns if c not in ("path", "file_ord", "match_ord")]
    ordered = F.array_sort(F.collect_list(F.struct("match_ord", F.struct(*fields).alias("m"))), lambda a, b: a["match_ord"].cast("int") - b["match_ord"].cast("int"))
    return matches.groupBy("path").agg(F.transform(ordered, lambda x: x["m"]).alias("items"))


def result_json(matches: DataFrame) -> DataFrame:
    """One row per file, ``path`` and ``json``: an object with the path as its key and the matches in order."""
    return _items(matches).select("path", F.to_json(F.create_map("path", "items")).alias("json"))


def _lines(head: str, parts: list[tuple[str, DataFrame]], tail: str = "}") -> DataFrame:
    """``part, place, line``: a JSON object as lines: its first fields, then each part as a list, an item on each line.

    An item's line is a JSON text (column ``item``) with a comma in front, but for the first of its part (``place`` 1)."""
    spark = parts[0][1].sparkSession
    fixed = [(0, 0, head), (len(parts) + 1, 0, tail)]
    rows = None
    for number, (name, items) in enumerate(parts, 1):
        fixed.append((number, 0, ("" if number == 1 and head == "{" else ",") + json.dumps(name) + ":["))
        fixed.append((number, 1 << 62, "]"))
        lines = items.select(F.lit(number).alias("part"), "place", F.concat(F.when(F.col("place") > 1, ",").otherwise(""), "item").alias("line"))
        rows = lines if rows is None else rows.unionByName(lines)
    return spark.createDataFrame(fixed, "part int, place long, line string").unionByName(rows)


def write_document(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines of a document as one text file. One task writes it, row by row after a sort that spills, so
    no row holds more than one item."""
    lines.repartition(1).sortWithinPartitions("part", "place").select("line").write.mode(mode).text(path)


def document(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Lines of a JSON object: the rows, in order, as a list under ``name``."""
    fields = [c for c in rows.columns if c not in order] or rows.columns
    items = numbered(rows, order, "place").select("place", F.to_json(F.struct(*fields)).alias("item"))
    return _lines("{", [(name, items)])


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("header", "true").csv(path)


def write_wfp(blocks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Fingerprint texts in order of path, as many files as partitions."""
    blocks.repartitionByRange("path").sortWithinPartitions("path").select(F.rtrim("wfp").alias("value")).write.mode(mode).text(path)


def cyclonedx(components: DataFrame, vulnerabilities: DataFrame, serial: str, timestamp: str, tools: tuple[dict, ...] = ()) -> DataFrame:
    """Lines of a CycloneDX 1.4 document, see :func:`write_document`.

    ``components`` and ``vulnerabilities`` are those of :func:`.reports.cyclonedx_packages` and :func:`.reports.vulnerabilities`; ``tools`` have ``vendor, name, version``, and
    with them stands a component without a name, of which the document speaks. Components stand in
    their order of sight, or by purl where ``place`` is missing; licences given as one text of names are names that the SPDX list isn't asked for."""
    licenses = F.col("licenses") if "array" in dict(components.dtypes)["licenses"] else F.transform(F.filter(F.split("licenses", ","), lambda x: x != ""), lambda x: F.struct(x.alias("id"), F.lit(None).cast("string").alias("name")))
    given = lambda name: F.col(name) if name in components.columns else F.lit(None).cast("string")
    fields = [F.lit("library").alias("type"), F.col("component").alias("name"), F.coalesce(given("vendor"), F.lit("")).alias("publisher"), "version", "purl", F.col("purl").alias("bom-ref"), F.transform(licenses, lambda x: F.struct(x.alias("license"))).alias("licenses"), F.when(given("cpe") != "", given("cpe")).alias("cpe")]
    listed = F.to_json(F.struct(*fields))
    affects = F.transform(F.col("affects") if "array" in dict(vulnerabilities.dtypes)["affects"] else F.split("affects", ","), lambda x: F.struct(x.alias("ref")))
    source = F.struct(F.col("source").alias("name"), *(["url"] if "url" in vulnerabilities.columns else []))
    found = F.to_json(F.struct(F.col("vuln_id").alias("id"), source.alias("source"), F.array(F.struct("severity")).alias("ratings"), affects.alias("affects")))
    made = {"tools": list(tools), "component": {"type": "application", "name": "NOASSERTION", "version": "NOASSERTION"}} if tools else {}
    head = json.dumps({"bomFormat": "CycloneDX", "specVersion": "1.4", "serialNumber": f"urn:uuid:{serial}", "version": 1, "metadata": {"timestamp": timestamp, **made}})[:-1]
    order = ["place", "purl"] if "place" in components.columns else ["purl", "version"]
    parts = [("components", numbered(components, order, "line_place").select(F.col("line_place").alias("place"), listed.alias("item"))), ("vulnerabilities", numbered(vulnerabilities, ["vuln_id"], "place").select("place", found.alias("item")))]
    return _lines(head, parts)


def purl_locator(purl: Column, version: Column) -> Column:
    """A purl with its version, in its normal form: types whose names have no case in lower case, the version percent-encoded."""
    folded = F.when(purl.rlike("^pkg:(github|bitbucket|pypi)/"), F.lower(purl)).otherwise(purl)
    folded = F.when(folded.startswith("pkg:pypi/"), F.replace(folded, F.lit("_"), F.lit("-"))).otherwise(folded)
    coded = F.replace(F.replace(F.replace(F.url_encode(version), F.lit("+"), F.lit("%20")), F.lit("%3A"), F.lit(":")), F.lit("%7E"), F.lit("~"))
    return F.when(F.coalesce(version, F.lit("")) == "", folded).otherwise(F.concat(folded, F.lit("@"), coded))


#: What a licence reference begins with may name the tool that found the licence.
DETECTORS = ("scancode",)


def spdx_lite(packages: DataFrame, references: DataFrame, name: str, created: str, namespace: str = "https://spdx.org/spdxdocs/document", creators: tuple[str, ...] = (), detectors: tuple[str, ...] = DETECTORS) -> DataFrame:
    """Lines of an SPDX 2.2 document, see :func:`write_document`. ``packages`` are those of :func:`.reports.spdx_packages`; they stand in their order of sight, or by purl where ``place`` is missing."""
    given = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)) if c in packages.columns else F.lit(None).cast("string")
    plain = lambda c: F.col(c) if c in packages.columns else F.lit(None).cast("string")
    nothing = F.lit("NOASSERTION")
    external = F.struct(F.lit("PACKAGE-MANAGER").alias("referenceCategory"), purl_locator(F.col("purl"), plain("version")).alias("referenceLocator"), F.lit("purl").alias("referenceType"))
    checksum = F.struct(F.lit("MD5").alias("algorithm"), F.coalesce(given("url_hash"), F.lit("0" * 32)).alias("checksumValue"))
    fields = [
        plain("component").alias("name"), F.col("spdx_id").alias("SPDXID"), plain("version").alias("versionInfo"), F.coalesce(given("download_url"), plain("url")).alias("downloadLocation"), plain("url").alias("homepage"),
        F.col("license").alias("licenseDeclared"), nothing.alias("licenseConcluded"), F.lit(False).alias("filesAnalyzed"), nothing.alias("copyrightText"),
        F.concat(F.lit("Organization: "), F.coalesce(plain("vendor"), nothing)).alias("supplier"), F.array(external).alias("externalRefs"), F.array(checksum).alias("checksums"),
    ]
    listed = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    found = f"(?i)^LicenseRef-((?:{'|'.join(f'{d}-' for d in detectors)})?)(\\S+)$"
    tool = F.replace(F.regexp_extract("license_ref", found, 1), F.lit("-"), F.lit(""))
    bare = F.when(F.col("license_ref").rlike(found), F.regexp_extract("license_ref", found, 2)).otherwise(F.col("license_ref"))
    note = F.concat(F.lit("Detected license"), F.when(tool != "", F.concat(F.lit(" by "), tool, F.lit("."))).otherwise("."))
    refs = F.to_json(F.struct(F.col("license_ref").alias("licenseId"), F.replace(bare, F.lit("-"), F.lit(" ")).alias("name"), F.lit("Detected license, please review component source code.").alias("extractedText"), note.alias("comment")))
    creation = {"created": created, "creators": list(creators), "comment": "SBOM Build information - SBOM Type: Build"}
    head = json.dumps({"spdxVersion": "SPDX-2.2", "dataLicense": "CC0-1.0", "SPDXID": "SPDXRef-DOCUMENT", "name": name, "creationInfo": creation, "documentNamespace": namespace})[:-1]
    placed = numbered(packages, ["place", "purl"] if "place" in packages.columns else ["purl"], "line_place")
    parts = [
        ("packages", placed.select(F.col("line_place").alias("place"), listed.alias("item"))),
        ("documentDescribes", placed.select(F.col("line_place").alias("place"), F.concat(F.lit('"'), "spdx_id", F.lit('"')).alias("item"))),
        ("hasExtractedLicensingInfos", numbered(references, ["license_ref"], "place").select("place", refs.alias("item"))),
    ]
    return _lines(head, parts)


def keys_sorted(value: Column, kind: T.DataType) -> Column:
    """A value with the keys of all its objects in order."""
    if isinstance(kind, T.StructType):
        fields = [keys_sorted(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: keys_sorted(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), keys_sorted(e["value"], kind.valueType).alias("value")))))
    return value


def plain(matches: DataFrame) -> DataFrame:
    """The same as :func:`result_json`, for people: indented, the keys of all objects in order."""
    items = _items(matches)
    return items.select("path", F.to_json(F.create_map("path", keys_sorted(F.col("items"), items.schema["items"].dataType)), {"pretty": "true"}).alias("json"))


def raw(matches: DataFrame) -> DataFrame:
    """One JSON object for each match, as it is."""
    return matches.select("path", F.to_json(F.struct(*[c for c in matches.columns if c != "path"])).alias("json"))


def routed(rows: DataFrame, path: str | None, column: str) -> None:
    """Lines of a result to a folder of text files, or to the standard output without one (read row by row)."""
    if path is not None:
        rows.select(column).write.text(path)
        return
    for r in rows.select(column).toLocalIterator():
        print(r[0])


def code_quality_json(rows: DataFrame) -> DataFrame:
    """One JSON object per item of a code quality report."""
    place = F.struct("path", F.struct(F.col("begin").alias("begin")).alias("lines"))
    return rows.select(F.to_json(F.struct("description", "check_name", "fingerprint", "severity", place.alias("location"))).alias("json"))


def upload_payload(bom: DataFrame, project: dict) -> DataFrame:
    """The body of an upload of a bill of materials (``json``): its text as base64, with the project's id or name."""
    keys = {"project": project["uuid"]} if project.get("uuid") else {"projectName": project["name"], "projectVersion": project["version"], "autoCreate": "true"}
    return bom.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in keys.items()], F.base64(F.encode("json", "UTF-8")).alias("bom"))).alias("json"))


def copy_listed(paths: list[str], root: str, target: str) -> list[tuple[str, bool]]:
    """Copy listed files below ``root`` to a new folder with their structure; a path that leaves the tree, or
    is missing, isn't copied. A list made by people, so it is copied where it is called."""
    out = Path(target)
    out.mkdir(parents=True)  # fails if it exists
    done = []
    for path in paths:
        source = Path(root, path.lstrip("/"))
        inside = ".." not in Path(path).parts and source.is_file()
        if inside:
            (out / path.lstrip("/")).parent.mkdir(parents=True, exist_ok=True)
            shutil.copy2(source, out / path.lstrip("/"))
        done.append((path, inside))
    return done


COPIED = "path string, copied boolean, size long, problem string"


def copied_files(paths: DataFrame, root: str, target: str) -> DataFrame:
    """Files that a list (``path``) names below ``root`` are copied to ``target`` with their folders, by the executors: ``path, copied, size, problem``, a row for each distinct path.

    The target must not exist. A path that leaves the tree, or is missing, or is no file, isn't copied and says so. A task writes under a name of its own and renames it to the file's, so that a task
    that runs twice, or is lost halfway, leaves one whole copy and no other; what it leaves of its own is deleted by :func:`commit_copies`. The rows are written to the shared checkpoint folder, so
    files are copied once however often the result is read."""
    system, out = opened(target)
    if system.get_file_info(out).type != fs.FileType.NotFound:
        raise FileExistsError(f"{target} exists")
    system.create_dir(out, recursive=True)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, base = opened(root)
        goal, top = opened(target)
        for batch in batches:
            rows = []
            for path, inside in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                clean = "/".join(p for p in (path or "").split("/") if p not in ("", "."))
                done = _copied(source, f"{base}/{clean}", goal, f"{top}/{clean}", f"{top}/{PENDING}") if inside and clean else (False, None, "not in the tree")
                rows.append((path, *done))
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["path", "copied", "size", "problem"])

    listed = paths.select("path").distinct().select("path", delta_safe(F.col("path")).alias("inside"))
    return checkpointed(listed.mapInArrow(copy, COPIED))


#: A folder of copies that aren't whole yet.
PENDING = "_pending"


def _copied(source: fs.FileSystem, path: str, goal: fs.FileSystem, to: str, pending: str) -> tuple[bool, int | None, str | None]:
    info = source.get_file_info(path)
    if info.type != fs.FileType.File:
        return False, None, "missing" if info.type == fs.FileType.NotFound else "no file"
    try:
        own = f"{pending}/{uuid.uuid4().hex}"
        goal.create_dir(pending, recursive=True)
        goal.create_dir(to.rpartition("/")[0], recursive=True)
        fs.copy_files(path, own, source_filesystem=source, destination_filesystem=goal)
        goal.move(own, to)
    except OSError as e:
        return False, None, str(e)
    return True, info.size, None


def commit_copies(copies: DataFrame, target: str) -> tuple[int, str | None]:
    """Ends :func:`copied_files`: its rows become the ``_manifest`` in the target (JSON lines in order of path), what tasks left unfinished goes, and the number of files and the first
    problem, in order of path, are given. A target without a manifest isn't whole."""
    system, out = opened(target)
    if system.get_file_info(f"{out}/{PENDING}").type == fs.FileType.Directory:
        system.delete_dir(f"{out}/{PENDING}")
    copies.orderBy("path").select(F.to_json(F.struct("path", "copied", "size", "problem")).alias("value")).write.text(target.rstrip("/") + "/_manifest")
    done = copies.agg(F.count_if("copied").alias("n"), F.min_by(F.concat("path", F.lit(": "), "problem"), F.when(~F.col("copied"), F.col("path"))).alias("problem")).first()
    return done["n"], done["problem"]


#: Presenters by format; each takes what the function under its name takes.
PRESENTERS: dict[str, Callable] = {"json": result_json, "plain": plain, "raw": raw, "csv": write_csv, "cyclonedx": cyclonedx, "spdxlite": spdx_lite}


def presenter(kind: str | None) -> Callable:
    """The presenter of a format; plain without one."""
    if (kind or "plain") not in PRESENTERS:
        raise ValueError(f"unknown format {kind}; known: {sorted(PRESENTERS)}")
    return PRESENTERS[kind or "plain"]
