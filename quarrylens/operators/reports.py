"""Scan results flattened to the rows of reports: results, CSV, CycloneDX, SPDX, code quality, summaries of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.functions import columns as C
from quarrylens.functions.fixed_values import CSV_COLUMNS
from quarrylens.operators.filters import valid_matches
from quarrylens.session import checkpointed

LICENSE_LIST_SOURCES = ["component_declared", "license_file", "file_header"]


def first_matches(matches: DataFrame) -> DataFrame:
    """First match of every file."""
    return matches.filter("match_ord = 0")


def result_rows(matches: DataFrame) -> DataFrame:
    """``file, status, match_type, matched, purl, license``"""
    first = lambda c: F.coalesce(F.try_element_at(c, F.lit(1)), F.lit("N/A"))
    return first_matches(matches).select(
        F.col("path").alias("file"), F.coalesce("status", F.lit("N/A")).alias("status"), F.coalesce("id", F.lit("N/A")).alias("match_type"), F.coalesce("matched", F.lit("N/A")).alias("matched"),
        first(F.col("purl")).alias("purl"), first(F.transform("licenses", lambda x: x["name"])).alias("license"),
    )


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with a gapless number from 1 in ``order``, in parallel: rows are range-partitioned, and the number of
    those in lower partitions is added. Only the counts of partitions (one row each) meet in one task.

    The dealt rows are checkpointed with their partition, so that counts and rows speak of the same deal even if bounds
    would be sampled anew."""
    dealt = checkpointed(rows.repartitionByRange(*order).withColumn("number_part", F.spark_partition_id()))
    inside = F.row_number().over(Window.partitionBy("number_part").orderBy(*order))
    counts = dealt.groupBy("number_part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(F.col("number_part"), (F.sum("n").over(Window.orderBy("number_part")) - F.col("n")).alias("before"))
    return dealt.join(F.broadcast(offsets), "number_part").withColumn(name, (F.col("before") + inside).cast("long")).drop("number_part", "before")


def csv_rows(matches: DataFrame, deps: DataFrame) -> DataFrame:
    """The thirteen columns of the CSV report; one row per match with a purl, and per dependency."""
    names = F.array_distinct(F.filter(F.transform("licenses", lambda x: x["name"]), lambda n: n.isNotNull() & (n != "")))
    text = lambda c: F.coalesce(c, F.lit(""))
    ranges = lambda c: F.replace(text(c), F.lit(","), F.lit(";"))
    plain = matches.filter("id NOT IN ('none', 'dependency') AND size(purl) > 0").select(
        "file_ord", "match_ord", F.lit(-1).alias("dep_ord"), "path", F.col("id").alias("detected_usage"), text(F.col("component")).alias("detected_component"), F.array_join(names, ";").alias("detected_license"),
        text(F.col("version")).alias("detected_version"), text(F.col("latest")).alias("detected_latest"), F.array_join("purl", ";").alias("detected_purls"), text(F.col("url")).alias("detected_url"),
        text(F.col("matched")).alias("detected_match"), ranges(F.col("lines")).alias("detected_lines"), ranges(F.col("oss_lines")).alias("detected_oss_lines"), text(F.col("file")).alias("detected_path"),
    )
    parent = matches.filter("id = 'dependency'").select("file_ord", "match_ord", "path", "id", "matched", "lines", "oss_lines")
    listed = deps.filter("purl IS NOT NULL").select("file_ord", "dep_ord", "purl", "component", "version", "license").join(parent, "file_ord").select(
        "file_ord", "match_ord", "dep_ord", "path", F.col("id").alias("detected_usage"), text(F.col("component")).alias("detected_component"), text(F.col("license")).alias("detected_license"),
        text(F.col("version")).alias("detected_version"), F.lit("").alias("detected_latest"), F.col("purl").alias("detected_purls"), F.lit("").alias("detected_url"),
        text(F.col("matched")).alias("detected_match"), ranges(F.col("lines")).alias("detected_lines"), ranges(F.col("oss_lines")).alias("detected_oss_lines"), F.lit("").alias("detected_path"),
    )
    return numbered(plain.unionByName(listed), ["file_ord", "match_ord", "dep_ord"], "inventory_id").select(*CSV_COLUMNS)


def _field(rows: DataFrame, name: str) -> Column:
    """A text field of ``rows``, null where they have none of that name."""
    return (rows[name] if name in rows.columns else F.lit(None)).cast("string").alias(name)


def _sighted(matches: DataFrame, deps: DataFrame, fields: tuple[str, ...] = ()) -> DataFrame:
    """``place, purl, component, version, license names`` and ``fields`` of all first purls and dependencies, in order of sight."""
    plain = matches.filter("id NOT IN ('none', 'dependency') AND size(purl) > 0")
    plain = plain.select(F.struct("file_ord", "match_ord", F.lit(-1).alias("dep_ord")).alias("place"), F.element_at("purl", 1).alias("purl"), "component", "version", "licenses", *[_field(plain, f) for f in fields])
    one = F.when(F.col("license").isNull(), F.array().cast("array<struct<name:string,source:string>>")).otherwise(F.array(F.struct(F.col("license").alias("name"), F.lit(None).cast("string").alias("source"))))
    listed = deps.filter("purl IS NOT NULL")
    listed = listed.select(F.struct("file_ord", F.lit(0).alias("match_ord"), "dep_ord").alias("place"), "purl", "component", "version", one.alias("licenses"), *[_field(listed, f) for f in fields])
    return plain.unionByName(listed)


def _license_names(dependency_only_null: bool):
    kept = F.filter("licenses", lambda x: x["source"].isin(*LICENSE_LIST_SOURCES) | (F.coalesce(x["source"], F.lit("")) == "" if not dependency_only_null else x["source"].isNull()))
    return F.array_sort(F.array_distinct(F.filter(F.transform(kept, lambda x: x["name"]), lambda n: F.coalesce(n, F.lit("")) != "")))


def cyclonedx_components(matches: DataFrame, deps: DataFrame) -> DataFrame:
    """``purl, component, version, licenses`` of the first sighting of each purl; sorted licence names, comma-joined.

    A match's licences count by source; those of dependencies have none and all count."""
    rows = _sighted(matches, deps).withColumn("names", F.when(F.col("place.dep_ord") >= 0, _license_names(True)).otherwise(F.array_sort(F.array_distinct(F.transform(F.filter("licenses", lambda x: x["source"].isin(*LICENSE_LIST_SOURCES)), lambda x: x["name"])))))
    first = rows.groupBy("purl").agg(F.min(F.struct("place", "component", "version", "names")).alias("x"))
    return first.select("purl", "x.component", "x.version", F.array_join("x.names", ",").alias("licenses"))


def spdx_ids(rows: DataFrame, known: DataFrame, name: str = "name", column: str = "spdxid") -> DataFrame:
    """``rows`` with the SPDX id of the licence in ``name``, null for names that the SPDX list lacks.

    ``known`` is that list in order: ``place``, ``spdx_key`` (the id in lower case), ``spdx_name`` (the id), ``license_name``. A name is
    looked up in four steps, and the first hit counts: as an id without white space, as an id with dashes in its stead, and
    both as a licence's name. Ids are also known by their part before the first dash, where no other id is that part; of
    several ids the first in the list counts then, and of several of one name the last. Each distinct name is looked up once, in one join."""
    short = F.substring_index("spdx_key", "-", 1)
    ids = known.select("place", F.col("spdx_key").alias("key"), "spdx_name", F.lit(True).alias("whole"))
    ids = ids.unionByName(known.filter(short != F.col("spdx_key")).select("place", short.alias("key"), "spdx_name", F.lit(False).alias("whole")))
    by_id = ids.groupBy("key").agg(F.coalesce(F.max_by("spdx_name", F.when(F.col("whole"), F.col("place"))), F.min_by("spdx_name", "place")).alias("found"))
    by_name = known.select("place", C.license_keys(F.col("license_name"))[0].alias("key"), "spdx_name").filter("key <> ''").groupBy("key").agg(F.max_by("spdx_name", "place").alias("found"))
    table = by_id.withColumn("kind", F.lit("id")).unionByName(by_name.withColumn("kind", F.lit("name")))
    keys = C.license_keys(F.col("spdx_of"))
    steps = F.array(*[F.struct(F.lit(n).alias("step"), F.lit(kind).alias("kind"), key.alias("key")) for n, (kind, key) in enumerate((k, key) for k in ("id", "name") for key in keys)])
    names = rows.select(F.col(name).alias("spdx_of")).distinct().select("spdx_of", F.explode(steps).alias("s")).select("spdx_of", "s.*")
    found = names.join(table, ["kind", "key"]).groupBy("spdx_of").agg(F.min_by("found", "step").alias(column))
    return rows.join(found, rows[name] == found["spdx_of"], "left").drop("spdx_of")


def spdx_licenses(rows: DataFrame, known: DataFrame, name: str = "name", column: str = "spdxid") -> DataFrame:
    """The same, where names that the SPDX list lacks become references."""
    dashed = F.replace(F.col(name), F.lit(" "), F.lit("-"))
    reference = F.when(F.col(name).startswith("LicenseRef"), dashed).otherwise(F.concat(F.lit("LicenseRef-"), dashed))
    return spdx_ids(rows, known, name, column).withColumn(column, F.coalesce(column, reference))


#: Fields of a package besides its purl, component, version and licences.
PACKAGE_FIELDS = ("vendor", "url", "url_hash", "download_url")


def spdx_packages(matches: DataFrame, deps: DataFrame, known: DataFrame) -> DataFrame:
    """``purl, spdx_id, license`` and ``component, version, vendor, url, url_hash, download_url, place``: packages of the first sighting of each purl. Fields that
    the matches don't have are null. ``known`` is the SPDX list, as in ``spdx_ids``."""
    rows = _sighted(matches, deps, PACKAGE_FIELDS).withColumn("names", _license_names(False))
    fields = ("component", "version", *PACKAGE_FIELDS)
    first = rows.groupBy("purl").agg(F.min(F.struct("place", *fields, "names")).alias("x")).select("purl", "x.*").withColumn("version", F.coalesce("version", F.lit("")))
    ids = spdx_licenses(first.select("purl", F.explode("names").alias("name")), known).groupBy("purl").agg(F.array_sort(F.collect_set("spdxid")).alias("ids"))
    joined = first.drop("names").join(ids, "purl", "left")
    text = F.when(F.coalesce(F.size("ids"), F.lit(0)) < 1, "NOASSERTION").when(F.size("ids") == 1, F.element_at("ids", 1)).otherwise(F.concat(F.lit("("), F.array_join("ids", " AND "), F.lit(")")))
    return joined.select("purl", F.concat(F.lit("SPDXRef-"), F.md5(F.concat_ws("@", "purl", "version"))).alias("spdx_id"), text.alias("license"), *fields, "place")


def cyclonedx_packages(matches: DataFrame, deps: DataFrame, known: DataFrame, cpes: DataFrame | None = None) -> DataFrame:
    """``purl, component, vendor, version, licenses, cpe, place``: components of the first sighting of each purl. ``licenses`` are structs of the SPDX ``id``, or of the
    ``name`` of a licence that the SPDX list lacks, each once, ids first and in order. ``cpes`` has ``file_ord, match_ord, cpe``."""
    listed = F.filter("licenses", lambda x: F.when(F.col("place.dep_ord") >= 0, F.lit(True)).otherwise(F.coalesce(x["source"].isin(*LICENSE_LIST_SOURCES), F.lit(False))))
    rows = _sighted(matches, deps, ("vendor",)).withColumn("names", F.array_distinct(F.filter(F.transform(listed, lambda x: x["name"]), lambda n: F.coalesce(n, F.lit("")) != "")))
    first = rows.groupBy("purl").agg(F.min(F.struct("place", "component", "vendor", "version", "names")).alias("x")).select("purl", "x.*")
    found = spdx_ids(first.select("purl", F.explode("names").alias("name")), known)
    one = F.struct(F.col("spdxid").isNull().alias("own"), F.coalesce("spdxid", "name").alias("text"))
    none = F.array().cast("array<struct<id:string,name:string>>")
    ids_first = F.transform(F.array_sort(F.collect_set(one)), lambda x: F.struct(F.when(~x["own"], x["text"]).alias("id"), F.when(x["own"], x["text"]).alias("name")))
    by_purl = found.groupBy("purl").agg(ids_first.alias("licenses"))
    out = first.drop("names").join(by_purl, "purl", "left").withColumn("licenses", F.coalesce("licenses", none))
    if cpes is None:
        return out.withColumn("cpe", F.lit(None).cast("string"))
    last = cpes.groupBy(F.struct("file_ord", "match_ord", F.lit(-1).alias("dep_ord")).alias("place")).agg(F.max("cpe").alias("cpe"))
    return out.join(last, "place", "left")


def license_references(packages: DataFrame) -> DataFrame:
    """Distinct references to licences that the SPDX list lacks."""
    names = F.explode(F.split(F.regexp_replace("license", "[()]", ""), " AND ")).alias("license_ref")
    return packages.select(names).filter("license_ref LIKE 'LicenseRef-%'").distinct()


def vulnerabilities(rows: DataFrame) -> DataFrame:
    """``vuln_id, severity, source, affects, url``: one row per vulnerability with the sorted purls.

    ``rows`` has ``place, purl, vuln_id, cve, severity, source``. An id that begins with ``CPE:`` gives way to the CVE."""
    ident = F.when(F.upper("vuln_id").startswith("CPE:"), F.col("cve")).otherwise(F.col("vuln_id"))
    named = rows.withColumn("vuln", ident).filter("coalesce(vuln, '') <> ''")
    source = F.when(F.lower("x.source") == "nvd", "NVD").otherwise("GitHub Advisories")
    out = named.groupBy("vuln").agg(F.min(F.struct("place", "severity", "source", "cve")).alias("x"), F.array_sort(F.collect_set("purl")).alias("affects"))
    url = F.when(F.lower("x.source") == "nvd", F.concat(F.lit("https://nvd.nist.gov/vuln/detail/"), F.coalesce("x.cve", F.lit("")))).otherwise(F.concat(F.lit("https://github.com/advisories/"), F.col("vuln")))
    return out.select(F.col("vuln").alias("vuln_id"), C.severity(F.col("x.severity")).alias("severity"), source.alias("source"), "affects", url.alias("url"))


def appended_vulnerabilities(existing: DataFrame, answers: DataFrame) -> DataFrame:
    """``vuln_id, severity, source, affects``: a document's vulnerabilities with those of later answers added.

    ``answers`` has ``purl, vuln_id, severity, source``; empty ids and those that begin with ``CPE:`` are left out. A
    known vulnerability keeps its fields and gains the purls that it lacks."""
    new = answers.filter("coalesce(vuln_id, '') <> '' AND NOT startswith(upper(vuln_id), 'CPE:')")
    new = new.select(F.lit(1).alias("part"), "vuln_id", C.severity(F.col("severity")).alias("severity"), "source", F.array("purl").alias("affects"))
    rows = existing.select(F.lit(0).alias("part"), "vuln_id", "severity", "source", "affects").unionByName(new)
    first = F.min(F.struct("part", "severity", "source")).alias("x")
    out = rows.groupBy("vuln_id").agg(first, F.array_sort(F.array_distinct(F.flatten(F.collect_set("affects")))).alias("affects"))
    return out.select("vuln_id", "x.severity", "x.source", "affects")


def code_quality(matches: DataFrame) -> DataFrame:
    """``path, description, check_name, fingerprint, severity, begin``"""
    rows = matches.filter("id IN ('file', 'snippet') AND coalesce(file_hash, '') <> ''")
    begin = F.when(F.col("id") == "snippet", F.try_element_at(C.line_numbers(F.col("lines")), F.lit(1))).otherwise(1)
    what = F.concat(F.initcap("id"), F.lit(" match found in: "), F.coalesce("url", F.lit("")))
    return rows.select("path", what.alias("description"), F.lit("scan").alias("check_name"), F.col("file_hash").alias("fingerprint"), F.lit("info").alias("severity"), begin.cast("int").alias("begin"))


def match_items(matches: DataFrame) -> DataFrame:
    """``path, kind, file_url, lines, license, similarity, purl``: items of the summary of matches."""
    rows = valid_matches(matches)
    numbers = C.line_numbers(F.col("lines"))
    snippet = F.col("id") == "snippet"
    first, last = F.try_element_at(numbers, F.lit(1)), F.try_element_at(numbers, F.lit(-1))
    url = F.when(snippet, F.concat(F.col("path"), F.lit("#L"), first.cast("string"), F.lit("-L"), last.cast("string"))).otherwise(F.col("path"))
    text = F.when(snippet, F.concat(first.cast("string"), F.lit("-"), last.cast("string"))).otherwise("all")
    return rows.select("file_ord", "match_ord", "path", F.when(snippet, "snippet").otherwise("file").alias("kind"), url.alias("file_url"), text.alias("lines"), F.try_element_at(F.transform("licenses", lambda x: x["name"]), F.lit(1)).alias("license"), F.col("matched").alias("similarity"), F.element_at("purl", 1).alias("purl"))


def best_components(responses: DataFrame) -> DataFrame:
    """``path_id`` and its component of order 1 with its first version; of several answers for a path the last counts.
    ``responses`` has ``answer_ord, path_id, components``."""
    chosen = F.element_at(F.filter("components", lambda c: (c["order"] == 1) & (F.size(c["versions"]) > 0)), 1)
    rows = responses.filter(F.exists("components", lambda c: (c["order"] == 1) & (F.size(c["versions"]) > 0))).select("answer_ord", "path_id", chosen.alias("c"))
    last = rows.groupBy("path_id").agg(F.max_by("c", "answer_ord").alias("c"))
    return last.select("path_id", "c.purl", "c.name", "c.vendor", F.element_at("c.versions", 1)["version"].alias("version"), F.element_at("c.versions", 1)["licenses"].alias("licenses"))


def folder_entries(claims: DataFrame, best: DataFrame, files: DataFrame) -> DataFrame:
    """Match entries of the files that a folder's component claims."""
    rows = claims.join(best, "path_id").join(files.select("path", "text"), "path")
    return rows.select("path", F.lit("file").alias("id"), F.lit("100%").alias("matched"), F.lit("pending").alias("status"), "purl", F.col("name").alias("component"), "version", C.purl_url(F.col("purl")).alias("url"), F.md5("text").alias("file_hash"), F.md5("text").alias("source_hash"))


def markdown_lines(rows: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """``place, line``: a table of any size as Markdown, its rows in order; header and rule have the places -1 and 0."""
    head = rows.sparkSession.createDataFrame([(-1, " | ".join(columns)), (0, " | ".join("-" for _ in columns))], "place long, line string")
    cells = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return head.unionByName(numbered(rows, order, "place").select("place", cells.alias("line")))


def folder_cyclonedx(best: DataFrame) -> DataFrame:
    """``purl, component, version, licenses`` of the components of a folder scan, for :func:`quarrylens.sources.writers.cyclonedx`;
    ``best`` as :func:`best_components` gives it, each purl and version once."""
    names = F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform("licenses", lambda x: F.coalesce(x["spdx_id"], x["name"])), lambda n: F.coalesce(n, F.lit("")) != ""))), ",")
    return best.select("purl", F.col("name").alias("component"), "version", F.coalesce(names, F.lit("")).alias("licenses")).distinct()


def markdown_table(header: list[str], rows: list[list[str]], centred: tuple[int, ...] = ()) -> str:
    """A small table as Markdown; rendered on the driver from a result that has been collected on purpose."""
    line = lambda cells: " | ".join(cells)
    return "\n".join([line(header), line([":-:" if k in centred else "-" for k in range(len(header))]), *map(line, rows)])


def jira_table(header: list[str], rows: list[list[str]]) -> str:
    """The same for Jira; rows of another width than the header are left out."""
    body = ["|" + "|".join(r) + "|" for r in rows if len(r) == len(header)]
    return "\n".join(["|*" + "*|*".join(header) + "*|", *body])
