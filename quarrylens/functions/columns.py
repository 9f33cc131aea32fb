"""Small scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrylens.functions.fixed_values import LICENSE_SOURCES


def normalised(text: Column) -> Column:
    """Digits and lower-cased letters of ASCII; all else is dropped."""
    return F.lower(F.regexp_replace(text, "[^0-9A-Za-z]", ""))


def opposite_eol_md5(text: Column, binary: Column | None = None) -> Column:
    """MD5 of the text with the other kind of line ends; null without line ends or for binary content."""
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    only_crlf = text.contains("\r\n") & ~text.rlike(r"(?:^|[^\r])\n|\r(?:[^\n]|$)")
    out = F.md5(F.when(only_crlf, unix).otherwise(F.replace(unix, F.lit("\n"), F.lit("\r\n"))))
    found = text.rlike("[\\r\\n]")
    return F.when(found & ~binary if binary is not None else found, out)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def word_features(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([A-Za-z0-9_']+(?:://[A-Za-z0-9_./]+)?)"), F.lit(1))


def shingles(words: Column, width: int) -> Column:
    """Runs of ``width`` words joined by spaces; of fewer words, all of them."""
    if width < 1:
        raise ValueError("shingles have one word at least")

    def of(w: Column) -> Column:
        n = F.least(F.lit(width), F.greatest(F.size(w), F.lit(1)))
        made = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) > 0, made).otherwise(F.array().cast("array<string>"))

    # the words are bound once; as an expression they would be made anew for each shingle
    return F.transform(F.array(words), of)[0]


def line_numbers(lines: Column) -> Column:
    """``32-161`` or ``1-5,9-12`` as numbers; empty for ``all``."""
    return F.transform(F.filter(F.split(lines, "[,-]"), lambda x: x.rlike("^[0-9]+$")), lambda x: x.cast("int"))


def purl_base(purl: Column) -> Column:
    return F.substring_index(purl, "@", 1)


def purl_version(purl: Column) -> Column:
    return F.substring_index(purl, "@", -1)


def purl_part(purl: Column, part: str) -> Column:
    """``type``, ``namespace`` or ``name`` of a package URL, decoded."""
    bare = F.regexp_replace(F.regexp_replace(purl, r"^pkg:/*", ""), r"[?#@].*$", "")
    pieces = F.split(bare, "/")
    if part == "type":
        return F.lower(F.element_at(pieces, 1))
    if part == "name":
        return F.url_decode(F.element_at(pieces, -1))
    return F.url_decode(F.array_join(F.slice(pieces, 2, F.greatest(F.size(pieces) - 2, F.lit(0))), "/"))


def purl_url(purl: Column) -> Column:
    """Web address of a package of the common types; null for others."""
    kind, space, name = (purl_part(purl, p) for p in ("type", "namespace", "name"))
    whole = F.when(space != "", F.concat(space, F.lit("/"), name)).otherwise(name)
    return (
        F.when(kind == "github", F.concat(F.lit("https://github.com/"), whole))
        .when(kind == "gitlab", F.concat(F.lit("https://gitlab.com/"), whole))
        .when(kind == "npm", F.concat(F.lit("https://www.npmjs.com/package/"), whole))
        .when(kind == "pypi", F.concat(F.lit("https://pypi.org/project/"), name, F.lit("/")))
        .when(kind == "gem", F.concat(F.lit("https://rubygems.org/gems/"), name))
        .when(kind == "cargo", F.concat(F.lit("https://crates.io/crates/"), name))
    )


def clean_purl(purl: Column) -> Column:
    return F.regexp_replace(purl, '"|%22', "")


def clean_requirement(purl: Column, requirement: Column) -> Column:
    """Requirement without the package's name before the first comparison; null if it says nothing new."""
    bare = F.regexp_replace(requirement, r"^\s*[^<>=!^]+\s*([<>=!^])", "$1")
    return F.when((F.coalesce(bare, F.lit("")) != "") & ~clean_purl(purl).endswith(bare) & ~bare.startswith("file:"), bare)


def severity(value: Column) -> Column:
    lowered = F.lower(F.coalesce(value, F.lit("")))
    return F.when(lowered == "moderate", "medium").when(lowered.isin("critical", "high", "medium", "low", "info", "none"), lowered).otherwise("unknown")


def spdx_url(license_id: Column) -> Column:
    return F.concat(F.lit("https://spdx.org/licenses/"), license_id, F.lit(".html"))


def suffix(path: Column) -> Column:
    """Last suffix of the file's name, with its dot; empty if there is none (also for dot files)."""
    return F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"^.+(\.[^.]+)$", 1)


def settings_header(settings: Column) -> Column:
    return F.base64(F.encode(F.to_json(settings), "UTF-8"))


def epoch_ms_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "dd MMM yyyy 'at' HH:mm:ss")


def project_fresh(imported: Column, vulnerabilities: Column, occurrence: Column, n_components: Column) -> Column:
    """Whether all of a project's figures are newer than its last import."""
    empty = (imported > 0) & (imported <= occurrence) & (n_components < 1)
    return F.when(empty, True).when((imported == 0) | (vulnerabilities == 0) | (occurrence == 0), False).otherwise((vulnerabilities >= imported) & (occurrence >= imported))


def copyleft(license_id: Column, listed: Column, explicit: list[str] = (), include: list[str] = (), exclude: list[str] = ()) -> Column:
    """Whether a licence is copyleft: by an explicit list alone, or by the lists and the table's status ``listed``."""
    key = F.lower(license_id)
    if explicit:
        return key.isin(*[x.lower() for x in explicit])
    out = F.coalesce(listed, F.lit(False))
    if exclude:
        out = F.when(key.isin(*[x.lower() for x in exclude]), False).otherwise(out)
    return F.when(key.isin(*[x.lower() for x in include]), True).otherwise(out) if include else out


def selected_licenses(licenses: Column, sources: list[str] = ()) -> Column:
    """Licences of the given sources (and those of none or an unknown one); without sources, those of the first
    source in order of priority that has any, one for each name, or all."""
    if sources:
        return F.filter(licenses, lambda x: x["source"].isNull() | x["source"].isin(*sources, "unknown"))
    out = licenses
    for source in reversed(LICENSE_SOURCES):
        own = F.filter(licenses, _of_source(source))
        # of items with one name the last counts, at the place of the first
        names = F.array_distinct(F.transform(own, lambda x: x["name"]))
        unique = F.transform(names, lambda name: F.element_at(F.filter(F.filter(licenses, _of_source(source)), lambda x: x["name"] == name), -1))
        out = F.when(F.size(own) > 0, unique).otherwise(out)
    return out


def _of_source(source: str):
    return lambda x: x["source"] == source


def license_keys(name: Column) -> list[Column]:
    """Keys under which a licence list is looked up, in order: lower case, each run of white space left out or a dash."""
    return [F.lower(F.regexp_replace(name, r"[\s\x1C-\x1F\x85\p{Z}]+", by)) for by in ("", "-")]
