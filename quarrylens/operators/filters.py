"""Which folders, files, snippets and results take part: predicates as column expressions.

All are narrow: they run in the scan's stage, and those on path and length alone run before a file's content is read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import fixed_values as V
from quarrylens.operators.gitignore import ignored


def endings_pattern(endings: list[str]) -> str:
    return "(?:" + "|".join(re.escape(e).replace("\\-", "-") for e in endings) + ")$"


def folders(path: Column) -> Column:
    """Names of the folders above a file."""
    parts = F.split(path, "/")
    return F.slice(parts, 1, F.size(parts) - 1)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder_skipped(path: Column, hidden: bool = False, all_folders: bool = False, skip_folders: tuple[str, ...] = (), patterns: tuple[str, ...] = ()) -> Column:
    """Whether a folder above the file cuts it off: hidden, listed, by ending, or by an ignore pattern."""
    dirs = folders(path)
    is_hidden = F.lit(False) if hidden else F.exists(dirs, lambda d: d.startswith(".") & (d != "."))
    if all_folders:
        return is_hidden
    listed = F.exists(dirs, lambda d: F.lower(d).isin(*V.SKIPPED_DIRS) | F.lower(d).rlike(endings_pattern(V.SKIPPED_DIR_ENDINGS)) | (d.isin(*skip_folders) if skip_folders else F.lit(False)))
    above = F.concat(F.array_join(dirs, "/"), F.lit("/"))
    by_pattern = ignored(above, list(patterns)) if patterns else F.lit(False)
    return is_hidden | listed | by_pattern


def file_skipped(path: Column, hidden: bool = False, all_extensions: bool = False, skip_extensions: tuple[str, ...] = (), patterns: tuple[str, ...] = (), folder_hash: bool = False) -> Column:
    """Whether the file itself is left out: hidden, listed, by ending, or by an ignore pattern."""
    name = file_name(path)
    lowered = F.lower(name)
    is_hidden = F.lit(False) if hidden else F.exists(F.split(path, "/"), lambda p: p.startswith(".") & (p != "."))
    if all_extensions:
        return is_hidden
    out = is_hidden | lowered.isin(*(V.SKIPPED_FILES_FOLDER_HASH if folder_hash else V.SKIPPED_FILES))
    if not folder_hash:
        out = out | lowered.rlike(endings_pattern(V.SKIPPED_ENDINGS))
    for ending in skip_extensions:
        out = out | lowered.endswith(ending)
    return out | ignored(path, list(patterns)) if patterns else out


def size_kept(path: Column, size: Column, skip_size: int = 0, rules: list[tuple[list[str], int | None, int | None]] = ()) -> Column:
    """Empty files go; a smallest size overrides the rules; else the first rule whose patterns match sets inclusive bounds."""
    if skip_size > 0:
        return (size > 0) & (size >= skip_size)
    kept = F.lit(True)
    for patterns, least, most in reversed(list(rules)):
        within = size >= (least or 0)
        kept = F.when(ignored(F.lower(path), patterns), within & (size <= most) if most is not None else within).otherwise(kept)
    return (size > 0) & kept


def scanned_files(files: DataFrame, patterns: tuple[str, ...] = (), **size_options) -> DataFrame:
    """Files that a scan takes; ``files`` has ``path`` and ``size``."""
    path = F.col("path")
    return files.filter(~folder_skipped(path, patterns=patterns) & ~file_skipped(path, patterns=patterns) & size_kept(path, F.col("size"), **size_options))


def snippets_made(path: Column, text: Column, all_extensions: bool = False) -> Column:
    """Whether fingerprints of snippets are made for the file."""
    if all_extensions:
        return F.lit(True)
    head = F.lower(F.trim(F.regexp_replace(F.substring(text, 1, V.MIN_SNIPPET_CHARS - 1), r"^\s+|\s+$", "")))
    first_line = F.when(F.locate("\n", text) > 0, F.locate("\n", text) - 1).otherwise(F.length(text) - 1)
    return ~(
        F.lower(path).rlike(endings_pattern(V.SNIPPETLESS_ENDINGS))
        | (F.length(text) <= V.MIN_SNIPPET_CHARS)
        | head.rlike(r"^(?:\{|\[|<\?xml|<html|<ac3d|<!doc)")
        | (first_line > V.MAX_FIRST_LINE)
    )


def is_binary(content: Column) -> Column:
    """Whether a file's content is taken as binary: it has a zero byte."""
    return F.contains(content, F.unhex(F.lit("00")))


def listed(files: DataFrame, paths: DataFrame, patterns: tuple[str, ...] = (), **size_options) -> DataFrame:
    """Files of an explicit list (``path``) that a scan takes; names without a file are left out, folders above a file don't matter."""
    path = F.col("path")
    kept = files.filter(~file_skipped(path, patterns=patterns) & size_kept(path, F.col("size"), **size_options))
    return kept.join(paths.select("path").distinct(), "path", "left_semi")


def hashed_files(files: DataFrame, patterns: tuple[str, ...] = (), **size_options) -> DataFrame:
    """Files that folder hashes are made of: no folder is left out as a whole, and fewer names are listed."""
    path = F.col("path")
    return files.filter(~file_skipped(path, patterns=patterns, folder_hash=True) & size_kept(path, F.col("size"), **size_options))


def valid_matches(matches: DataFrame) -> DataFrame:
    """Matches that reports count: found, no dependency, with a status and a purl."""
    return matches.filter("id NOT IN ('none', 'dependency') AND status IS NOT NULL AND size(purl) > 0")


def under(path: Column, prefix: Column) -> Column:
    """Whether the path is the prefix or lies below it; an empty prefix holds for all."""
    bare = F.regexp_replace(F.coalesce(prefix, F.lit("")), "/+$", "")
    return (bare == "") | (path == bare) | path.startswith(F.concat(bare, F.lit("/")))


def path_prefixes(path: Column) -> Column:
    """The path and all folders above it: the prefixes that :func:`under` holds for, to join by equality."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def delta_safe(path: Column) -> Column:
    """Whether a listed path stays inside the tree once ``.`` and ``..`` are resolved."""
    parts = F.filter(F.split(F.regexp_replace(path, "^/+", ""), "/"), lambda p: (p != "") & (p != "."))
    depth = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")),
        lambda a, p: F.struct((a["at"] + F.when(p == "..", -1).otherwise(1)).alias("at"), F.least(a["least"], a["at"] + F.when(p == "..", -1).otherwise(1)).alias("least")),
        lambda a: a["least"],
    )
    return depth >= 0


def results_filtered(first_matches: DataFrame, match_types: list[str] = (), statuses: list[str] = ()) -> DataFrame:
    """First matches by type and status; unknown values are refused before anything runs."""
    for given, known in ((match_types, ("file", "snippet")), (statuses, ("pending", "identified"))):
        if wrong := [x for x in given if x not in known]:
            raise ValueError(f"unknown filter values {wrong}; known: {known}")
    out = first_matches
    if match_types:
        out = out.filter(F.col("id").isin(*match_types))
    return out.filter(F.col("status").isin(*statuses)) if statuses else out
