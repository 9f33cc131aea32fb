"""Rollups over folders: every file counts for all folders above it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.functions import codecs
from quarrylens.functions.columns import suffix
from quarrylens.functions.udfs import crc64, word_hashes
from quarrylens.operators.hamming import near_hashes
from quarrylens.operators.reports import numbered
from quarrylens.session import checkpointed

MIN_FILES, MIN_NAME_BYTES = 8, 32


def in_folders(files: DataFrame, depth: int | None = None) -> DataFrame:
    """``dir, depth`` and the columns of ``files``, for every folder above a file (``.`` is the root, depth 1)."""
    parts = F.split("path", "/")
    dirs = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.when(n == 0, F.lit(".")).otherwise(F.array_join(F.slice(parts, 1, n), "/")))
    if depth is not None:
        dirs = F.slice(dirs, 1, depth)
    return files.select("*", F.posexplode(dirs).alias("above", "dir")).withColumn("depth", F.col("above") + 1).drop("above")


def folder_totals(files: DataFrame, depth: int | None = None) -> DataFrame:
    """``dir, depth, n_files, n_bytes`` of whole subtrees."""
    return in_folders(files.select("path", "size"), depth).groupBy("dir", "depth").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"))


def extension_counts(files: DataFrame, depth: int | None = None) -> DataFrame:
    """``dir, extension, n_files``; extensions without the dot, case-sensitive."""
    rows = in_folders(files.select("path"), depth).withColumn("suffix", suffix(F.col("path"))).withColumn("extension", F.expr("substring(suffix, 2)"))
    return rows.filter("extension <> ''").groupBy("dir", "extension").agg(F.count(F.lit(1)).alias("n_files"))


def extension_maps(counts: DataFrame) -> DataFrame:
    return counts.groupBy("dir").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("extension", "n_files")))).alias("lang_extensions"))


@F.pandas_udf(T.LongType())
def _key_hash(keys: pd.Series) -> pd.Series:
    """FNV-1 of the eight big-endian bytes of each key."""
    rows = keys.to_numpy(np.int64).view(np.uint64)
    value = np.full(len(rows), codecs.FNV_BASIS, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(8):
            value = (value * np.uint64(codecs.FNV_PRIME)) ^ ((rows >> np.uint64(56 - 8 * k)) & np.uint64(255))
    return pd.Series(value.view(np.int64))


def _bit_sums(value: Column) -> list[Column]:
    """For each bit how many more values have it than lack it."""
    return [F.sum(F.when(F.shiftright(value, b).bitwiseAND(F.lit(1)) == 1, 1).otherwise(-1)).alias(f"b{b}") for b in range(64)]


def _of_sums() -> Column:
    """Simhash in hex from the sums of bits; a tie sets the bit."""
    return F.lower(F.conv(F.concat(*[F.when(F.coalesce(F.col(f"b{b}"), F.lit(0)) >= 0, "1").otherwise("0") for b in range(63, -1, -1)]), 2, 16))


def _names_hash(names: DataFrame, column: str) -> DataFrame:
    """``dir, column``: simhash of the words of all distinct ``name`` of each ``dir``."""
    words = names.select("dir", "name").distinct().select("dir", F.explode(word_hashes("name")).alias("word"))
    return words.groupBy("dir").agg(*_bit_sums(F.col("word"))).select("dir", _of_sums().alias(column))


def folder_simhashes(files: DataFrame, depth: int = 1) -> DataFrame:
    """``dir, depth, n_files, sim_hash_names, sim_hash_dir_names, sim_hash_content`` (unpadded hex).

    A folder counts its whole subtree. Its hashes are null if it has fewer than ``MIN_FILES`` files, or their names, repeated ones too,
    have fewer than ``MIN_NAME_BYTES`` bytes in all. The words of the distinct names without suffix, the words of
    the distinct names of all folders on the way to its files, and the checksums of all contents are hashed. Every hash is
    summed bit by bit with partial aggregation, so the root folder, which holds every file, is no hot group."""
    rows = files.withColumn("base", F.element_at(F.split("path", "/"), -1)).withColumn("ext", suffix(F.col("path")))
    rows = rows.withColumn("name", F.expr("left(base, length(base) - length(ext))")).withColumn("key", _key_hash(crc64(F.encode("text", "UTF-8"))))
    rows = rows.withColumn("name_bytes", F.octet_length("base")).withColumn("dirs", F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1))
    rows = in_folders(rows.select("path", "name", "name_bytes", "dirs", "key"), depth)
    sums = rows.groupBy("dir", "depth").agg(F.count(F.lit(1)).alias("n_files"), F.sum("name_bytes").alias("name_bytes"), *_bit_sums(F.col("key")))
    sums = sums.select("dir", "depth", "n_files", "name_bytes", _of_sums().alias("content"))
    names = _names_hash(rows, "of_names")
    dirs = _names_hash(rows.select("dir", F.explode("dirs").alias("name")).filter("name NOT IN ('', '.', '..')"), "of_dirs")
    joined = sums.join(names, "dir", "left").join(dirs, "dir", "left")
    large = (F.col("n_files") >= MIN_FILES) & (F.col("name_bytes") >= MIN_NAME_BYTES)
    # without any word all sums are 0, and all bits set
    full = lambda c: F.when(large, F.coalesce(c, F.lit("f" * 16)))
    return joined.select("dir", "depth", "n_files", full(F.col("of_names")).alias("sim_hash_names"), full(F.col("of_dirs")).alias("sim_hash_dir_names"), F.when(large, F.col("content")).alias("sim_hash_content"))


#: Sorts after all names of a folder.
_LAST = "\U0010ffff"


def _folder_fields(files: DataFrame, depth: int) -> DataFrame:
    """``dir, depth, up, fields``: the fields of every folder down to ``depth`` as a JSON object, and the folder around it."""
    maps = extension_maps(extension_counts(files, depth))
    rows = folder_simhashes(files, depth).join(maps, "dir", "left")
    rows = rows.withColumn("lang_extensions", F.when(F.col("sim_hash_content").isNotNull(), F.coalesce("lang_extensions", F.create_map().cast("map<string,bigint>"))))
    up = F.when(F.col("dir").contains("/"), F.regexp_replace("dir", "/[^/]*$", "")).otherwise(F.lit("."))
    fields = F.to_json(F.struct(F.col("dir").alias("path_id"), "sim_hash_names", "sim_hash_content", "sim_hash_dir_names", "lang_extensions"), {"ignoreNullFields": "false"})
    return rows.select("dir", "depth", up.alias("up"), fields.alias("fields"))


def folder_lines(files: DataFrame, depth: int = 1) -> DataFrame:
    """``place, line``: the request for a whole tree (the row of ``.`` in :func:`folder_documents`) as lines, however deep and wide the tree is.

    A folder opens with its fields and closes after the last folder inside. Both events are sorted by the names on the way to the folder, the end after all
    names, so no row holds more than a folder's own fields, and none are collected in a group. Lines joined in order are one JSON object."""
    rows = _folder_fields(files, depth)
    first = rows.filter("dir <> '.'").groupBy("up").agg(F.min("dir").alias("first"))
    rows = rows.join(first, "up", "left")
    names = F.when(F.col("dir") == ".", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    comma = F.when((F.col("dir") != ".") & (F.col("dir") != F.col("first")), ",").otherwise("")
    opens = F.struct(names.alias("at"), F.concat(comma, F.expr("left(fields, length(fields) - 1)"), F.lit(',"children":[')).alias("line"))
    closes = F.struct(F.concat(names, F.array(F.lit(_LAST))).alias("at"), F.lit("]}").alias("line"))
    events = rows.select(F.explode(F.array(opens, closes)).alias("e")).select("e.*")
    return numbered(events, ["at"], "place").select("place", "line")


def folder_documents(files: DataFrame, depth: int = 1) -> DataFrame:
    """``dir, depth, json``: every folder down to ``depth`` as an object with its hashes, extensions and children; the row of ``.`` is
    the request for the whole tree. Children are put into their folder one level at a time, from the deepest."""
    rows = _folder_fields(files, depth)
    out = children = None
    for level in range(depth, 0, -1):
        here = rows.filter(F.col("depth") == level)
        if children is not None:
            here = here.join(children, F.col("dir") == F.col("parent"), "left").drop("parent")
        else:
            here = here.withColumn("inner", F.lit(None).cast("string"))
        here = here.select("dir", "depth", "up", F.concat(F.expr("left(fields, length(fields) - 1)"), F.lit(',"children":['), F.coalesce("inner", F.lit("")), F.lit("]}")).alias("json"))
        children = here.groupBy(F.col("up").alias("parent")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dir", "json"))), lambda x: x["json"]), ",").alias("inner"))
        out = here.drop("up") if out is None else out.unionByName(here.drop("up"))
    return out


#: A folder's hashes, and what a folder scan asks for by default.
FOLDER_HASHES = ("sim_hash_names", "sim_hash_dir_names", "sim_hash_content")
RANKS, RECURSIVE_SCORE, LEAST_SCORE, FOLDER_BITS = 5, 0.8, 0.15, 8


def _hash_rows(rows: DataFrame, name: str, hashes: tuple[str, ...]) -> DataFrame:
    kinds = F.explode(F.array(*[F.struct(F.lit(h).alias("kind"), F.conv(F.col(h), 16, -10).cast("long").alias("hash")) for h in hashes]))
    return rows.select(F.col(name).alias("name"), kinds.alias("k")).select("name", "k.*").filter("hash IS NOT NULL")


def folder_matches(
    ours: DataFrame, base: DataFrame, hashes: tuple[str, ...] = FOLDER_HASHES, within: int = FOLDER_BITS,
    ranks: int = RANKS, recursive_score: float = RECURSIVE_SCORE, least_score: float = LEAST_SCORE,
) -> DataFrame:
    """``dir, kb_dir, n_hashes, distance, score, rank``: folders of a local base that are like ours (an extension: the base of the original is remote).

    Hashes (unpadded hex, columns of both tables; the base has ``kb_dir`` for ``dir``) are joined where they differ in at most ``within`` bits. The score is the mean over ``hashes`` of
    ``1 - distance / 64``, 0 for those that aren't near. Folders of the base are ranked by score and then name; ``ranks`` of them with ``least_score`` or more stay. Folders below one
    that has a match of ``recursive_score`` or more are answered by that one and left out."""
    mine, theirs = checkpointed(_hash_rows(ours, "dir", hashes)), checkpointed(_hash_rows(base, "kb_dir", hashes))
    near = near_hashes(mine, theirs, within, ("kind",))
    found = near.join(mine.select("kind", F.col("hash").alias("hash_a"), F.col("name").alias("dir")), ["kind", "hash_a"])
    found = found.join(theirs.select("kind", F.col("hash").alias("hash_b"), F.col("name").alias("kb_dir")), ["kind", "hash_b"])
    pairs = found.groupBy("dir", "kb_dir").agg(F.count(F.lit(1)).cast("int").alias("n_hashes"), F.sum("distance").cast("int").alias("distance"))
    score = (F.col("n_hashes") - F.col("distance") / 64) / len(hashes)
    place = F.row_number().over(Window.partitionBy("dir").orderBy(F.desc("score"), "kb_dir"))
    best = pairs.withColumn("score", score).filter(F.col("score") >= least_score).withColumn("rank", place).filter(F.col("rank") <= ranks)
    done = best.filter((F.col("rank") == 1) & (F.col("score") >= recursive_score)).select(F.col("dir").alias("above"))
    up = F.expr("transform(sequence(0, size(split(dir, '/')) - 1), n -> if(n = 0, '.', array_join(slice(split(dir, '/'), 1, n), '/')))")
    inside = best.select("dir").distinct().filter("dir <> '.'").select("dir", F.explode(up).alias("above")).filter("above <> dir")
    return best.join(inside.join(done, "above").select("dir").distinct(), "dir", "left_anti")
