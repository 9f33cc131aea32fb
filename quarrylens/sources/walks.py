"""A reader of source trees that doesn't enter folders which a scan skips.

A tree is walked level by level: the folders of a level are dealt to tasks, which list them; the filters on folders, as columns, decide which of the folders found are
listed next. So a skipped folder (a dependency cache with a million files, say) costs one entry and no listing, and one level of a large tree is listed by
many tasks. Contents are read last, by tasks, for the files that are taken alone. Each level is written to the shared checkpoint folder.

Paths are those of local or shared mounts, or any other that pyarrow opens by its scheme. Links to folders are not followed.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.operators.filters import file_skipped, folder_skipped, size_kept
from quarrylens.session import checkpointed

ENTRIES = "path string, is_folder boolean, size long"
#: Folders and bytes of files that a task takes at a time.
FOLDERS, CONTENT_BYTES = 64, 32 << 20


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root if "://" in root else "file://" + root.removeprefix("file:"))
    return fs.LocalFileSystem(), os.path.abspath(root)


def _listed(system: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """Name, whether it is a folder, and size of the entries of a folder."""
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(folder) as entries:
            for e in entries:
                if e.is_dir(follow_symlinks=False):
                    yield e.name, True, 0
                elif e.is_file():
                    yield e.name, False, e.stat().st_size
        return
    for info in system.get_file_info(fs.FileSelector(folder)):
        if info.type in (fs.FileType.Directory, fs.FileType.File):
            yield info.base_name, info.type == fs.FileType.Directory, info.size or 0


def walked(spark: SparkSession, root: str, patterns: tuple[str, ...] = (), everything: bool = False) -> DataFrame:
    """``path`` (below the root), ``is_folder, size`` of all that stands in folders which a scan enters (``everything``: in all).

    A root that is missing or no folder has no entries."""
    system, base = opened(root)
    if system.get_file_info(base).type != fs.FileType.Directory:
        return spark.createDataFrame([], ENTRIES)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, top = opened(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                rows = list(_listed(there, f"{top}/{folder}" if folder else top))
                paths = pa.array([f"{folder}/{name}" if folder else name for name, _, _ in rows], pa.string())
                yield pa.RecordBatch.from_arrays([paths, pa.array([d for _, d, _ in rows], pa.bool_()), pa.array([n for _, _, n in rows], pa.int64())], names=["path", "is_folder", "size"])

    levels, folders = [], spark.createDataFrame([("",)], "path string")
    while True:
        parts = max(1, -(-folders.count() // FOLDERS))
        levels.append(checkpointed(folders.repartition(min(parts, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(entries, ENTRIES)))
        entered = F.lit(True) if everything else ~folder_skipped(F.concat("path", F.lit("/-")), patterns=patterns)
        folders = levels[-1].filter("is_folder").filter(entered).select("path")
        if folders.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def contents_of(files: DataFrame, root: str) -> DataFrame:
    """``files`` (``path, size``) with their ``content``; read by tasks, a bounded number of bytes at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(root)
        held: list[tuple[str, int, bytes]] = []
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.binary()))], names=["path", "size", "content"])
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_stream(f"{top}/{path}") as stream:
                    held.append((path, size, stream.read()))
                if sum(len(c) for _, _, c in held) >= CONTENT_BYTES:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)

    return files.select("path", "size").mapInArrow(read, "path string, size long, content binary")


def scanned_tree(spark: SparkSession, root: str, patterns: tuple[str, ...] = (), folder_hash: bool = False, **size_options) -> DataFrame:
    """``path, size, content`` of the files of a tree that a scan takes, or that a folder's hash is made of: those of :func:`.readers.source_tree`, without listing what is skipped."""
    files = walked(spark, root, patterns, everything=folder_hash).filter("NOT is_folder")
    kept = ~file_skipped(F.col("path"), patterns=patterns, folder_hash=folder_hash) & size_kept(F.col("path"), F.col("size"), **size_options)
    if not folder_hash:
        kept = kept & ~folder_skipped(F.col("path"), patterns=patterns)
    return contents_of(files.filter(kept), root)
