"""Readers of documents too large for one row: fingerprint files, and files that hold one JSON object.

Fingerprint files are read in byte ranges, as Spark splits text, and records that cross from one range into the next are put together. A JSON
object is read in order by one task a file, a piece at a time, and gives a row for each of its entries; files are read side by side.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrylens.operators.dependencies import INVENTORY
from quarrylens.sources.readers import RESULT, parsed_wfp
from quarrylens.sources.walks import opened

PIECES = "doc_path string, block long, place long, begins boolean, wfp string"
#: Bytes of a JSON file that are read at a time, at first.
CHUNK = 1 << 20


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a byte range, in order, as records (numbered from 1) and what comes before the first one (place 0)."""
    key, place, lines = None, 0, []
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["doc_path", "block", "place", "begins", "wfp"])

    def close() -> None:
        if key is not None:
            out.append((*key, place, place > 0, "".join(lines)))

    for rows in batches:
        for path, block, line in zip(*(rows.column(c).to_pylist() for c in range(3)), strict=True):
            if (path, block) != key:
                close()
                key, place, lines = (path, block), 0, []
            if line.startswith("file="):
                close()
                place, lines = place + 1, []
            lines.append(line + "\n")
        if out:
            yield batch()
            out = []
    close()
    if out:
        yield batch()


def wfp_pieces(spark: SparkSession, path: str) -> DataFrame:
    """``doc_path, record, wfp``: the texts of the records of fingerprint files, numbered from 0 in each file.

    What stands before a range's first record belongs to the last record of the ranges before it. Only such ends, and one row per range, are shuffled.
    Lines before the first record of a file are left out."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("doc_path"), F.col("_metadata.file_block_start").alias("block"), "value")
    pieces = lines.mapInArrow(_pieces, PIECES)
    # a range without any record start has place 0 alone
    ranges = pieces.groupBy("doc_path", "block").agg(F.max("place").alias("starts"), F.max(F.when(~F.col("begins"), F.lit(True))).alias("goes_on"))
    order = Window.partitionBy("doc_path").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("starts") > 0, F.struct("block", F.col("starts").alias("place"))), ignorenulls=True).over(earlier)
    ranges = ranges.select("doc_path", "block", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("before"), last.alias("owner"), "goes_on")
    numbered = pieces.join(ranges, ["doc_path", "block"])
    records = numbered.filter("begins").select("doc_path", "block", "place", (F.col("before") + F.col("place") - 1).alias("record"), "wfp")
    rest = numbered.filter("NOT begins AND owner IS NOT NULL").select("doc_path", F.col("owner.block").alias("block"), F.col("owner.place").alias("place"), F.col("block").alias("from"), "wfp")
    rest = rest.groupBy("doc_path", "block", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("from", "wfp"))), lambda x: x["wfp"]), "").alias("more"))
    return records.join(rest, ["doc_path", "block", "place"], "left").select("doc_path", "record", F.concat("wfp", F.coalesce("more", F.lit(""))).alias("wfp"))


def wfp_records(spark: SparkSession, path: str) -> DataFrame:
    """The fields of :func:`.readers.wfp_records`, with ``doc_path`` and ``record``, however large a file is."""
    return parsed_wfp(wfp_pieces(spark, path), keep=("doc_path", "record"))


class _Text:
    """The text of a stream, of which only what is still needed is held."""

    def __init__(self, chunks: Iterator[str]):
        self.chunks, self.text, self.at, self.want = chunks, "", 0, 1
        self.ended = False

    def more(self) -> bool:
        """Read on; after each failed try twice as much, so that a long entry is looked at a few times only."""
        parts, size = [], 0
        while size < self.want and not self.ended:
            chunk = next(self.chunks, None)
            if chunk is None:
                self.ended = True
            else:
                parts.append(chunk)
                size += len(chunk)
        self.text, self.at = self.text[self.at :] + "".join(parts), 0
        self.want = max(self.want, 2 * len(self.text))
        return bool(parts)

    def peek(self) -> str:
        """The next character that is no white space, or an empty text at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n﻿":
                self.at += 1
            if self.at < len(self.text):
                return self.text[self.at]
            self.want = 1
            if not self.more():
                return ""

    def take(self, wanted: str) -> str:
        if (found := self.peek()) not in tuple(wanted):
            raise ValueError(f"JSON text has {found!r} where one of {list(wanted)} must stand")
        self.at += 1
        return found

    def value(self) -> tuple[object, str]:
        """The next value and its text."""
        self.peek()
        self.want = 1
        while True:
            try:
                found, stop = _DECODER.raw_decode(self.text, self.at)
                # a number may go on in what isn't read yet
                if self.ended or (stop < len(self.text) and self.text[stop] not in "0123456789.eE+-"):
                    raw, self.at = self.text[self.at : stop], stop
                    return found, raw
                problem = None
            except json.JSONDecodeError as e:
                problem = e
            if not self.more() and problem is not None:
                raise ValueError(f"JSON text can't be read: {problem.msg}")


_DECODER = json.JSONDecoder()


def json_entries(chunks: Iterator[str], field: str | None = None) -> Iterator[tuple[str | None, str]]:
    """Key and text of the values of one JSON object, in order; with ``field`` the texts of the items of the list under that key. What is held at a time is one
    entry and a chunk. An empty text has no entries; what isn't an object, or isn't JSON, is an error."""
    text = _Text(chunks)
    if not text.peek():
        return
    text.take("{")
    if text.peek() == "}":
        text.take("}")
    else:
        while True:
            if text.peek() != '"':
                raise ValueError("a key of a JSON object must be a text")
            key, _ = text.value()
            text.take(":")
            if field is None:
                yield key, text.value()[1]
            elif key == field and text.peek() == "[":
                text.take("[")
                while text.peek() != "]":
                    yield None, text.value()[1]
                    if text.peek() != "]":
                        text.take(",")
                text.take("]")
            else:
                text.value()
            if text.take(",}") == "}":
                break
    if text.peek():
        raise ValueError("JSON text goes on after its object")


def _chunks(path: str) -> Iterator[str]:
    import codecs

    system, there = opened(path)
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    with system.open_input_stream(there) as stream:
        while data := stream.read(CHUNK):
            yield decoder.decode(data)
    yield decoder.decode(b"", True)


def entries_of(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    """``doc_path, ord, key, value`` of the entries of the JSON objects in files, see :func:`json_entries`."""
    files = spark.read.format("binaryFile").load(path).select("path").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, size = [], 0
                for number, (key, value) in enumerate(json_entries(_chunks(file), field)):
                    rows.append((file, number, key, value))
                    size += len(value)
                    if size >= CHUNK:
                        yield _rows(rows)
                        rows, size = [], 0
                yield _rows(rows)

    return files.mapInArrow(run, "doc_path string, ord long, key string, value string")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["doc_path", "ord", "key", "value"])


def _matches(value: Column) -> Column:
    return F.from_json(value, RESULT.removeprefix("map<string,").removesuffix(">"))


def scan_results(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`.readers.scan_results`, however large a document is."""
    files = entries_of(spark, path).select("doc_path", F.col("ord").cast("int").alias("file_ord"), F.col("key").alias("path"), _matches(F.col("value")).alias("matches"))
    return files.select("doc_path", "file_ord", "path", F.posexplode("matches").alias("match_ord", "m")).select("doc_path", "file_ord", "match_ord", "path", "m.*")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Dependency inventories for :func:`quarrylens.operators.dependencies.flattened`, a row for each file that one lists."""
    item = entries_of(spark, path, "files").select(F.concat(F.lit('{"files":['), "value", F.lit("]}")).alias("value"))
    return item.select(F.from_json("value", INVENTORY).alias("x")).select("x.*")
