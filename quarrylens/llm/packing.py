"""Packing of tokenised documents into sequences of a fixed length.

First-fit decreasing, run on its own in each randomised group of documents. A document is its
token ids followed by one separator id. It is cut into pieces of the sequence length; only its
last piece is shorter. Pieces of full length are sequences already, each a bin of its own. The others of a group are
placed in falling length, each into the first bin with enough room, which a tournament tree over
the free room of the bins finds in logarithmic time.

Groups are drawn by a hash of the document's id and ids, and for pieces of full length of their place too, so that book-long documents
are spread. There is a group for every ``group_docs`` documents, and for every ``group_docs`` sequences that the texts' bytes can fill at most, whatever the size
of the table, so a group has a bounded number of pieces, and the number of groups grows with the input.
Only the extent of each piece is shuffled, and what the caller carries along.

Defined results: a null text is an empty document and has the separator alone; repeated rows are packed once each, and those of
a batch are dealt to different groups, as are those of different batches of a task, so that one row repeated very often is no large group; a very
long text is encoded as a whole; an empty table gives an
empty table; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm import tokens
from quarrylens.llm.common import documents

LENGTH, SEPARATOR, GROUP_DOCS = 1024, 0, 4096
PIECES = "doc_id long, start long, length long, doc_tokens long, deal long, ids binary"
#: Rows of a batch that goes back to Spark hold about so many bytes of ids.
BATCH_BYTES = 4 << 20


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, separator: int = SEPARATOR, vocabulary: str = tokens.RANKS) -> DataFrame:
    """The pieces of every document: ``doc_id, start, length, doc_tokens, deal, ids``, where ``ids``
    are little-endian unsigned 32-bit integers and ``deal`` a hash that draws the group."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = tokens.byte_tokens(vocabulary), 0
        for batch in batches:
            out, size = _Rows(), 0
            number += 1
            seen: dict[tuple, int] = {}  # equal rows of a batch are told apart by their number, and dealt to different groups
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(np.array(encoder.ids(text.as_py()), "<u4"), np.uint32(separator)).astype("<u4")
                row = (doc_id, zlib.crc32(ids.tobytes()))
                seen[row] = seen.get(row, -1) + 1
                # the first of equal rows goes where its text says; further ones, and those of later batches, anywhere
                again = f" {seen[row]} {number}" if seen[row] or number > 1 else ""
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    deal = zlib.crc32(f"{row}{again}{f' at {start}' if len(part) == length else ''}".encode())
                    out.add(doc_id, start, len(part), len(ids), deal, part.tobytes())
                size += 4 * len(ids)
                if size >= BATCH_BYTES:
                    yield out.batch()
                    out, size = _Rows(), 0
            yield out.batch()

    return documents(docs, id_col, text_col).mapInArrow(cut, PIECES)


class _Rows:
    def __init__(self):
        self.columns = [[] for _ in range(6)]

    def add(self, *values):
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds, strict=True)], names=["doc_id", "start", "length", "doc_tokens", "deal", "ids"])


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; items are placed in falling length, ties in given order."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    leaves = 1 << max(0, int(n - 1).bit_length())
    # room[1] is the root, room[leaves + b] the free room of bin b, an inner node the larger of its two
    room = [capacity] * (2 * leaves)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[item]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node >>= 1
            larger = max(room[2 * node], room[2 * node + 1])
            if room[node] == larger:
                break
            room[node] = larger
    return bins, offsets


def pack(parts: DataFrame, n_docs: int, n_bytes: int = 0, length: int = LENGTH, group_docs: int = GROUP_DOCS) -> DataFrame:
    """``parts`` (rows of :func:`pieces`, with any columns besides) with ``sequence_id`` and ``offset``.

    ``n_docs`` and the texts' ``n_bytes``, which are as many tokens at most, set the number of groups; sequence ids are unique over all groups."""
    groups = max(1, -(-n_docs // group_docs), n_bytes // (length * group_docs))
    dealt = parts.withColumn("pack_group", F.pmod(F.xxhash64("deal"), F.lit(groups)))
    schema = T.StructType([f for f in dealt.schema if f.name not in ("deal", "pack_group")] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        lengths = table.column("length").to_numpy()
        whole = np.flatnonzero(lengths == length)
        bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        bins[whole] = np.arange(len(whole))
        rest = np.flatnonzero(lengths < length)
        placed, offsets[rest] = first_fit_decreasing(lengths[rest], length)
        bins[rest] = len(whole) + placed
        first = table.column("pack_group")[0].as_py() << 32
        table = table.drop_columns(["deal", "pack_group"])
        return table.append_column("sequence_id", pa.array(first + bins)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("pack_group").applyInArrow(place, schema)


def _extent(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents and bytes of their texts."""
    found = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(docs[text_col].cast("string")).cast("long")), F.lit(0)).alias("bytes")).first()
    return found["n"], found["bytes"]


def digests(docs: DataFrame, **options) -> DataFrame:
    """Where every piece of ``docs`` lies, with a checksum in place of its ids."""
    parts = pieces(docs, **options).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(parts, *_extent(docs, options.get("text_col", "text"))).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def sequences(docs: DataFrame, **options) -> DataFrame:
    """The sequences themselves: one row per piece, with its ids, sequence and offset."""
    return pack(pieces(docs, **options), *_extent(docs, options.get("text_col", "text")))
