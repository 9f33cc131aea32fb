"""Compression of vectors to short codes: product quantisation in whole numbers, with Exponion search.

A vector of whole numbers ``floor(1024 * c)`` is cut into equal consecutive parts. Each part has a codebook; a vector's code is the
index of the nearest entry of each part's codebook. Codebooks start as the parts of the vectors with the smallest ids, and each
round replaces an entry by the mean of its parts, rounded down.

The nearest entry is found by Exponion search. A part starts at its entry of the round before, at the distance ``u``. An entry that is
as near lies within ``2 u`` of that entry (triangle inequality), that is, within ``4 u^2`` in squares, which are whole numbers. So the
part scans that entry's list of neighbours, sorted by distance, up to this radius, and no others. Ties go to the lower index. Parts
with the same start scan together, in tiers of lists that double in length. Distances are exact: in doubles while all sums stay
below 2^53, else in 64-bit integers.

A round is one pass over a table in the shared folder: each task writes its rows with their new codes, and after them a row for every
entry that it used, with the number and sums of its parts; the columns of these rows alone are read to sum them up. What a lost task
wrote is not there, so nothing counts twice. Only the entries come to the driver: ``parts * entries`` rows, a fixed number. The
vectors are never shuffled, so copies and common vectors make no hot task. A table is deleted when the next one is there.

Defined results: vectors that are null, or hold null or non-finite components, are dropped, and so are those of another length than
most have (of equally frequent lengths the largest). If the length is no multiple of the parts, the first parts are one component
longer. Components beyond +-16384 count as that. Of rows with equal ids each is a row; the smallest ids are those of the first rows in
order of id and vector, null ids last. With fewer rows than entries, a codebook has as many entries as there are rows. An empty table gives an
empty table. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm.common import forget, scratch_folder, written
from quarrylens.llm.vectors import common_length, matrix, usable, whole

PARTS, ENTRIES, ROUNDS, SCALE, LARGEST = 4, 256, 4, 1024, 1 << 24
#: Rows of a task are coded in blocks of about so many components, whatever the length of vectors.
BLOCK = 1 << 21


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    largest = max((int(np.abs(a).max()) for a in (points, entries) if a.size), default=0)
    kind = np.float64 if 4 * max(1, points.shape[1]) * largest * largest < 1 << 53 else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)).astype(np.int64)


class Codebook:
    """The entries of one part, each with its neighbours in order of distance, itself and its equals first."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = squared(entries, entries)
        self.near = np.argsort(between, axis=1, kind="stable")
        self.reach = np.take_along_axis(between, self.near, axis=1)

    def nearest(self, points: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point (the lowest of equally near ones) and its squared distance."""
        from_start = points - self.entries[start]
        best, found = (from_start * from_start).sum(1), start.copy()
        order = np.argsort(start, kind="stable")
        borders = np.flatnonzero(np.diff(start[order])) + 1
        for rows in np.split(order, borders) if len(order) else ():
            entry = start[rows[0]]
            inside = np.searchsorted(self.reach[entry], 4 * best[rows], side="right")  # neighbours within the radius
            tiers = np.frexp((inside - 1).astype(float))[1]
            for tier in np.unique(tiers):
                members = rows[tiers == tier]
                scanned = np.sort(self.near[entry, : inside[tiers == tier].max()])
                distances = squared(points[members], self.entries[scanned])
                least = distances.argmin(1)  # the first of equal ones, so the lowest index
                found[members], best[members] = scanned[least], distances[np.arange(len(members)), least]
        return found, best


def cuts(dims: int, parts: int) -> list[slice]:
    """Where each part of a vector lies."""
    ends = np.cumsum([dims // parts + (k < dims % parts) for k in range(parts)])
    return [slice(int(e) - (dims // parts + (k < dims % parts)), int(e)) for k, e in enumerate(ends)]


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.Table]:
    """Batches joined to blocks of about ``BLOCK`` components: a list of neighbours is scanned by more parts at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n * max(1, dims) >= BLOCK:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _coded(table: pa.Table, codebooks: list[Codebook], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of a block, their codes and their squared distances summed over the parts."""
    x = matrix(table.column("x").combine_chunks(), dims)
    before = table.column("code").combine_chunks()
    known = before.null_count == 0
    start = np.frombuffer(b"".join(before.to_pylist()), np.uint8).reshape(len(x), -1) if known else np.zeros((len(x), len(codebooks)), np.uint8)
    codes, error = np.zeros((len(x), len(codebooks)), np.uint8), np.zeros(len(x), np.int64)
    for k, (book, cut) in enumerate(zip(codebooks, cuts(dims, len(codebooks)), strict=True)):
        codes[:, k], distance = book.nearest(x[:, cut], start[:, k].astype(np.int64))
        error += distance
    return x, codes, error


def _binary(codes: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in codes], pa.binary())


def _round(codebooks: list[np.ndarray], dims: int, schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with new codes, and at a task's end the sums of the entries that it used."""

    def coded(batches):
        books = [Codebook(entries) for entries in codebooks]
        places = cuts(dims, len(books))
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        sums = [np.zeros(b.entries.shape, np.int64) for b in books]
        kinds = None
        for table in _blocks(batches, dims):
            x, codes, _ = _coded(table, books, dims)
            kinds = table.schema.field("vec_id").type, table.schema.field("label").type
            for k, place in enumerate(places):
                order = np.argsort(codes[:, k], kind="stable")
                used, first, n = np.unique(codes[order, k], return_index=True, return_counts=True)
                counts[k][used] += n
                sums[k][used] += np.add.reduceat(x[order, place], first, axis=0)
            n = table.num_rows
            gone = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))]
            columns = [table.column(c).combine_chunks() for c in ("vec_id", "label", "x")]
            yield pa.RecordBatch.from_arrays([*columns, _binary(codes), *gone], names=schema.names)
        if kinds is not None:
            used = [np.flatnonzero(c) for c in counts]
            part, entry = np.repeat(np.arange(len(used)), [len(u) for u in used]), np.concatenate(used)
            total = [counts[p][e] for p, e in zip(part, entry, strict=True)]
            values = [sums[p][e].tolist() for p, e in zip(part, entry, strict=True)]
            n = len(part)
            blank = [pa.nulls(n, kinds[0]), pa.nulls(n, kinds[1]), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([*blank, pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(total, pa.int64()), pa.array(values, pa.list_(pa.int64()))], names=schema.names)

    return coded


def _updated(codebooks: list[np.ndarray], table: DataFrame) -> list[np.ndarray]:
    """Entries replaced by the means, rounded down, of their parts; unused ones stay."""
    if not (width := max(c.shape[1] for c in codebooks)):
        return codebooks
    used = table.filter("part IS NOT NULL").groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.try_element_at("sums", F.lit(i + 1))) for i in range(width)]).alias("sums"))
    new = [c.copy() for c in codebooks]
    for r in used.collect():  # at most parts * entries rows
        size = new[r["part"]].shape[1]
        new[r["part"]][r["entry"]] = [s // r["n"] for s in r["sums"][:size]]
    return new


def _last(codebooks: list[np.ndarray], dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def coded(batches):
        books = [Codebook(entries) for entries in codebooks]
        for table in _blocks(batches, dims):
            _, codes, error = _coded(table, books, dims)
            columns = [table.column(c).combine_chunks() for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays([*columns, _binary(codes), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return coded


def compressed(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every vector that stays, where ``code`` has a byte for each part, and the codebooks: a
    matrix of whole numbers for each part, a row an entry."""
    if not 1 <= entries <= 256:
        raise ValueError("a part of a code is one byte: entries must be between 1 and 256")
    spark = df.sparkSession
    vector = df[vector_col].cast("array<double>")
    kept = df.filter(usable(vector)).select(df[id_col].alias("vec_id"), df[label_col].alias("label"), whole(vector, scale, LARGEST, "int").alias("x"))
    id_kind, label_kind = kept.schema["vec_id"].dataType, kept.schema["label"].dataType
    dims = common_length(kept, "x")
    if dims is None:
        return spark.createDataFrame([], T.StructType([T.StructField("vec_id", id_kind), T.StructField("label", label_kind), T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])), [np.zeros((0, 0), np.int64)] * parts
    rows = kept.filter(F.size("x") == dims).withColumn("code", F.lit(None).cast("binary"))
    seeds = matrix(pa.array([r[0] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()], pa.list_(pa.int64())), dims)
    codebooks = [seeds[:, cut].copy() for cut in cuts(dims, parts)]

    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, k) for c, k in (("part", T.IntegerType()), ("entry", T.IntegerType()), ("n", T.LongType()), ("sums", T.ArrayType(T.LongType()))))])
    folder, old = scratch_folder(spark, "vector-codes"), None
    for number in range(rounds):
        table = written(rows.mapInArrow(_round(codebooks, dims, schema), schema), f"{folder}/{number}")
        codebooks = _updated(codebooks, table)
        rows = table.filter("part IS NULL").select("vec_id", "label", "x", "code")
        if old is not None:
            forget(spark, old)
        old = f"{folder}/{number}"
    last = T.StructType([schema["vec_id"], schema["label"], schema["code"], T.StructField("error", T.LongType())])
    coded = written(rows.mapInArrow(_last(codebooks, dims), last), f"{folder}/codes")
    if old is not None:
        forget(spark, old)
    return coded, codebooks


def decoded(coded: DataFrame, codebooks: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """``coded`` with ``vector``: the entries that a code names, in the units of the vectors (the middle of what an entry stands for)."""
    books = [[[(float(v) + 0.5) / scale for v in entry] for entry in book] for book in codebooks]

    @F.pandas_udf("array<double>")
    def looked_up(codes):
        return codes.map(lambda code: [v for k, e in enumerate(code) for v in books[k][e]])

    return coded.withColumn("vector", looked_up("code"))


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all entries by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for book in codebooks for v in book.ravel().tolist()).encode()).hexdigest()


def digests(df: DataFrame, **options) -> DataFrame:
    """Codes as hex digits, with errors of rows and labels (null labels are one label)."""
    coded, codebooks = compressed(df, **options)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    rows = coded.join(by_label, coded["label"].eqNullSafe(by_label["of_label"]), "left")
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
