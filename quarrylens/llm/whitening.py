"""Whitening of embeddings by matrix-free block subspace iteration.

A vector becomes whole numbers ``floor(256 * c)``. The covariance ``V`` of the distinct vectors is never formed: a Spark pass takes a block
``Q`` of a few columns and returns ``VQ = X'(XQ) / n`` over the centred rows ``X``. From ``Q`` and ``VQ`` the driver, which holds nothing
but matrices of ``dims`` x block, takes the Rayleigh-Ritz step (eigenvectors of ``Q'VQ``) and the residuals ``|Vu - eu|`` of the
first ``k`` Ritz vectors. These certify the components: passes end when all are at most 1e-13 of the largest eigenvalue, or, where rounding
doesn't allow that, when they stop falling below 1e-9 of it. The next block is an orthonormal basis (QR) of what the passes made of the old one.

Passes between two QR steps are combined by Chebyshev polynomials of ``V`` that are small on the eigenvalues below the block's, so that a flat
spectrum needs tens of passes and not hundreds; a steep one gets low degrees, so that no column drowns in the first. If the
residuals nearly stand still all the same, the block is doubled by random columns, up to the number of dimensions.

Each task adds up its part of ``VQ``, one row per dimension; Spark sums them by dimension. A pass holds a batch of rows at a time. Distinct vectors are
found once by a shuffle with map-side combination, so that copies arrive once per task, and written to the shared folder.

Defined results: vectors that are null, or hold null or non-finite entries, are dropped, and so are those of another length than most have (of
equally frequent lengths the largest). Entries beyond +-2^31 / 256 count as that. Components whose variance is below 1e-12 of the largest are
no components, so an empty table, a single distinct vector or vectors without entries give no rows. Rows with equal ids are rows of their own.
A deviation that no long holds is null. The largest entry of a component is positive (of equally large ones the first).
Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm.common import scratch_folder, written
from quarrylens.llm.vectors import common_length, matrix, usable, whole

SCALE, LARGEST, COMPONENTS = 256, (1 << 31) - 1, 4
#: Columns of the first block, beyond the components.
EXTRA = 28
#: Residuals, as a part of the largest eigenvalue: wanted, and good enough where they stop falling.
WANTED, ENOUGH = 1e-13, 1e-9
#: Smallest variance of a component, as a part of the largest.
LEAST = 1e-12
MOST_DEGREE, MOST_PASSES = 12, 2000


class Components(NamedTuple):
    """``vectors`` has a column for each component; ``values`` are their variances in falling order."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float
    n: int
    sums: list[int]
    identity_error: float
    passes: int


def _summed(rows: DataFrame, dims: int, width: int, task: Callable[[Iterator[np.ndarray]], np.ndarray]) -> np.ndarray:
    """The sum over all tasks of what ``task`` makes of the vectors of one: a matrix of ``width`` columns."""

    def one(batches):
        made = task(matrix(b.column(0), dims) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int32()), pa.array(made.tolist(), pa.list_(pa.float64()))], names=["place", "part"])

    parts = rows.select("x").mapInArrow(one, "place int, part array<double>")
    total = parts.groupBy("place").agg(F.array(*[F.sum(F.col("part")[j]) for j in range(width)]).alias("total"))
    found = {r["place"]: r["total"] for r in total.collect()}  # dims rows
    return np.array([found[i] for i in range(len(found))])


def _product(rows: DataFrame, mean: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """``VQ``: one pass over the rows."""

    def task(vectors):
        total = np.zeros(q.shape)
        for x in vectors:
            centred = x - mean
            total += centred.T @ (centred @ q)
        return total

    return _summed(rows, len(mean), q.shape[1], task) / n


def _trace(rows: DataFrame, mean: np.ndarray, n: int) -> float:
    def task(vectors):
        return np.array([[sum(float(((x - mean) ** 2).sum()) for x in vectors)]])

    return float(_summed(rows, len(mean), 1, task)[0, 0]) / n


def _grown(q: np.ndarray, width: int, rng: np.random.Generator) -> np.ndarray:
    """An orthonormal basis of the columns of ``q`` and random ones, ``width`` columns in all."""
    more = rng.standard_normal((len(q), width - q.shape[1]))
    return np.linalg.qr(np.hstack([q, more]))[0]


def _degree(values: np.ndarray, k: int, bound: float) -> int:
    """Passes until the next QR: as long as the first column outgrows the last wanted one by 1e8 at most."""
    growth = [np.arccosh(max(1.0, 2 * v / bound - 1)) for v in (values[0], values[k - 1])]
    return int(np.clip(np.log(1e8) / max(growth[0] - growth[1], 1e-3), 1, MOST_DEGREE))


def subspace(product: Callable[[np.ndarray], np.ndarray], dims: int, k: int, extra: int = EXTRA, seed: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """The first ``k`` eigenvectors and eigenvalues of the symmetric, positive matrix of which ``product(q)`` gives the product with a
    block of columns, and the number of products taken."""
    rng = np.random.default_rng(seed)
    k = min(k, dims)
    q = np.linalg.qr(rng.standard_normal((dims, min(dims, k + extra))))[0]
    passes, best = 0, np.inf
    while passes < MOST_PASSES:
        y = product(q)
        passes += 1
        small = q.T @ y
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, image = q @ turn, y @ turn
        largest = max(values[0], 0.0)
        worst = float(np.linalg.norm(image[:, :k] - ritz[:, :k] * values[:k], axis=0).max())
        if worst <= WANTED * largest or largest == 0 or (worst <= ENOUGH * largest and worst > best / 2):
            return ritz[:, :k], values[:k], passes
        bound = float(values[-1])
        if worst > best / 2 and q.shape[1] < dims:
            q, best = _grown(ritz, min(dims, 2 * q.shape[1]), rng), worst
            continue
        best = min(best, worst)
        if bound <= 1e-6 * largest:
            q = np.linalg.qr(image)[0]
            continue
        # T_m((V - c) / c) grows fast above the block's least value 2c, and stays within 1 from 0 to it
        c, before, now = bound / 2, ritz, image / (bound / 2) - ritz
        for _ in range(_degree(values, k, bound) - 1):
            before, now = now, 2 * (product(now) / c - now) - before
            passes += 1
        q = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
    raise RuntimeError(f"residual {worst:.3g} after {passes} passes")


def fit(spark: SparkSession, fit_list: DataFrame, k: int = COMPONENTS) -> Components | None:
    """Components of the vectors ``x`` (distinct whole numbers, one length); None where there are none."""
    dims = common_length(fit_list, "x")
    if not dims:
        return None

    totals = fit_list.select(F.posexplode("x").alias("place", "v")).groupBy("place").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).collect()  # dims rows
    sums, n = [r["s"] for r in sorted(totals, key=lambda r: r["place"])], totals[0]["n"]
    mean = np.array([s / n for s in sums])
    trace = _trace(fit_list, mean, n)
    if trace == 0:
        return None
    vectors, values, passes = subspace(lambda q: _product(fit_list, mean, q, n), dims, k)
    real = values > LEAST * values[0]
    vectors, values = vectors[:, real], values[real]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    axes = vectors / np.sqrt(values)

    def task(batches):
        return sum(((w := (x - mean) @ axes).T @ w for x in batches), np.zeros((len(values), len(values))))

    error = float(np.abs(_summed(fit_list, dims, len(values), task) / n - np.eye(len(values))).max())
    return Components(vectors, values, trace, n, sums, error, passes)


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``vec_id, x`` of all rows that stay, and the length of ``x`` (0 without rows)."""
    vector = df[vector_col].cast("array<double>")
    kept = df.filter(usable(vector)).select(df[id_col].alias("vec_id"), whole(vector, SCALE, LARGEST).alias("x"))
    dims = common_length(kept, "x") or 0
    return kept.filter(F.size("x") == dims), dims


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector that stays and component."""
    spark = df.sparkSession
    rows, dims = whole_vectors(df, id_col, vector_col)
    kinds = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    schema = T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType), *(T.StructField(c, t) for c, t in kinds)])
    found = fit(spark, written(rows.select("x").distinct(), scratch_folder(spark, "whitening")), k) if dims else None
    if found is None:
        return spark.createDataFrame([], schema)
    n, error = found.n, found.identity_error
    mean, sums, axes, explained = np.array([s / n for s in found.sums]), found.sums, found.vectors / np.sqrt(found.values), found.values / found.trace
    count = len(explained)

    def deviations(x: np.ndarray) -> pa.Array:
        far = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums))
        if dims * far * far < 1 << 63:
            off = n * x - np.array(sums)
            return pa.array((off * off).sum(1))
        exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def projected(batches):
        for batch in batches:
            x = matrix(batch.column(1), dims)
            values = (x - mean) @ axes
            row = pa.array(np.repeat(np.arange(len(x)), count))
            same = lambda v, t: pa.array(np.full(len(row), v), t)
            columns = [batch.column(0).take(row), pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()), same(n, pa.int64()), deviations(x).take(row), pa.array(values.ravel()), pa.array(np.tile(explained, len(x))), same(error, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(projected, schema)
