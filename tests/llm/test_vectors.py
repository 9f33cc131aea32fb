"""Vector codes and whitening against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from quarrylens.llm import queries, vector_codes, vectors, whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, non-finite components, other lengths, ties, repeated rows and ids, one very common vector."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(0, 0.3, 8)], int(i % 3) if i % 7 else None) for i in range(500)]
    common = [0.25, -0.25, 0.5, 0.125, 0.0, -0.001, 1.0, -1.0]
    rows += [(1000 + i, common, 1) for i in range(300)] + [(None, common, None), (3, common, 2), (3, common, 2), (None, rows[4][1], None)]
    rows += [(2000, None, 1), (2001, [0.1, None] + [0.0] * 6, 1), (2002, [math.nan] * 8, 1), (2003, [math.inf] + [0.0] * 7, 1), (2004, [], 1), (2005, [1.0] * 4, 1)]
    return rows


def kept(rows, dims):
    return [r for r in rows if r[1] is not None and len(r[1]) == dims and all(c is not None and math.isfinite(c) for c in r[1])]


def codes_brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain loops over Python's integers."""
    data = [(i, [math.floor(scale * c) for c in v], lab) for i, v, lab in rows]
    seeds = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    d = len(data[0][1])
    cut = [slice(k * d // parts, (k + 1) * d // parts) for k in range(parts)]
    books = [[s[1][c] for s in seeds] for c in cut]

    def assigned():
        out = []
        for _, x, _ in data:
            out.append([min((sum((a - b) ** 2 for a, b in zip(x[c], e, strict=True)), j) for j, e in enumerate(book)) for c, book in zip(cut, books, strict=True)])
        return out

    for _ in range(rounds):
        best = assigned()
        for k, c in enumerate(cut):
            groups = {}
            for (_, x, _), b in zip(data, best, strict=True):
                groups.setdefault(b[k][1], []).append(x[c])
            for j, members in groups.items():
                books[k][j] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    best, totals = assigned(), {}
    errors = [sum(d for d, _ in b) for b in best]
    for (_, _, lab), e in zip(data, errors, strict=True):
        totals[lab] = totals.get(lab, 0) + e
    return sorted(repr((i, "".join(f"{j:02x}" for _, j in b), e, totals[lab])) for (i, _, lab), b, e in zip(data, best, errors, strict=True)), books


def codes_found(df):
    rows = vector_codes.digests(df).collect()
    return sorted(repr((r.vec_id, r.code, r.error, r.label_error)) for r in rows), {r.codebooks_sha256 for r in rows}


def test_codes(spark, odd_rows):
    want, books = codes_brute(kept(odd_rows, 8))
    found, digest = codes_found(table(spark, odd_rows).repartition(5))
    assert found == want
    assert digest == {vector_codes.digest([np.array(b) for b in books])}


def test_codes_of_the_query_by_sql(spark, sf_dir, duck):
    found = queries.op11_vector_codes(spark, sf_dir).toPandas().sort_values("vec_id").reset_index(drop=True)
    want = duck.sql(queries.oracle_sql()["op11_vector_codes"]).df().sort_values("vec_id").reset_index(drop=True)
    assert found.astype(str).equals(want[found.columns].astype(str)) and len(found)


def test_codes_of_few_empty_and_large_vectors(spark):
    assert codes_found(table(spark, []))[0] == []
    assert codes_found(table(spark, [(1, None, 1)]))[0] == []
    assert codes_found(table(spark, [(1, [], 1)]))[0] == [repr((1, "00000000", 0, 0))]
    few = [(5, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6], 1), (4, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], None)]
    (rows, _), books = vector_codes.compressed(table(spark, few)), None
    assert {(r.vec_id, bytes(r.code), r.error) for r in rows.collect()} == {(4, bytes(4), 0), (5, bytes([1] * 4), 0)}
    assert [c.stop - c.start for c in vector_codes.cuts(6, 4)] == [2, 2, 1, 1]
    huge = [(1, [1e30, -1e30, 3.0, 16000.5], 1), (2, [3e5, 0.0, -1.5, 15999.25], 1)]
    rows, books = vector_codes.compressed(table(spark, huge), parts=2)
    assert all(r.error == 0 for r in rows.collect()) and np.abs(books[0]).max() == vector_codes.LARGEST


def test_codes_ignore_columns_and_keep_types(spark):
    df = table(spark, [(1, [0.5] * 4, 1), (2, [-0.5] * 4, 1)]).selectExpr("cast(vec_id as string) AS vec_id", "embedding", "cast(label as string) AS label", "'c' AS code", "'e' AS error", "1 AS part", "2 AS x", "3 AS sums")
    rows, books = vector_codes.compressed(df)
    assert rows.columns == ["vec_id", "label", "code", "error"] and {r.vec_id for r in rows.collect()} == {"1", "2"}
    back = {r.vec_id: r.vector for r in vector_codes.decoded(rows, books).collect()}
    assert np.allclose(back["1"], [0.5] * 4, atol=1e-3)


def test_exponion_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(3)
    for dims, spread in ((1, 5), (3, 9), (16, 300), (4, 1 << 24)):
        entries = rng.integers(-spread, spread, (200, dims))
        entries[50:60] = entries[7]  # equal entries: the lowest index counts
        points = np.vstack([rng.integers(-spread, spread, (900, dims)), entries])
        want = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in entries] for p in points[::9]])
        found, distance = vector_codes.Codebook(entries).nearest(points, rng.integers(0, 200, len(points)))
        assert (found[::9] == want.argmin(1)).all() and (distance[::9] == want.min(1)).all()


def whitened_brute(rows, k=4):
    x = np.array([[math.floor(256 * c) for c in v] for _, v, _ in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(k, int((values > 1e-12 * values[0]).sum()))
    deviation = ((n * x - sums) ** 2).sum(1)
    return n, deviation, (x - sums / n) @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check_whitened(df, rows):
    n, deviation, white, explained = whitened_brute(rows)
    k = white.shape[1]
    found = whitening.whitened(df).collect()
    assert len(found) == k * len(rows)
    assert {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, k + 1)) and all(r.identity_error < 1e-8 for r in found)
    for c in range(k):
        mine = sorted((r.deviation, abs(r.whitened)) for r in found if r.component == c + 1)
        brute = sorted(zip(deviation.tolist(), np.abs(white[:, c]).tolist(), strict=True))
        assert [a for a, _ in mine] == [a for a, _ in brute]
        assert np.allclose(sorted(b for _, b in mine), sorted(b for _, b in brute), atol=1e-9)
        assert np.isclose({r.explained for r in found if r.component == c + 1}.pop(), explained[c], rtol=1e-9)
    # one sign for all rows: signed sums of squares and products agree
    by = {}
    for r in found:
        by.setdefault(r.component, []).append(r.whitened)
    assert np.allclose([abs(sum(by[c + 1])) for c in range(k)], np.abs(white.sum(0)), atol=1e-6)


def test_whitening(spark, odd_rows):
    check_whitened(table(spark, odd_rows).repartition(3), kept(odd_rows, 8))


def test_whitening_of_the_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(*SCHEMA.names).collect()]
    check_whitened(table(spark, rows), kept(rows, 64))
    assert queries.op12_whitening(spark, sf_dir).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_without_components(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)], [(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 2)]):
        assert whitening.whitened(table(spark, rows)).count() == 0
    line = [(i, [i / 8, -i / 8, 0.0], None) for i in range(20)]  # one direction only
    check_whitened(table(spark, line), line)


def test_deviations_beyond_a_long_are_null(spark):
    found = whitening.whitened(table(spark, [(1, [1e7, 0.0], 1), (2, [-1e7, 1e6], 1), (3, [0.0, 0.0], 1), (4, [5e6, -3e6], 1)])).collect()
    assert {r.deviation for r in found if r.vec_id in (1, 2)} == {None} and len(found) == 8


@pytest.mark.parametrize("spectrum", ["flat", "steep", "equal", "gaps"])
def test_subspace_iteration(spectrum):
    dims, rng = 80, np.random.default_rng(2)
    values = {"flat": np.linspace(1.1, 1.0, dims), "steep": 10.0 ** -np.arange(0, dims / 4, 0.25), "equal": np.ones(dims), "gaps": np.r_[100.0, 100.0, 1.0, 1.0, np.full(dims - 4, 1.0 - 1e-6)]}[spectrum]
    basis = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    matrix = basis * values @ basis.T
    vectors_, found, passes = whitening.subspace(lambda q: matrix @ q, dims, 4)
    assert np.allclose(found, values[:4], rtol=1e-9) and passes < 200
    assert np.abs(matrix @ vectors_ - vectors_ * found).max() <= 1e-9 * values[0]


def test_most_common_length(spark, odd_rows):
    df = table(spark, odd_rows)
    assert vectors.common_length(df.filter(vectors.usable(df["embedding"])), "embedding") == 8
