import math

import numpy as np
import pytest

from tests.llm.test_hard_negatives import whole
from yearloom.llm import catalog, whitening

ROWS = "vec_id bigint, embedding array<float>"


def brute(rows, components=4):
    """By forming the covariance; whitened values up to their sign."""
    known = [(i, x) for i, v in rows if (x := whole(v))]
    fit = np.array(sorted({tuple(x) for _, x in known}), float)
    n, sums = len(fit), fit.sum(0)
    apart = fit - sums / n
    covariance = apart.T @ apart / n
    values, vectors = (x[..., ::-1] for x in np.linalg.eigh(covariance))
    out = []
    for i, x in known:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(min(components, len(values))):
            white = (np.array(x, float) - sums / n) @ vectors[:, k] / math.sqrt(values[k])
            out.append((str(i), k + 1, n, deviation, white, values[k] / np.trace(covariance)))
    return sorted(out, key=lambda r: (r[0], r[1], r[3], abs(r[4])))


def compared(result, expected):
    rows = sorted(map(tuple, result.collect()), key=lambda r: (str(r[0]), r[1], r[3], abs(r[4])))
    assert [(str(r[0]), r[1], r[2], int(r[3])) for r in rows] == [r[:4] for r in expected]
    mine, theirs = np.array([r[4] for r in rows]), np.array([r[4] for r in expected])
    numbers = np.array([r[1] for r in rows])
    for k in set(numbers.tolist()):
        at = numbers == k
        sign = np.sign((mine[at] * theirs[at]).sum())  # one for all rows
        assert np.allclose(mine[at], sign * theirs[at], rtol=0, atol=1e-8)
    assert np.allclose([r[5] for r in rows], [r[5] for r in expected], rtol=1e-10)
    assert all(r[6] <= 1e-10 for r in rows) and len({r[6] for r in rows}) == 1


@pytest.mark.parametrize("size", [2, 4, 9, 48])
def test_as_by_forming_the_covariance(spark, size):
    r = np.random.default_rng(size)
    scales = np.linspace(2.0, 0.5, size)
    rows = [(k, (scales * r.standard_normal(size)).astype(np.float32).tolist()) for k in range(300)]
    rows += [(400 + k, rows[k % 3][1]) for k in range(90)]  # copies count once
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    compared(whitening.whiten(df), brute(rows))


@pytest.mark.parametrize(("size", "gap"), [(60, 1e-3), (300, 0.02), (40, 0.5)])
def test_eigenpairs_to_double_precision(size, gap):
    """Close eigenvalues, and a matrix that is only known by its products."""
    r = np.random.default_rng(size)
    turn = np.linalg.qr(r.standard_normal((size, size)))[0]
    values = np.sort(100 * (1 - gap * np.arange(size) / 4) ** 2 * (np.arange(size) < size - 2))[::-1]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.jacobi_davidson(lambda x: matrix @ x, size, 4)
    assert np.allclose(found, values[:4], rtol=1e-13)
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12


def test_equal_and_vanishing_eigenvalues():
    found, vectors = whitening.jacobi_davidson(lambda x: x, 6, 4)
    assert np.allclose(found, 1) and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12
    found, _ = whitening.jacobi_davidson(lambda x: np.diag([5.0, 3.0, 0, 0, 0]) @ x, 5, 4)
    assert np.allclose(found, [5, 3, 0, 0], atol=1e-13)


def test_messy_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (0, [0.5, 1.0]), (1, None), (2, []), (3, [1.0, None]), (4, [1.0, math.nan]), (5, [math.inf, 0.0]),
        (None, [0.0, 0.5]), (7, [1.0, 0.5]), (7, [1.0, 0.5]), (9, [0.0, 0.0]), (20, [-1.0, 0.1]),
    ]
    df = spark.createDataFrame([*rows, (10, [1.0, 0.5, 0.1])], ROWS)
    compared(whitening.whiten(df), brute(rows))
    clash = df.selectExpr("*", "1 AS id", "2 AS n", "3 AS whole", "4 AS component", "5 AS deviation")
    compared(whitening.whiten(clash), brute(rows))
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 7")).collect() == []  # no spread
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 1.0]) for k in range(5)], ROWS)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}  # one direction has spread


def test_very_large_numbers(spark):
    rows = [(k, [float(2**20 + k), float(k * k)]) for k in range(50)]
    compared(whitening.whiten(spark.createDataFrame(rows, ROWS)), brute(rows))


def test_query_as_by_forming_the_covariance(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compared(catalog.op13_whitening(spark, folder), brute(rows))
