"""Whitening of vectors by leading eigenvectors of their covariance, by Jacobi-Davidson.

The covariance is never formed: Spark multiplies it with a few vectors at a time, as sums over
stored blocks of centred rows.  Eigenpairs are taken from a growing subspace (Rayleigh-Ritz);
each step adds solutions of the projected correction equations, for all pairs that are not good
enough yet, found by a few steps of MINRES that share their products.  Pairs whose residuals
reach double precision are locked, and everything else is kept orthogonal to them.

The driver holds a few vectors as long as the data's; rows stay in the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.vectors import doubles, packed, unpacked, whole_numbers
from yearloom.session import store

COMPONENTS = 4
GUARD = 4  # directions kept beyond the wanted ones
SUBSPACE = 40  # directions before a restart
INNER = 4  # steps of MINRES
OUTER = 200
SEED = 42
BLOCK = 1 << 19  # numbers of a stored block, at most about

Product = Callable[[np.ndarray], np.ndarray]


def _minres(apply: Product, right: np.ndarray, steps: int, project: Product) -> np.ndarray:
    """Approximate solutions of ``apply`` (x) = ``right``, a column each, by steps of MINRES.

    ``apply`` treats all columns at once but each with its own symmetric operator.
    """
    n, m = right.shape
    x = np.zeros((n, m))
    beta = np.linalg.norm(right, axis=0)
    old, now = np.zeros((n, m)), right / np.where(beta > 0, beta, 1)
    left, cos, sin, cos_old, sin_old = beta.copy(), np.ones(m), np.zeros(m), np.ones(m), np.zeros(m)
    w, w_old, below = np.zeros((n, m)), np.zeros((n, m)), np.zeros(m)
    for _ in range(steps):
        new = project(apply(now)) - below * old
        alpha = (now * new).sum(0)
        new = project(new - alpha * now)
        next_below = np.linalg.norm(new, axis=0)
        # Rotations of the tridiagonal matrix.
        far, near = sin_old * below, cos_old * below
        mid, bottom = cos * near + sin * alpha, -sin * near + cos * alpha
        top = np.hypot(bottom, next_below)
        safe = np.where(top > 0, top, 1)
        cos_old, sin_old, cos, sin = cos, sin, np.where(top > 0, bottom / safe, 1), next_below / safe
        direction = (now - mid * w - far * w_old) / safe
        x += np.where(top > 0, cos * left, 0) * direction
        left = -sin * left
        w_old, w = w, direction
        old, now = now, new / np.where(next_below > 0, next_below, 1)
        below = next_below
    return x


def _orthonormal(vectors: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """What ``vectors`` add to the spaces of ``against``, orthonormal; nearly dependent ones drop out."""
    out = np.zeros((len(vectors), 0))
    for x in vectors.T:
        size = np.linalg.norm(x)
        if not size > 0:
            continue
        x = x / size
        for _ in range(3):
            for basis in (*against, out):
                x = x - basis @ (basis.T @ x)
            size = np.linalg.norm(x)
            if size < 1e-10:
                break
            x = x / size
        else:
            out = np.column_stack([out, x])
    return out


def jacobi_davidson(product: Product, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a symmetric matrix.

    ``product`` multiplies it with the columns it is given; nothing else is known of it.
    Residuals end below ``size`` times the rounding unit times the largest eigenvalue.
    """
    wanted = min(wanted, size)
    start = np.random.default_rng(SEED).standard_normal((size, min(size, wanted + GUARD)))
    basis = _orthonormal(start)
    image = product(basis)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    scale, best, stuck = 0.0, math.inf, 0
    for _ in range(OUTER):
        # Rayleigh-Ritz
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        scale = max(scale, float(theta[0]), float(values.max(initial=0)))
        many = wanted - len(values)
        ritz, pushed = basis @ turn[:, :many], image @ turn[:, :many]
        apart = pushed - ritz * theta[:many]
        apart -= locked @ (locked.T @ apart)
        errors = np.linalg.norm(apart, axis=0)
        enough = max(size, 16) * np.finfo(float).eps * scale
        good = 0
        while good < many and errors[good] <= enough:
            good += 1  # locked in order, so that none is passed over
        whole = basis.shape[1] + locked.shape[1] == size
        # Sums over very many rows may round a little more: no progress three times is the end too.
        worst = float(errors.max())
        stuck = stuck + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if stuck >= 3 and worst <= 100 * enough or whole and stuck >= 1:
            good = many
        if good:
            locked = np.column_stack([locked, ritz[:, :good]])
            values = np.r_[values, theta[:good]]
            if len(values) == wanted:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
            basis, image = basis @ turn[:, good:], image @ turn[:, good:]
            best, stuck = math.inf, 0
            continue
        if basis.shape[1] > SUBSPACE - many:
            keep = min(basis.shape[1], 2 * (many + GUARD))
            basis, image = basis @ turn[:, :keep], image @ turn[:, :keep]
        open_pairs = errors > enough
        shift = theta[:many][open_pairs]
        around = np.column_stack([locked, ritz])

        def project(x, around=around):
            return x - around @ (around.T @ x)

        right = project(-apart[:, open_pairs])
        step = _minres(lambda x, shift=shift: product(x) - shift * x, right, INNER, project)
        added = _orthonormal(step, locked, basis)
        if not added.shape[1]:
            added = _orthonormal(right, locked, basis)
        if added.shape[1]:
            basis, image = np.column_stack([basis, added]), np.column_stack([image, product(added)])
    raise RuntimeError(f"no double precision after {OUTER} steps")


def _summed(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    total = None
    for part in parts:
        total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _total(blocks: DataFrame, per_block: Callable[[np.ndarray], np.ndarray], kind=np.float64) -> np.ndarray:
    """The sum of what ``per_block`` gives for all blocks: per task, then over all tasks."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _summed(
            per_block(unpacked(row["data"], row["n"], row["parts"])) for batch in batches for row in batch.to_pylist()
        )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _summed(np.frombuffer(x, kind) for batch in batches for x in batch.column(0).to_pylist())

    # One row per task, of a few vectors' size.
    sums = blocks.mapInArrow(within, "sums binary").repartition(1).mapInArrow(over, "sums binary")
    return np.frombuffer(sums.collect()[0][0], kind)


def _packed_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def block() -> pa.RecordBatch:
        whole = np.concatenate(held)
        held.clear()
        return pa.RecordBatch.from_pylist([{"n": len(whole), "parts": size, "data": packed(whole)}], _BLOCK)

    for batch in batches:
        rows = [np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]
        for start in range(0, len(rows), max(1, BLOCK // size)):
            part = rows[start : start + max(1, BLOCK // size)]
            if held and (sum(map(len, held)) + len(part)) * size > BLOCK:
                yield block()
            held.append(np.stack(part))
    if held:
        yield block()


_BLOCK = pa.schema([("n", pa.int64()), ("parts", pa.int64()), ("data", pa.binary())])


def _whole_bytes(vectors: pa.Array) -> pa.Array:
    out: list[bytes | None] = [None] * len(vectors)
    for rows, whole in whole_numbers(vectors):
        for k, x in zip(rows.tolist(), whole.astype(np.int64), strict=True):
            out[k] = x.tobytes()
    return pa.array(out, pa.binary())


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` different vectors with sums ``sums``, eigenvalues and eigenvectors."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    def whitened(self, whole: np.ndarray) -> np.ndarray:
        return (whole - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, whole: np.ndarray) -> list[int]:
        """Squared lengths of ``n * x - sums``, exact."""
        top = self.n * float(np.abs(whole).max(initial=0)) + float(np.abs(self.sums).max())
        kind = np.int64 if top * top * whole.shape[1] < 2.0**62 else object
        apart = self.n * whole.astype(np.int64).astype(kind) - self.sums.astype(kind)
        return [int(x) for x in (apart * apart).sum(1)]


def fit(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """Learn from all rows of ``whole``, packed longs of ``size`` parts, each different one once."""
    different = rows.groupBy("whole").agg(F.lit(1).alias("one")).select("whole")
    blocks = store(different.mapInArrow(partial(_packed_blocks, size=size), "n long, parts long, data binary"), "whitening")
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = _total(blocks, lambda x: np.r_[len(x), x.astype(np.int64).sum(0)].astype(np.int64), np.int64)
        n, sums = int(sums[0]), sums[1:]
        mean = sums / n

        def product(vectors: np.ndarray) -> np.ndarray:
            def part(x: np.ndarray) -> np.ndarray:
                apart = x - mean
                return (apart.T @ (apart @ vectors)).reshape(-1)

            return _total(blocks, part).reshape(vectors.shape) / n

        trace = float(_total(blocks, lambda x: np.array([((x - mean) ** 2).sum()]))[0]) / n
        if trace == 0:
            return Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0, 0.0)
        values, vectors = jacobi_davidson(product, size, components)
        # Directions without spread cannot be scaled to one.
        real = values > size * np.finfo(float).eps * values[0] * 16
        values, vectors = values[real], vectors[:, real]
        model = Whitening(n, sums, values, vectors, trace, 0.0)
        k = len(values)

        def moments(x: np.ndarray) -> np.ndarray:
            z = model.whitened(x)
            return np.r_[z.sum(0), (z.T @ z).reshape(-1)]

        found = _total(blocks, moments) / n
        covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
        error = float(np.abs(covariance - np.eye(k)).max())
        return Whitening(n, sums, values, vectors, trace, error)
    finally:
        blocks.unpersist()


_RESULT = (
    "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per input row and component: ``key``, ``component`` (from 1, by falling
    eigenvalue), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Parts become ``floor(256 * x)``.  The covariance is that of all different vectors; ``n`` is their
    number.  ``deviation`` is the squared length of n times the vector minus their sum, exact.  ``whitened`` is the centred vector's part along the component over the root of its
    eigenvalue, which is the share ``explained`` of the trace.  ``identity_error`` is how far the covariance of ``whitened`` is from the
    identity at most.

    Vectors that are null or empty, hold a null or non-finite part or are longer than 2e9 steps are left
    out, and so are those of another length than the most frequent one (the smaller of two): they
    have no covariance with the others.  Rows without a key and rows that share one are kept.  Directions
    without spread give no rows, so equal vectors, and one vector alone, give none.
    """
    rows = store(
        df.select(
            F.col(f"`{key}`").cast("long").alias("id"),
            F.arrow_udf(_whole_bytes, "binary")(doubles(vector)).alias("whole"),
        ).where("whole is not null"),
        "whole-vectors",
    )
    spark = df.sparkSession
    common = rows.groupBy(F.octet_length("whole").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return _named(spark.createDataFrame([], _RESULT), key)
    size = common["size"] // 8
    rows = rows.where(F.octet_length("whole") == common["size"])
    model = fit(rows, size, components)
    k = len(model.values)
    shares = model.values / model.trace if k else model.values

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            whole = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64).reshape(-1, size)
            m = len(whole)
            deviation = pa.array(np.repeat(np.array([str(x) for x in model.deviations(whole)], object), k), pa.string())
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                deviation.cast(pa.decimal128(38, 0)),
                pa.array(model.whitened(whole.astype(np.float64)).reshape(-1)),
                pa.array(np.tile(shares, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return _named(rows.mapInArrow(project, _RESULT), key)


_NAMES = [part.split()[0] for part in _RESULT.split(", ")]


def _named(result: DataFrame, key: str) -> DataFrame:
    return result.select(F.col("id").alias(key), *_NAMES[1:])
