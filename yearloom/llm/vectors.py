"""Vectors of whole numbers: reading, packing, exact inner products, best rows per query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 256  # whole numbers per unit
LONGEST = 2.0**62  # squared lengths below it: products of two vectors fit a long
EXACT = 2.0**53  # sums of whole doubles below it have no rounding


def doubles(vector: str) -> Column:
    return F.col(f"`{vector}`").cast("array<double>")


def whole_numbers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the rows with vectors of that length and their ``floor(256 * x)``.

    Vectors that are null or empty, hold a null or non-finite part, or are so long (beyond
    2e9 after the step) that products might not fit a long, are left out.
    """
    lengths = np.asarray(pc.list_value_length(vectors).fill_null(0))
    values = vectors.flatten().to_numpy(zero_copy_only=False)  # null parts become NaN
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == size)
        if len(rows) * size == len(values):
            parts = values.reshape(-1, size)
        else:
            parts = values[starts[rows][:, None] + np.arange(size)]
        with np.errstate(over="ignore", invalid="ignore"):
            parts = np.floor(STEPS * parts)
            fine = (parts * parts).sum(1) < LONGEST  # false for what is not finite
        yield rows[fine], parts[fine]


def packed(whole: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as hold them all."""
    top = np.abs(whole).max(initial=0)
    kind = next(k for k, most in ((np.int16, 2**15), (np.int32, 2**31), (np.int64, 2**63)) if top < most)
    return whole.astype(kind).tobytes()


def unpacked(data: bytes, rows: int, size: int) -> np.ndarray:
    """The numbers of ``packed`` as doubles, or as longs if doubles might round products."""
    width = len(data) // max(1, rows * size)
    whole = np.frombuffer(data, {2: np.int16, 4: np.int32, 8: np.int64}[width]).reshape(rows, size)
    return whole.astype(np.float64 if width == 2 else np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, as longs."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def pair_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of each row of ``a`` with the same row of ``b``, as longs."""
    return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))


def first_of_each(line: np.ndarray, score: np.ndarray, key: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best rows of each line: highest scores, ties to the smaller key."""
    order = np.lexsort((key, -score, line))
    ordered = line[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank < most]


class Best:
    """The best rows of every line among those that were added."""

    def __init__(self, lines: int, most: int) -> None:
        self.most = most
        self.line = self.score = self.key = np.zeros(0, np.int64)
        #: From which score on a row may still count.
        self.least = np.full(lines, -np.inf)

    def add(self, line: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(line):
            return
        line, score, key = np.r_[self.line, line], np.r_[self.score, score], np.r_[self.key, key]
        best = first_of_each(line, score, key, self.most)
        self.line, self.score, self.key = line[best], score[best], key[best]
        last = np.arange(self.most - 1, len(best))
        full = last[self.line[last] == self.line[last - self.most + 1]]
        self.least[self.line[full]] = self.score[full]


def blocks(table: DataFrame, number: str, size: Column, most: int) -> Iterator[list[dict]]:
    """The rows of a stored table, ordered by ``number``, in groups of about ``most`` bytes."""
    group, held = [], 0
    sizes = table.select(number, size.cast("long").alias("bytes")).orderBy(number)
    for row in [*sizes.collect(), None]:
        if group and (row is None or held + row["bytes"] > most):
            rows = table.where(F.col(number).isin(group)).orderBy(number).collect()
            yield [r.asDict() for r in rows]
            group, held = [], 0
        if row is not None:
            group.append(row[number])
            held += row["bytes"]
