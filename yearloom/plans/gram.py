"""Linear regression of many training parts from sums that are gathered once.

One pass over the rows adds up, for each part (a fold), the products of all pairs of columns, with
missing values left out but counted.  Such sums are merged by addition.  So the
training rows of a fold are the sum of the other folds' parts; the means that replace missing
values enter the products afterwards; and every penalty is solved on matrices whose size is the
number of features, without reading a row again.  Errors on a fold come from its own sums.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SWEEPS = 10_000  # of coordinate descent, at most
CLOSE = 1e-12  # change of a coefficient that ends it


@dataclass(frozen=True)
class Gram:
    """Products of the known marks of the features, their values (0 where missing), the label and one.

    Values count from ``origin``, which should be near their means, so that little is rounded.
    """

    products: np.ndarray
    origin: np.ndarray  # of the features, then of the label

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.products + other.products, self.origin)

    @property
    def size(self) -> int:
        return len(self.origin) - 1

    @property
    def rows(self) -> float:
        return float(self.products[-1, -1])

    def means(self) -> np.ndarray:
        """Means of the known values of each feature."""
        p = self.size
        known = self.products[:p, -1]
        return np.divide(self.products[p : 2 * p, -1], known, out=np.zeros(p), where=known > 0)

    def imputed(self, means: np.ndarray) -> np.ndarray:
        """Products of the features, the label and one, with ``means`` in place of missing values.

        A feature is its value plus the mean times one less its mark.
        """
        p = self.size
        change = np.zeros((p + 2, 2 * p + 2))
        change[:p, :p] = -np.diag(means)
        change[:p, p : 2 * p] = np.eye(p)
        change[:p, -1] = means
        change[p, -2] = change[p + 1, -1] = 1
        return change @ self.products @ change.T


def sums(frame: DataFrame, features: list[str], label: str, part: str, origin: dict[str, float]) -> dict:
    """The ``Gram`` of the rows of each value of ``part``, in one pass.

    Features may be missing (null or NaN), labels not.  The result has a row per part, whatever the size of the frame.
    """
    at = np.array([origin.get(c, 0.0) for c in (*features, label)])
    known = [F.col(f"`{c}`").isNotNull() & ~F.isnan(f"`{c}`") for c in features]
    columns = [F.when(k, 1.0).otherwise(0.0) for k in known]
    columns += [F.when(k, F.col(f"`{c}`") - float(o)).otherwise(0.0) for c, k, o in zip(features, known, at, strict=False)]
    columns += [F.col(f"`{label}`") - float(at[-1]), F.lit(1.0)]
    n = len(columns)
    names = [f"w{i}" for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    wide = frame.select(F.col(part).alias("part"), *[c.alias(name) for c, name in zip(columns, names, strict=True)])
    found = wide.groupBy("part").agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i, j in pairs])
    result = {}
    for row in found.collect():
        products = np.zeros((n, n))
        for (i, j), value in zip(pairs, row[1:], strict=True):
            products[i, j] = products[j, i] = value
        result[row["part"]] = Gram(products, at)
    return result


@dataclass(frozen=True)
class Line:
    """Means for missing values, coefficients and intercept, counted from the origin of the sums."""

    means: np.ndarray
    coefficients: np.ndarray
    intercept: float


def fit(train: Gram, penalty: float = 0.0, mixing: float = 0.0) -> Line:
    """The least squares of the rows plus ``penalty`` times the coefficients' size.

    Features and label count in standard deviations; the size is ``mixing`` times the sum of absolute
    values plus half of the rest times the sum of squares.  Features without spread get no weight.
    """
    means = train.means()
    p, n = train.size, train.rows
    products = train.imputed(means)
    center = products[:, -1] / n
    spread = products / n - np.outer(center, center)
    scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
    # What is left of equal values by rounding is no spread.
    scale = np.where(scale > 1e-12 * np.sqrt(np.diag(products) / n), scale, 0.0)
    used = np.flatnonzero(scale[:p] > 0)
    coefficients = np.zeros(p)
    if len(used) and scale[p] > 0:
        matrix = spread[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        right = spread[used, p] / (scale[used] * scale[p])
        weight = penalty / scale[p]
        if mixing * weight == 0:
            found = np.linalg.lstsq(matrix + weight * np.eye(len(used)), right, rcond=1e-13)[0]
        else:
            found = _descent(matrix, right, mixing * weight, (1 - mixing) * weight)
        coefficients[used] = found * scale[p] / scale[used]
    return Line(means, coefficients, float(center[p] - coefficients @ center[:p]))


def _descent(matrix: np.ndarray, right: np.ndarray, absolute: float, square: float) -> np.ndarray:
    """Coordinate descent for a quadratic form plus absolute values and squares."""
    x = np.zeros(len(right))
    for _ in range(SWEEPS):
        largest = 0.0
        for k in range(len(x)):
            rest = right[k] - matrix[k] @ x + matrix[k, k] * x[k]
            new = np.sign(rest) * max(abs(rest) - absolute, 0.0) / (matrix[k, k] + square)
            largest = max(largest, abs(new - x[k]))
            x[k] = new
        if largest < CLOSE:
            break
    return x


def rmse(rows: Gram, line: Line) -> float | None:
    """The root mean squared error of a line on the rows of some sums; None without rows."""
    if not rows.rows:
        return None
    direction = np.r_[-line.coefficients, 1.0, -line.intercept]
    squares = float(direction @ rows.imputed(line.means) @ direction)
    return float(np.sqrt(max(squares, 0.0) / rows.rows))


def fold_errors(parts: dict, folds: list, points: list[tuple[float, float]]) -> list[list[float | None]]:
    """Per point (penalty and mixing) the errors on each fold of lines fitted on the other folds."""
    out: list[list[float | None]] = [[] for _ in points]
    for fold in folds:
        train = reduce(add, [g for f, g in parts.items() if f != fold])
        for errors, (penalty, mixing) in zip(out, points, strict=True):
            errors.append(rmse(parts[fold], fit(train, penalty, mixing)))
    return out
