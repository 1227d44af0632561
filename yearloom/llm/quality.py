"""Quality of documents by a regularised quadratic discriminant.

Each text becomes a few transformed statistics.  Both classes get a mean and a covariance,
shrunk towards the variances of all rows together; a score compares the two Gaussian
log-densities, whose Mahalanobis distances come from Cholesky factors made once per fit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.common import pieces
from yearloom.llm.html_text import STOP_WORDS

SHRINKAGE = 0.05
FLOOR = 1e-3  # least variance of a statistic
PRIOR_WORDS = 12.0  # weight of the usual share against the counted one

_STOP = frozenset(w.encode() for w in STOP_WORDS)
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGITS = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_COMMON_SIGNS = b".,;:'\"()-?"
_END = re.compile(rb"[.!?](?=\s|\Z)")

NAMES = (
    "words", "word_length", "upper", "digits", "common_signs", "other_signs", "different",
    "repeated", "stop_words", "top_word", "sentence_ends", "lines", "repeated_lines", "long_words",
)


def _share(count: float, total: float, usual: float) -> float:
    """Log-odds of a share, drawn to the usual one where there is little text."""
    return math.log(
        (count + PRIOR_WORDS * usual) / (max(0.0, total - count) + PRIOR_WORDS * (1 - usual))
    )


def statistics(text: bytes) -> list[float]:
    words = text.split()
    lower = text.lower().split()
    n, size = len(words), len(text)
    counts = Counter(lower)
    letters = size - len(text.translate(None, _LETTERS))
    upper = size - len(text.translate(None, _UPPER))
    digits = size - len(text.translate(None, _DIGITS))
    space = size - len(text.translate(None, _SPACE))
    common = size - len(text.translate(None, _COMMON_SIGNS))
    other = size - letters - digits - space - common
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = sum(map(eq, lower, islice(lower, 1, None)))
    # Of a text with as many words, how many are expected to differ falls slowly.
    different = math.log((n + 10.0) / (len(counts) + 10.0)) / math.log(n + 20.0)
    return [
        math.log(n + 1.0),
        math.log((size - space + 5.0 * PRIOR_WORDS) / (n + PRIOR_WORDS)),
        _share(upper, letters, 0.03),
        _share(digits, size, 0.005),
        _share(common, size, 0.02),
        _share(other, size, 0.002),
        different,
        _share(repeated, n, 0.01),
        _share(sum(map(_STOP.__contains__, lower)), n, 0.3),
        _share(max(counts.values(), default=0), n, 0.06),
        _share(len(_END.findall(text)), n, 0.08),
        _share(len(lines), n, 0.02),
        _share(len(lines) - len(set(lines)), len(lines), 0.05),
        _share(sum(1 for w in words if len(w) > 20), n, 0.01),
    ]


def _features(texts: pa.Array) -> pa.Array:
    rows = [statistics(t) for _, part in pieces(texts) for t in part]
    return _vectors(np.array(rows, np.float64).reshape(-1, len(NAMES)))


def _vectors(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.reshape(-1)))


def features(df: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """Add the statistics of each whole text as an array of doubles.

    Null counts as empty; few words give values near the usual ones.  Every row is kept;
    other columns are untouched and a column of the name ``out`` is replaced.
    """
    call = F.arrow_udf(_features, "array<double>")
    return df.withColumn(out, call(F.col(f"`{text}`").cast("string")))


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors, and constants of the log-densities of both classes.

    Without rows of both classes there are no factors, and every score is ``share``.
    """

    share: float
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    constants: tuple[float, ...] = ()

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(rows), self.share)
        density = [
            c - 0.5 * (((rows - m) @ f.T) ** 2).sum(1)
            for m, f, c in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class: how many rows, the sums, and the sums of products, of one task."""
    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        label = label[np.asarray(batch.column(1).is_valid())]
        x = np.asarray(batch.column(1).drop_null().flatten()).reshape(-1, d)
        for k in (0, 1):
            own = x[label == k]
            total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).reshape(-1)])
    place = np.arange(total.size)
    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.reshape(-1))], ["place", "value"])


def fit(rows: DataFrame, label: str = "label", vector: str = "features") -> Discriminant:
    """Learn from all rows with a vector whose label is 0 or 1 (others are left out).

    Every task sums up its rows and Spark adds the sums, so a fixed, small number of values
    reaches the driver however many rows there are.
    """
    d = len(NAMES)
    known = rows.where(F.col(label).isin(0, 1))
    sums = (
        known.select(F.col(label).cast("int"), vector)
        .mapInArrow(_sums, "place long, value double")
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
    )
    total = np.zeros(2 * (1 + d + d * d))
    for row in sums.collect():
        total[row["place"]] = row["value"]
    total = total.reshape(2, -1)
    counts = total[:, 0]
    if counts.min() < 1:
        return Discriminant(float(counts[1] / counts.sum()) if counts.sum() else 0.5)
    means = total[:, 1 : 1 + d] / counts[:, None]
    products = total[:, 1 + d :].reshape(2, d, d)
    spread = [p / n - np.outer(m, m) for p, n, m in zip(products, counts, means, strict=True)]
    pooled = np.diag(sum(n * np.diag(s) for n, s in zip(counts, spread, strict=True)) / counts.sum())
    factors, constants = [], []
    for n, s in zip(counts, spread, strict=True):
        shrunk = (1 - SHRINKAGE) * s + SHRINKAGE * pooled + FLOOR * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        constants.append(math.log(n / counts.sum()) - float(np.log(np.diag(lower)).sum()))
    return Discriminant(float(counts[1] / counts.sum()), tuple(means), tuple(factors), tuple(constants))


def score(df: DataFrame, model: Discriminant, vector: str = "features", out: str = "score") -> DataFrame:
    """Add how likely each row is of class 1; null vectors get null."""

    def scores(vectors: pa.Array) -> pa.Array:
        known = vectors.drop_null()
        x = np.asarray(known.flatten()).reshape(-1, len(NAMES))
        result = np.full(len(vectors), np.nan)
        result[np.asarray(vectors.is_valid())] = model.scores(x)
        return pa.array(result, from_pandas=True)

    return df.withColumn(out, F.arrow_udf(scores, "double")(F.col(f"`{vector}`")))
