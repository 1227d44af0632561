"""Hard negatives by filters on the summaries of vector segments.

Every vector is cut into segments, and the mean and deviation of each are stored beside it.
Over a segment of n parts two vectors' product is n times the product of the means, plus or minus n
times the product of the deviations at most.  Summed over the segments that bounds a score from both sides.  Bounds are
refined from one segment for the whole vector to many short ones; pairs that cannot
score as wanted drop out at each level, and what is left is scored exactly.

Anchors are searched for in blocks of bounded size, one pass over all stored vectors each.
Tasks give their best rows per anchor, with their own thresholds; Spark ranks those.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm.vectors import Best, blocks, doubles, packed, pair_products, products, unpacked, whole_numbers
from yearloom.session import store

SEGMENTS = (1, 4, 16, 32)  # of a vector, level by level
GROUP = 4096  # vectors of a stored row, at most
PARTS = 1 << 20  # numbers of a stored row, at most about
SOME = 256  # anchors compared at a time
ANCHOR_BYTES = 16 * 1024 * 1024  # of a block of anchors
FEW = 0.02  # share of pairs below which they are looked at one by one
SLACK = 1e-5  # for summaries of single precision, as a share of the lengths' product

_GROUPS = "number long, parts int, ids array<long>, labels array<string>, vectors binary, summaries binary, bytes long"
_SCHEMA = pa.schema(
    [
        ("number", pa.int64()), ("parts", pa.int32()), ("ids", pa.list_(pa.int64())),
        ("labels", pa.list_(pa.string())), ("vectors", pa.binary()), ("summaries", pa.binary()), ("bytes", pa.int64()),
    ]
)


def _levels(size: int) -> list[int]:
    return [s for s in SEGMENTS if s <= size] or [1]


def summaries(whole: np.ndarray) -> np.ndarray:
    """Level by level the means, then the deviations, of each row's segments.

    Both times the root of the segment's length, so that products need no weights.
    """
    size, out = whole.shape[1], []
    for many in _levels(size):
        starts = np.arange(many) * size // many
        lengths = np.diff(np.r_[starts, size])
        means = np.add.reduceat(whole, starts, axis=1) / lengths
        apart = whole - np.repeat(means, lengths, axis=1)
        out += [means * np.sqrt(lengths), np.sqrt(np.add.reduceat(apart * apart, starts, axis=1))]
    return np.concatenate(out, axis=1).astype(np.float32)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored rows of many vectors of one length, in the order in which they come."""
    number = TaskContext.get().partitionId() << 32
    held: dict[int, list[tuple]] = {}

    def row(size: int) -> pa.RecordBatch:
        nonlocal number
        ids, labels, whole = (list(x) for x in zip(*held.pop(size), strict=True))
        whole = np.concatenate(whole)
        vectors, short = packed(whole), summaries(whole).tobytes()
        ids, labels = np.concatenate(ids).tolist(), [x for part in labels for x in part]
        number += 1
        return pa.RecordBatch.from_pylist(
            [{"number": number, "parts": size, "ids": ids, "labels": labels, "vectors": vectors, "summaries": short, "bytes": len(vectors) + len(short)}],
            _SCHEMA,
        )

    for batch in batches:
        ids, labels = batch.column(0).to_numpy(), batch.column(1)
        for rows, whole in whole_numbers(batch.column(2)):
            size = whole.shape[1]
            most = max(1, min(GROUP, PARTS // size))
            for start in range(0, len(rows), most):
                part = slice(start, start + most)
                own = held.get(size, [])
                if own and sum(len(x[0]) for x in own) + len(rows[part]) > most:
                    yield row(size)
                names = labels.take(pa.array(rows[part])).to_pylist()
                held.setdefault(size, []).append((ids[rows[part]], names, whole[part]))
    for size in list(held):
        yield row(size)


@dataclass
class _Vectors:
    """The unpacked vectors of a stored row."""

    ids: np.ndarray
    labels: np.ndarray
    whole: np.ndarray
    short: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, row: dict, codes: dict[str, int]) -> _Vectors:
        """``codes`` numbers the labels and grows with them."""
        ids = np.array(row["ids"], np.int64)
        whole = unpacked(row["vectors"], len(ids), row["parts"])
        short = np.frombuffer(row["summaries"], np.float32).reshape(len(ids), -1)
        lengths = np.sqrt((whole.astype(np.float64) ** 2).sum(1))
        labels = np.array([codes.setdefault(x, len(codes)) for x in row["labels"]])
        return cls(ids, labels, whole, short, lengths)

    def some(self, rows) -> _Vectors:
        return _Vectors(self.ids[rows], self.labels[rows], self.whole[rows], self.short[rows], self.lengths[rows])


def scored(a: _Vectors, b: _Vectors, alive: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Rows, columns and scores of the pairs still alive that may score from ``low`` to ``high``.

    ``low`` and ``high`` are given for each row of ``a``.  No pair in between is lost.
    """
    place = 0
    for many in _levels(a.whole.shape[1]):
        mean, apart = slice(place, place + many), slice(place + many, place + 2 * many)
        place += 2 * many
        if alive.mean() > FEW:
            middle, spread = a.short[:, mean] @ b.short[:, mean].T, a.short[:, apart] @ b.short[:, apart].T
            spread += np.float32(SLACK) * np.outer(a.lengths, b.lengths) + 1
            alive = alive & (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
        else:
            r, c = np.nonzero(alive)
            middle = np.einsum("ij,ij->i", a.short[r, mean], b.short[c, mean])
            spread = np.einsum("ij,ij->i", a.short[r, apart], b.short[c, apart])
            spread += np.float32(SLACK) * a.lengths[r] * b.lengths[c] + 1
            fine = (middle + spread >= low[r]) & (middle - spread <= high[r])
            alive = np.zeros_like(alive)
            alive[r[fine], c[fine]] = True
    r, c = np.nonzero(alive)
    if len(r) > FEW * alive.size:
        return r, c, products(a.whole, b.whole)[r, c]
    return r, c, pair_products(a.whole[r], b.whole[c])


@dataclass
class _Anchors:
    """Anchors of one length, a few at a time, and where their results are counted."""

    vectors: _Vectors
    lines: np.ndarray


def _some(block: list[dict], codes: dict[str, int]) -> tuple[dict[int, list[_Anchors]], int]:
    out: dict[int, list[_Anchors]] = {}
    line = 0
    for row in block:
        own = _Vectors.of(row, codes)
        for start in range(0, len(own.ids), SOME):
            part = own.some(slice(start, start + SOME))
            out.setdefault(row["parts"], []).append(_Anchors(part, line + np.arange(len(part.ids))))
            line += len(part.ids)
    return out, line


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _positives(batches: Iterator[pa.RecordBatch], block: list[dict], most: int) -> Iterator[pa.RecordBatch]:
    """Per anchor the best rows of its label in this task."""
    codes: dict[str, int] = {}
    anchors, lines = _some(block, codes)
    best = Best(lines, most)
    for row in _rows(batches):
        everything = _Vectors.of(row, codes)
        for own in anchors.get(row["parts"], []):
            for label in np.intersect1d(own.vectors.labels, everything.labels).tolist():
                mine = np.flatnonzero(own.vectors.labels == label)
                a, b = own.vectors.some(mine), everything.some(everything.labels == label)
                at = own.lines[mine]
                other = a.ids[:, None] != b.ids
                r, c, s = scored(a, b, other, best.least[at], np.full(len(at), np.inf))
                best.add(at[r], s, b.ids[c])
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.line, best.key, best.score)], ["line", "id", "score"])


@dataclass
class _Wanted:
    """Per positive: the anchor's line, its key and score, and the scores of its negatives."""

    line: np.ndarray
    key: np.ndarray
    score: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _negatives(batches: Iterator[pa.RecordBatch], block: list[dict], wanted: _Wanted, most: int) -> Iterator[pa.RecordBatch]:
    """Per positive the best rows of other labels, among the allowed scores, in this task."""
    codes: dict[str, int] = {}
    anchors, lines = _some(block, codes)
    best = Best(len(wanted.line), most)
    many = np.bincount(wanted.line, minlength=lines)  # positives of each anchor
    first = np.cumsum(many) - many
    high = np.full(lines, -np.inf)
    np.maximum.at(high, wanted.line, wanted.high)
    for row in _rows(batches):
        everything = _Vectors.of(row, codes)
        low = np.full(lines, np.inf)
        np.minimum.at(low, wanted.line, np.maximum(wanted.low, best.least))
        for own in anchors.get(row["parts"], []):
            use = low[own.lines] <= high[own.lines]
            if not use.any():
                continue
            a, at = own.vectors.some(use), own.lines[use]
            other = a.labels[:, None] != everything.labels
            other &= a.ids[:, None] != everything.ids
            r, c, s = scored(a, everything, other, low[at], high[at])
            for k in range(int(many[at].max(initial=0))):
                has = many[at[r]] > k
                goal = first[at[r[has]]] + k
                fits = (s[has] >= np.maximum(wanted.low[goal], best.least[goal])) & (s[has] <= wanted.high[goal])
                best.add(goal[fits], s[has][fits], everything.ids[c[has]][fits])
    anchor = np.concatenate([np.array(row["ids"], np.int64) for row in block])
    columns = [best.line, anchor[wanted.line[best.line]], wanted.key[best.line], wanted.score[best.line], best.key, best.score]
    names = ["line", "anchor", "positive", "positive_score", "negative", "score"]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)


_POSITIVE = "line long, id long, score long"
_NEGATIVE = "line long, anchor long, positive long, positive_score long, negative long, score long"


def _ranked(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` best rows of each line, with their rank."""
    order = Window.partitionBy("line").orderBy(F.desc("score"), key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
) -> DataFrame:
    """Rows of ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Parts become ``floor(256 * x)``; a score is the inner product of such vectors.  An anchor's
    positives are the best ``positives`` rows of its label, whose key is not its own.  For each of them the best
    ``negatives`` rows of other labels are given that score from ``least`` to ``most``
    hundredths of the positive's score.  Higher scores come first, ties by smaller key.

    Rows without a key or label take no part, nor do vectors that are null or empty, hold a
    null or non-finite part, or are longer than 2e9 steps.  Vectors of different lengths are
    not compared.  ``anchors`` is a condition on the rows of ``df``.  Keys are whole numbers; rows that share one stand each for
    itself, as anchors too, but are no others to each other.
    """
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        doubles(vector).alias("parts"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where("id is not null and label is not null")
    columns = ["id", "label", "parts"]
    everything = store(rows.select(*columns).mapInArrow(_grouped, _GROUPS), "segments")
    sought = store(rows.where("anchor").select(*columns).mapInArrow(_grouped, _GROUPS), "anchors")

    spark, found = df.sparkSession, []
    for block in blocks(sought, "number", F.col("bytes"), ANCHOR_BYTES):
        sent = spark.sparkContext.broadcast(block)
        near = everything.mapInArrow(lambda batches, sent=sent: _positives(batches, sent.value, positives), _POSITIVE)
        # At most ``positives`` rows for each anchor of the block.
        best = _ranked(near, "id", positives).orderBy("line", "rank").toArrow()
        line, ids, score = (best.column(name).to_numpy() for name in ("line", "id", "score"))
        large = score.astype(object)  # hundredfold scores may not fit a long
        low, high = (-(-least * large // 100)).astype(np.int64), (most * large // 100).astype(np.int64)
        wanted = _Wanted(line, ids, score, low, high)
        sent = spark.sparkContext.broadcast((block, wanted))
        hard = everything.mapInArrow(lambda batches, sent=sent: _negatives(batches, *sent.value, negatives), _NEGATIVE)
        found.append(store(_ranked(hard, "negative", negatives), "hard-negatives"))
    if not found:
        found.append(spark.createDataFrame([], f"{_NEGATIVE}, rank int"))
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    return result.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("negative").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
