"""Exact top-k search by inner product in an index whose postings are ordered by impact.

The index is a table of shards.  In a shard every dimension has postings, one for each
vector, sorted by the part's value and cut into segments of equal quantised value.  The impact of a
posting for a query is the query's part times how far the posting's part is above the dimension's
lowest value (below its highest, where the query's part is negative): never negative.

A query takes the segments of all dimensions by falling impact and adds them up per vector.
A vector of which u postings were not met yet is at most u times the next impact above
its sum.  The search of a shard stops when this proves that few vectors can be among the best; those are
scored exactly.  Where no early stop can be proved, all segments are taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm.vectors import Best, blocks, doubles, packed, products, unpacked, whole_numbers
from yearloom.session import store

SHARD = 8192  # vectors of a shard, at most
PARTS = 1 << 20  # numbers of a shard, at most about
LEVELS = 128  # quantised values of a dimension, at most
STEPS = (1.0, 0.5, 0.3, 0.15, 0.0)  # impacts at which proofs are tried, in shares of the mean one
FEW = 32  # one in so many vectors is rescored
QUERY_BYTES = 16 * 1024 * 1024  # of a block of queries

_SHARDS = "number long, parts int, ids array<long>, vectors binary, postings binary, levels binary, lows array<long>, shifts array<int>"
_SCHEMA = pa.schema(
    [
        ("number", pa.int64()), ("parts", pa.int32()), ("ids", pa.list_(pa.int64())), ("vectors", pa.binary()),
        ("postings", pa.binary()), ("levels", pa.binary()), ("lows", pa.list_(pa.int64())), ("shifts", pa.list_(pa.int32())),
    ]
)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of vectors of one length, in the order in which they come."""
    number = TaskContext.get().partitionId() << 32
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def shard(size: int) -> pa.RecordBatch:
        nonlocal number
        ids, whole = (np.concatenate(x) for x in zip(*held.pop(size), strict=True))
        longs = whole.astype(np.int64)
        lows = longs.min(0)
        widths = longs.max(0) - lows
        shifts = np.array([max(0, int(w // LEVELS).bit_length()) for w in widths])
        levels = ((longs - lows) >> shifts).astype(np.uint8)
        postings = np.argsort(levels, axis=0, kind="stable").astype(np.uint16)
        number += 1
        row = {
            "number": number, "parts": size, "ids": ids.tolist(), "vectors": packed(whole),
            "postings": postings.T.tobytes(), "levels": np.take_along_axis(levels, postings.astype(int), 0).T.tobytes(),
            "lows": lows.tolist(), "shifts": shifts.tolist(),
        }
        return pa.RecordBatch.from_pylist([row], _SCHEMA)

    for batch in batches:
        ids = batch.column(0).to_numpy()
        for rows, whole in whole_numbers(batch.column(1)):
            size = whole.shape[1]
            most = max(1, min(SHARD, PARTS // size))
            for start in range(0, len(rows), most):
                part = slice(start, start + most)
                own = held.get(size, [])
                if own and sum(len(x[0]) for x in own) + len(rows[part]) > most:
                    yield shard(size)
                held.setdefault(size, []).append((ids[rows[part]], whole[part]))
    for size in list(held):
        yield shard(size)


@dataclass
class _Shard:
    ids: np.ndarray
    whole: np.ndarray
    postings: np.ndarray  # vectors of each dimension by rising level
    levels: np.ndarray  # their levels
    starts: np.ndarray  # of each dimension: how many postings are below a level
    lows: np.ndarray
    shifts: np.ndarray

    @classmethod
    def of(cls, row: dict) -> _Shard:
        ids, size = np.array(row["ids"], np.int64), row["parts"]
        postings = np.frombuffer(row["postings"], np.uint16).reshape(size, len(ids))
        levels = np.frombuffer(row["levels"], np.uint8).reshape(size, len(ids))
        starts = np.stack([np.searchsorted(x, np.arange(LEVELS + 1)) for x in levels])
        whole = unpacked(row["vectors"], len(ids), size)
        lows, shifts = np.array(row["lows"], np.float64), np.array(row["shifts"], np.int64)
        return cls(ids, whole, postings.astype(np.int64), levels.astype(np.float64), starts, lows, shifts)

    def members(self, query: np.ndarray, own: int, least: float, most: int) -> np.ndarray:
        """Vectors that may be among the best ``most`` of the query and score ``least`` or more."""
        n, weight = len(self.ids), np.abs(query).astype(np.float64)
        used = np.flatnonzero(weight)
        width = np.exp2(self.shifts)
        unit = weight * width  # of a level
        # Impacts are counted from where they are smallest, up to the top of a level.
        far = self.lows + np.where(query > 0, 0.0, LEVELS * width - 1)
        base = float((query * far).sum())
        blur = float((unit - weight).sum())  # what the levels leave open
        total, met = np.zeros(n), np.zeros(n, np.int64)
        foreign = self.ids != own
        slack = 1e-12 * (abs(base) + float((unit * LEVELS).sum())) + 0.5
        mean = float(unit[used].mean()) * LEVELS / 4 if len(used) else 0.0
        done = np.full(len(weight), LEVELS)  # levels from here on were taken, counted from the far end
        for step in STEPS:
            impact = step * mean  # what was not taken is smaller
            with np.errstate(divide="ignore", invalid="ignore"):
                reach = np.ceil((impact + weight) / unit - 1)
            reach = np.clip(np.nan_to_num(reach, nan=LEVELS, posinf=LEVELS), 0, LEVELS).astype(int)
            reach = np.minimum(reach, done)
            places, impacts = [], []
            for j in used:
                if query[j] > 0:
                    a, b = self.starts[j, reach[j]], self.starts[j, done[j]]
                    level = self.levels[j, a:b]
                else:
                    a, b = self.starts[j, LEVELS - done[j]], self.starts[j, LEVELS - reach[j]]
                    level = LEVELS - 1 - self.levels[j, a:b]
                places.append(self.postings[j, a:b])
                impacts.append(level * unit[j] + (unit[j] - weight[j]))
            done = reach
            if places:
                places = np.concatenate(places)
                total += np.bincount(places, np.concatenate(impacts), n)
                met += np.bincount(places, minlength=n)
            highest = np.where(foreign, base + total + (len(used) - met) * impact + slack, -np.inf)
            lowest = np.where(foreign, base + total - blur - slack, -np.inf)
            if n >= most:
                least = max(least, np.partition(lowest, n - most)[n - most])
            found = np.flatnonzero(foreign & (highest >= least))
            if len(found) <= max(4 * most, n // FEW):
                break
        return found


def _search(batches: Iterator[pa.RecordBatch], block: list[dict], most: int) -> Iterator[pa.RecordBatch]:
    """Per query the best vectors of this task's shards."""
    queries, line = [], 0
    for row in block:
        whole = unpacked(row["vectors"], len(row["ids"]), row["parts"])
        queries += [(line + k, i, row["parts"], whole[k]) for k, i in enumerate(row["ids"])]
        line += len(row["ids"])
    best = Best(line, most)
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            shard = _Shard.of(row)
            lines, scores, keys = [], [], []
            for at, own, size, query in queries:
                if size != row["parts"]:
                    continue
                found = shard.members(query, own, best.least[at], most)
                score = products(query[None], shard.whole[found])[0]
                top = np.lexsort((shard.ids[found], -score))[:most]
                lines.append(np.full(len(top), at))
                scores.append(score[top])
                keys.append(shard.ids[found][top])
            if lines:
                best.add(np.concatenate(lines), np.concatenate(scores), np.concatenate(keys))
    query_ids = np.array([i for _, i, _, _ in queries], np.int64)
    columns = [best.line, query_ids[best.line], best.key, best.score]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["line", "query", "id", "score"])


def build(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index of all vectors, a stored table with one row per shard.

    Parts become ``floor(256 * x)``.  Rows without a key, vectors that are null or empty, hold
    a null or non-finite part, or are longer than 2e9 steps, are left out.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), doubles(vector).alias("parts"))
    return store(rows.where("id is not null").mapInArrow(_shards, _SHARDS), "impacts")


def search(index: DataFrame, queries: DataFrame, most: int = 5) -> DataFrame:
    """The ``most`` best vectors of ``index`` for each vector of ``queries``, itself an index.

    Rows of ``query_id``, ``rank`` (from 1), ``id`` and ``score``, the inner product.  Higher
    scores come first, ties by smaller key.  Vectors with the query's key, and of other
    lengths than the query, are no candidates.  Rows that share a key stand each for itself.
    """
    found = []
    for block in blocks(queries, "number", F.octet_length("vectors"), QUERY_BYTES):
        kept = [{k: row[k] for k in ("ids", "parts", "vectors")} for row in block]
        sent = index.sparkSession.sparkContext.broadcast(kept)
        near = index.mapInArrow(
            lambda batches, sent=sent: _search(batches, sent.value, most), "line long, query long, id long, score long"
        )
        order = Window.partitionBy("line").orderBy(F.desc("score"), "id")
        found.append(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most))
    if not found:
        found.append(index.sparkSession.createDataFrame([], "line long, query long, id long, score long, rank int"))
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    return result.select(F.col("query").alias("query_id"), "rank", "id", "score")
