"""The library's forests, grown from merged rows in one pass over the rows.

The library parts a feature into at most ``maxBins`` intervals, and its trees ask for nothing else of a
row.  Rows in the same intervals of all features (a cell) go the same way in every tree, so three sums for
each cell and tree (of how often its rows are drawn, of their labels and of the squares) say all that a tree
needs.  The cuts of the features and how often a row is drawn come from the library's own code; so do, by the
same numbers drawn at random, the features that a node may use.  So the trees are those of ``RandomForestRegressor``.

The library passes over all rows for each level, for all trees.  Here they are read once for all forests, and the
cells, whose number does not depend on how many rows there are, are grown into trees in one task for each forest.
Errors come from sums of cells as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.plans import shallow

LEAST_ROWS = 100_000  # below, the library's passes cost little
MOST_CELLS = 1 << 20  # four features of 32 intervals
MOST_TREES = 32  # the library goes through so many in their order
BUCKET_ROWS = 250_000  # of a task that merges cells
CHUNK_ROWS = 500_000  # of a task that are sorted at a time

# Parameters that these forests know; others have the library's defaults.
KNOWN = {"numTrees", "maxDepth", "maxBins", "bootstrap", "subsamplingRate", "featureSubsetStrategy"}

_IMPL = "org.apache.spark.ml.tree.impl"
_BLOCKS = "bucket int, cells binary, labels binary, counts binary, sums binary"
_SUMS = "forest int, cells binary, sums binary"
_TREES = "forest int, tree int, said binary, feature binary, cut binary, below binary"


@dataclass(frozen=True)
class Forest:
    """Per tree the predictions of its nodes, their features and last intervals to the left, and their children."""

    trees: list[tuple[np.ndarray, ...]]
    depth: int


@dataclass(frozen=True)
class Cuts:
    """Where the library cuts the features, in its own form, and how many intervals each has."""

    splits: JavaObject
    metadata: JavaObject
    widths: list[int]

    @property
    def cells(self) -> int:
        return prod(self.widths)


def _module(spark: SparkSession, name: str) -> JavaObject:
    """A Scala object of the library."""
    at = spark._jvm
    for part in f"{name}$".split("."):
        at = getattr(at, part)
    return getattr(at, "MODULE$")


def _bean(spark: SparkSession, name: str, **fields: JavaObject) -> JavaObject:
    """An encoder for objects of a class, by their methods."""
    jvm = spark._jvm
    encoders = jvm.org.apache.spark.sql.catalyst.encoders
    found = jvm.java.util.ArrayList()
    for field, encoder in fields.items():
        nothing = jvm.org.apache.spark.sql.types.Metadata.empty()
        found.add(
            getattr(encoders, "AgnosticEncoders$EncoderField")(
                field, encoder, False, nothing, jvm.scala.Some(field), _module(spark, "scala.None")
            )
        )
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    tag = jvm.scala.reflect.ClassTag.apply(jvm.java.lang.Class.forName(name, True, loader))
    return getattr(encoders, "AgnosticEncoders$JavaBeanEncoder")(
        tag, jvm.scala.jdk.javaapi.CollectionConverters.asScala(found).toSeq()
    )


def _encoders(spark: SparkSession) -> tuple[JavaObject, JavaObject]:
    """Encoders of integers in a row, and of a point in its intervals."""
    package = "org.apache.spark.sql.catalyst.encoders.AgnosticEncoders"
    encoders = spark._jvm.org.apache.spark.sql.catalyst.encoders
    integers = getattr(encoders, "AgnosticEncoders$ArrayEncoder")(_module(spark, f"{package}$PrimitiveIntEncoder"), False)
    number = _module(spark, f"{package}$PrimitiveDoubleEncoder")
    return integers, _bean(spark, f"{_IMPL}.TreePoint", label=number, binnedFeatures=integers)


def _instances(rows: DataFrame, estimator: RandomForestRegressor) -> JavaObject:
    """The rows as the library reads and checks them."""
    spark = rows.sparkSession
    estimator._transfer_params_to_java()
    utils = _module(spark, "org.apache.spark.ml.util.DatasetUtils")
    return utils.extractInstances(estimator._java_obj, rows._jdf, _module(spark, "scala.None"))


def _metadata(instances: JavaObject, estimator: RandomForestRegressor, spark: SparkSession) -> JavaObject:
    java = estimator._java_obj
    regression = _module(spark, "org.apache.spark.mllib.tree.configuration.Algo").Regression()
    categories = spark._jvm.scala.collection.immutable.HashMap()
    strategy = java.getOldStrategy(categories, 0, regression, java.getOldImpurity())
    return _module(spark, f"{_IMPL}.DecisionTreeMetadata").buildMetadata(
        instances, strategy, estimator.getNumTrees(), estimator.getFeatureSubsetStrategy()
    )


def suits(estimators: list[RandomForestRegressor], parameters: set[str], rows: int) -> bool:
    """Whether forests may be grown from so many rows, as far as is known before the cuts are."""
    alike = {(e.getMaxBins(), e.getSeed()) for e in estimators}
    return (
        rows >= LEAST_ROWS
        and len(alike) == 1
        and parameters <= KNOWN
        and all(e.getNumTrees() <= MOST_TREES for e in estimators)
    )


def grow(ready: DataFrame, estimators: list[RandomForestRegressor], rows: int) -> tuple[list[Forest], Cuts] | None:
    """The forests that the library would fit on ``features`` and a label, and its cuts; None if that takes too many cells."""
    spark = ready.sparkSession
    first = estimators[0]
    instances = _instances(ready, first)
    metadata = _metadata(instances, first, spark)
    splits = _module(spark, f"{_IMPL}.RandomForest").findSplits(instances, metadata, first.getSeed())
    cuts = Cuts(splits, metadata, [len(s) + 1 for s in splits])
    if cuts.cells > min(MOST_CELLS, rows):
        return None
    one = ready.limit(1)
    kinds = []
    for e in estimators:
        used = _metadata(_instances(one, e), e, spark).numFeaturesPerNode()
        kinds.append((e.getNumTrees(), e.getMaxDepth(), used, e.getSeed()))
        # Beyond its memory the library grows a level in several steps, which draw other features.
        nodes = e.getNumTrees() << max(0, e.getMaxDepth() - 1)
        if nodes * used * max(cuts.widths) * 24 > e.getMaxMemoryInMB() << 20:
            return None
    trees = [e.getNumTrees() for e in estimators]
    buckets = max(1, rows // BUCKET_ROWS)
    blocks = _drawn(spark, instances, cuts, estimators).mapInArrow(_packed(cuts.widths, buckets), _BLOCKS)
    sums = blocks.repartition(buckets, "bucket").mapInArrow(_merged(cuts.cells, trees, buckets), _SUMS)
    grown = sums.repartition(len(trees), "forest").mapInArrow(_grown(cuts.widths, kinds), _TREES).collect()
    forests = []
    for k, (n, depth, *_) in enumerate(kinds):
        own = sorted((r for r in grown if r["forest"] == k), key=lambda r: r["tree"])
        if [r["tree"] for r in own] != [*range(n)]:
            raise RuntimeError(f"{len(own)} trees of {n}")
        forests.append(Forest([_arrays(r) for r in own], depth))
    return forests, cuts


def _arrays(row) -> tuple[np.ndarray, ...]:
    said = np.frombuffer(row["said"], np.float64)
    feature, cut, below = (np.frombuffer(row[c], np.int32) for c in ("feature", "cut", "below"))
    last = below == np.arange(len(below))
    return said, feature, cut.astype(np.float64), below, np.where(last, below, below + 1).astype(np.int32)


def _drawn(spark: SparkSession, instances: JavaObject, cuts: Cuts, estimators: list[RandomForestRegressor]) -> DataFrame:
    """Per row its label, its intervals, and how often each tree of each forest draws it."""
    bagging = _module(spark, f"{_IMPL}.BaggedPoint")
    integers, encoder = _encoders(spark)
    points = _module(spark, f"{_IMPL}.TreePoint").convertToTreeRDD(instances, cuts.splits, cuts.metadata)
    path, columns = "", []
    for e in estimators:  # each forest's draws around those of the ones before
        weight = getattr(bagging, "convertToBaggedRDD$default$5")()
        points = bagging.convertToBaggedRDD(
            points, e.getSubsamplingRate(), e.getNumTrees(), e.getBootstrap(), weight, e.getSeed()
        )
        encoder = _bean(spark, f"{_IMPL}.BaggedPoint", datum=encoder, subsampleCounts=integers)
    for k in reversed(range(len(estimators))):
        columns.insert(0, F.col(f"{path}subsampleCounts").alias(f"draws_{k}"))
        path += "datum."
    rows = DataFrame(spark._jsparkSession.createDataset(points, encoder).toDF(), spark)
    return rows.select(F.col(f"{path}label").alias("label"), F.col(f"{path}binnedFeatures").alias("intervals"), *columns)


# The functions below run on the executors and use nothing of this package, which those then need not have.


def _packed(widths: list[int], buckets: int):
    """A task's rows by buckets of cells: the rows themselves, or sums of a cell's rows where they are smaller."""
    strides = np.cumprod([1, *widths[:-1]])

    def records(cell: np.ndarray, label: np.ndarray, drawn: np.ndarray) -> Iterator[dict]:
        order = np.argsort(cell, kind="stable")
        cell, label, drawn = cell[order], label[order], drawn[order]
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sizes = np.diff(np.r_[starts, len(cell)])
        trees = drawn.shape[1]
        many = sizes * (12 + trees) > 4 + 24 * trees
        heavy = np.repeat(many, sizes)
        if many.any():
            at, y, often = np.cumsum(sizes[many]) - sizes[many], label[heavy], drawn[heavy]
            sums = np.empty((len(at), 3, trees))
            for t in range(trees):
                w = often[:, t].astype(np.float64)
                for i, values in enumerate((w, w * y, w * y * y)):
                    sums[:, i, t] = np.add.reduceat(values, at)
            yield from parted(cell[starts[many]], None, None, sums)
        yield from parted(cell[~heavy], label[~heavy], drawn[~heavy], None)

    def parted(cell, label, drawn, sums) -> Iterator[dict]:
        bucket = cell % buckets
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            own = order[ends[b] : ends[b + 1]]
            if len(own):
                yield {
                    "bucket": b,
                    "cells": cell[own].astype(np.int32).tobytes(),
                    "labels": None if label is None else label[own].tobytes(),
                    "counts": None if drawn is None else drawn[own].tobytes(),
                    "sums": None if sums is None else sums[own].tobytes(),
                }

    types = {"bucket": pa.int32(), "cells": pa.binary(), "labels": pa.binary(), "counts": pa.binary(), "sums": pa.binary()}
    schema = pa.schema(list(types.items()))

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def chunk() -> pa.RecordBatch:
            parts = [np.concatenate(p) for p in zip(*held, strict=True)]
            return pa.RecordBatch.from_pylist([*records(*parts)], schema)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            label, intervals, *draws = batch.columns
            cell = intervals.flatten().to_numpy().reshape(n, len(widths)) @ strides
            drawn = np.concatenate([d.flatten().to_numpy().reshape(n, -1) for d in draws], axis=1)
            if drawn.max() > 255:
                raise ValueError("a tree draws a row more than 255 times")
            held.append((cell, label.to_numpy(), drawn.astype(np.uint8)))
            rows += n
            if rows >= CHUNK_ROWS:
                yield chunk()
                held, rows = [], 0
        if held:
            yield chunk()

    return call


def _merged(cells: int, trees: list[int], buckets: int):
    """The sums of each cell that has rows, for the trees of each forest."""
    total, size = sum(trees), -(-cells // buckets)
    ends = np.cumsum([0, *trees])
    schema = pa.schema([("forest", pa.int32()), ("cells", pa.binary()), ("sums", pa.binary())])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        found: dict[int, np.ndarray] = {}
        held: dict[int, list] = {}

        def add(bucket: int) -> None:
            at, y, drawn = (np.concatenate(p) for p in zip(*held.pop(bucket), strict=True))
            for t in range(total):
                w = drawn[:, t].astype(np.float64)
                for i, values in enumerate((w, w * y, w * y * y)):
                    sums[bucket][i, t] += np.bincount(at, values, size)

        for batch in batches:
            for row in batch.to_pylist():
                b = row["bucket"]
                at = np.frombuffer(row["cells"], np.int32) // buckets
                if b not in sums:
                    sums[b], found[b] = np.zeros((3, total, size)), np.zeros(size, bool)
                found[b][at] = True
                if row["sums"] is not None:  # a cell comes once in a record
                    sums[b][:, :, at] += np.frombuffer(row["sums"]).reshape(len(at), 3, total).transpose(1, 2, 0)
                    continue
                drawn = np.frombuffer(row["counts"], np.uint8).reshape(len(at), total)
                held.setdefault(b, []).append((at, np.frombuffer(row["labels"]), drawn))
                if sum(len(x[0]) for x in held[b]) >= BUCKET_ROWS:
                    add(b)
        for b in [*sums]:
            if b in held:
                add(b)
            at = np.flatnonzero(found[b])
            cell = (at * buckets + b).astype(np.int32).tobytes()
            for k in range(len(trees)):
                own = np.ascontiguousarray(sums[b][:, ends[k] : ends[k + 1], at]).tobytes()
                yield pa.RecordBatch.from_pylist([{"forest": k, "cells": cell, "sums": own}], schema)
            del sums[b]

    return call


def _grown(widths: list[int], kinds: list[tuple[int, int, int, int]]):
    """The trees of forests from sums of their cells, as ``RandomForest`` of the library grows them."""
    strides, none = np.cumprod([1, *widths[:-1]]), np.finfo(float).eps
    mask = (1 << 64) - 1

    def longs(seed: int) -> Iterator[int]:
        """``java.util.Random.nextLong``, as 64 bits."""
        state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)
        while True:
            halves = []
            for _ in range(2):
                state = (state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
                halves.append(state >> 16)
            low = halves[1] - (1 << 32) if halves[1] >> 31 else halves[1]
            yield ((halves[0] << 32) + low) & mask

    def murmur(words: list[int], state: int) -> int:
        """``MurmurHash3.bytesHash`` of eight bytes."""
        low = (1 << 32) - 1
        for word in words:
            word = word * 0xCC9E2D51 & low
            word = (word << 15 | word >> 17) * 0x1B873593 & low
            state ^= word
            state = ((state << 13 | state >> 19) & low) * 5 + 0xE6546B64 & low
        state ^= 8
        state = (state ^ state >> 16) * 0x85EBCA6B & low
        state = (state ^ state >> 13) * 0xC2B2AE35 & low
        return state ^ state >> 16

    def subset(features: int, wanted: int, seed: int) -> list[int]:
        """``SamplingUtils.reservoirSampleAndCount`` of the features, with an ``XORShiftRandom``."""
        kept = list(range(wanted))
        words = [int.from_bytes(seed.to_bytes(8, "big")[i : i + 4], "little") for i in (0, 4)]
        low = murmur(words, 0x3C074A61)
        state = murmur(words, low) << 32 | low

        def bits(n: int) -> int:
            nonlocal state
            state ^= state << 21 & mask
            state ^= state >> 35
            state ^= state << 4 & mask
            return state & (1 << n) - 1

        for item in range(wanted, features):
            number = ((bits(26) << 27) + bits(27)) * 2.0**-53
            place = int(number * (item + 1))
            if place < wanted:
                kept[place] = item
        return kept

    def scala_order(keys: list[int], shift: int = 0) -> list[int]:
        """In which order a ``Map`` of the library goes through its keys."""
        if len(keys) <= 4 and not shift:
            return sorted(keys, key=lambda k: (k & 15, k))
        slots: dict[int, list[int]] = {}
        for k in keys:
            slots.setdefault(improved(k) >> shift & 31, []).append(k)
        alone = [slots[i][0] for i in sorted(slots) if len(slots[i]) == 1]
        return alone + [k for i in sorted(slots) if len(slots[i]) > 1 for k in scala_order(slots[i], shift + 5)]

    def improved(h: int) -> int:
        """``Hashing.improve`` of Scala."""
        low = (1 << 32) - 1
        h = h + ~(h << 9) & low
        h = h ^ h >> 14
        h = h + (h << 4) & low
        return h ^ h >> 10

    def variance(n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
        some = np.where(n == 0, 1.0, n)
        return np.where(n == 0, 0.0, (squares - total * total / some) / some)

    def forest(cells: np.ndarray, parts: list[np.ndarray], trees: int, depth: int, wanted: int, seed: int) -> list[tuple]:
        bins = (cells[None, :] // strides[:, None] % np.array(widths)[:, None]).astype(np.int32)
        numbers = longs(seed)
        grown = [{"said": [0.0], "feature": [0], "cut": [0], "below": [0], "impurity": [0.0]} for _ in range(trees)]
        at = [np.zeros(len(cells), np.int32) for _ in range(trees)]  # the node that holds each cell
        stack = [(t, 0) for t in reversed(range(trees))]  # the library puts new nodes before old ones
        for level in range(depth + 1):
            subsets: dict[int, list[tuple[int, list[int]]]] = {}
            for t, node in stack:
                features = subset(len(widths), wanted, next(numbers)) if wanted < len(widths) else [*range(len(widths))]
                subsets.setdefault(t, []).append((node, features))
            stack = []
            for t in scala_order([*subsets]):
                stack += [(t, node) for node in part(grown[t], at, t, subsets[t], parts, bins, level, depth)]
            stack.reverse()
            if not stack:
                break
        return grown

    def part(tree: dict, at: list, t: int, nodes: list, parts: list[np.ndarray], bins: np.ndarray, level: int, depth: int) -> list[int]:
        """Split nodes of a tree where that gains something; returns the children that may be split in turn."""
        slot = np.full(len(tree["said"]), -1, np.int32)
        slot[[node for node, _ in nodes]] = np.arange(len(nodes))
        active = np.flatnonzero(slot[at[t]] >= 0)
        key = slot[at[t][active]]
        n = len(nodes)
        values = np.concatenate([p[:, t] for p in parts], axis=1)[:, active]
        if level == 0:
            whole = values.sum(axis=1)
            tree["said"][0] = float(whole[1] / whole[0]) if whole[0] else 0.0
            tree["impurity"][0] = float(variance(*whole))
        impurity = np.array([tree["impurity"][node] for node, _ in nodes])[:, None]
        best: dict[int, tuple] = {}
        for f in {f for _, features in nodes for f in features if widths[f] > 1}:
            flat = key * widths[f] + bins[f][active]
            sums = np.stack([np.bincount(flat, v, n * widths[f]).reshape(n, widths[f]) for v in values])
            sums = np.cumsum(sums, axis=2)
            left, right = sums[:, :, :-1], sums[:, :, -1:] - sums[:, :, :-1]
            rows = np.maximum(left[0] + right[0], 1.0)
            spread_left, spread_right = variance(*left), variance(*right)
            gain = impurity - left[0] / rows * spread_left - right[0] / rows * spread_right
            gain = np.where((left[0] < 1) | (right[0] < 1) | (gain < 0), -np.inf, gain)
            cut = np.argmax(gain, axis=1)
            of = np.arange(n)
            best[f] = (gain[of, cut], cut, left[:, of, cut], right[:, of, cut], spread_left[of, cut], spread_right[of, cut])
        feature, split, child = np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, -1, np.int32)
        again = []
        for k, (node, features) in enumerate(nodes):
            able = [f for f in features if f in best]
            f = max(able, key=lambda f: best[f][0][k], default=None)  # the first of equal ones
            if f is None or not best[f][0][k] > 0 or level == depth:
                continue
            _, cut, left, right, *spreads = (x[..., k] for x in best[f])
            feature[k], split[k], child[k] = f, cut, len(tree["said"])
            tree["feature"][node], tree["cut"][node], tree["below"][node] = f, int(cut), int(child[k])
            for (rows, total, _), spread in ((left, spreads[0]), (right, spreads[1])):
                new = len(tree["said"])
                for name, value in (("said", total / rows), ("feature", 0), ("cut", 0), ("below", new), ("impurity", spread)):
                    tree[name].append(value)
                if level + 1 < depth and abs(spread) >= none:
                    again.append(new)
        goes = bins[feature[key], active] > split[key]
        at[t][active] = np.where(child[key] >= 0, child[key] + goes, at[t][active])
        return again

    schema = pa.schema([("forest", pa.int32()), ("tree", pa.int32()), *((c, pa.binary()) for c in ("said", "feature", "cut", "below"))])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for forest_, cells, sums in zip(*batch.columns, strict=True):
                cell = np.frombuffer(cells.as_buffer(), np.int32)
                if not len(cell):
                    continue
                k = forest_.as_py()
                some, parts = found.setdefault(k, ([], []))
                some.append(cell)
                parts.append(np.frombuffer(sums.as_buffer()).reshape(3, kinds[k][0], len(cell)))
        for k, (some, parts) in found.items():
            trees = forest(np.concatenate(some), parts, *kinds[k])
            rows = [
                {
                    "forest": k,
                    "tree": t,
                    "said": np.array(tree["said"], np.float64).tobytes(),
                    **{c: np.array(tree[c], np.int32).tobytes() for c in ("feature", "cut", "below")},
                }
                for t, tree in enumerate(trees)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return call


def cell_sums(ready: DataFrame, estimator: RandomForestRegressor, cuts: Cuts, origin: float) -> DataFrame:
    """How many rows of ``features`` and a label each cell has, and the sums and squares of labels counted from ``origin``.

    The intervals are the columns ``x0``, ``x1``, ...
    """
    spark = ready.sparkSession
    _, encoder = _encoders(spark)
    points = _module(spark, f"{_IMPL}.TreePoint").convertToTreeRDD(_instances(ready, estimator), cuts.splits, cuts.metadata)
    rows = DataFrame(spark._jsparkSession.createDataset(points, encoder).toDF(), spark)
    intervals = [f"x{i}" for i in range(len(cuts.widths))]
    y = F.col("label") - F.lit(origin)
    places = [F.col("binnedFeatures")[i].alias(c) for i, c in enumerate(intervals)]
    return (
        rows.select(y.alias("y"), *places)
        .groupBy(*intervals)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("y").alias("total"), F.sum(F.col("y") * F.col("y")).alias("squares"))
    )


def prediction(forest: Forest, depth: int, cuts: Cuts) -> Column:
    """What a forest, grown to a depth or cut there, says of each cell of ``cell_sums``."""
    return shallow.walked(forest.trees, depth, [f"x{i}" for i in range(len(cuts.widths))])


def errors(cells: DataFrame, predictions: list[Column], origin: float) -> list[float | None]:
    """Root mean squared errors of predictions from ``cell_sums``, in one pass."""
    names = [f"prediction_{i}" for i in range(len(predictions))]
    said = cells.select("rows", "total", "squares", *[p.alias(n) for p, n in zip(predictions, names, strict=True)])
    out = []
    for name in names:
        p = F.col(name) - F.lit(origin)
        squares = F.sum(F.col("rows") * p * p - 2 * p * F.col("total") + F.col("squares"))
        out.append(F.sqrt(F.greatest(squares, F.lit(0.0)) / F.sum("rows")).alias(name))
    return list(said.agg(*out).first())
