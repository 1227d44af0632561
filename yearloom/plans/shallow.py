"""Forests of smaller depth, cut from a deeper one.

The library grows its trees level by level, and a node's rows, features and split do not depend on how deep
its tree may become.  So forests that differ in depth only have the same upper levels, and a forest
of smaller depth predicts what the nodes of its last level say.  (Where a level has more nodes than the
library's ``maxMemoryInMB`` holds, features of nodes may be drawn in another order; they are as good.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

DEPTH = "maxDepth"


def sources(points: list[tuple[object, dict]]) -> list[int]:
    """Per point, a family and its parameters, the place of the deepest one that differs in depth only."""
    rest = [(family, {k: v for k, v in params.items() if k != DEPTH}, DEPTH in params) for family, params in points]
    out = []
    for i, own in enumerate(rest):
        alike = [j for j, other in enumerate(rest) if other == own and own[2]] or [i]
        out.append(max(alike, key=lambda j: points[j][1].get(DEPTH, 0)))
    return out


def _nodes(tree: Model, depth: int) -> tuple[np.ndarray, ...]:
    """Predictions of a tree's upper nodes, their features and thresholds, and the places of their children.

    The last nodes are their own children.
    """
    nodes = [(tree._call_java("rootNode"), 0)]
    rows = []
    for node, level in nodes:
        split, left = None, len(rows)
        if level < depth and node.getClass().getSimpleName() == "InternalNode":
            split, left = node.split(), len(nodes)
            nodes += [(node.leftChild(), level + 1), (node.rightChild(), level + 1)]
        feature, threshold = (split.featureIndex(), split.threshold()) if split else (0, 0.0)
        rows.append((node.prediction(), feature, threshold, left, left + bool(split)))
    kinds = (np.float64, np.int32, np.float64, np.int32, np.int32)
    return tuple(np.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True))


def prediction(model: Model, depth: int, features: list[str]) -> Column:
    """What a forest on the numbers ``features`` would predict had it been grown to a smaller depth."""
    return walked([_nodes(tree, depth) for tree in model.trees], depth, features)


def walked(trees: list[tuple[np.ndarray, ...]], depth: int, features: list[str]) -> Column:
    """The mean of what trees say, each after so many steps from its first node; see ``_nodes``."""

    # Uses nothing of this package, which the executors then need not have.
    def call(*values: pa.Array) -> pa.Array:
        x = np.array([v.to_numpy(zero_copy_only=False) for v in values], np.float64)
        total, row = np.zeros(x.shape[1]), np.arange(x.shape[1])
        for said, feature, threshold, left, right in trees:
            at = np.zeros(x.shape[1], np.int32)
            for _ in range(depth):
                at = np.where(x[feature[at], row] <= threshold[at], left[at], right[at])
            total += said[at]
        return pa.array(total / len(trees))

    return F.arrow_udf(call, DoubleType())(*[F.col(f"`{c}`") for c in features])
