"""Forests whose samples belong to the rows and not to the tasks that hold them.

How often a row counts in a tree follows from a hash of its keys and the tree's number: a Poisson
variable of mean one, given to the tree as a weight.  Cuts of the features come from the rows
with the smallest hashes.  So the same rows give the same trees in every layout and number of
tasks, and no layout has to be declared or made.  The price is one fit per tree.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 10_000  # rows that the cuts come from
CUTS = 32  # intervals of a feature, at most
MOST = 8  # times that a row counts, at most; more has a probability of one in a million

WEIGHT, HASH = "__weight", "__row_hash"
_CUT = "_interval"


def poisson_limits(most: int = MOST) -> list[float]:
    """Below which uniform numbers a Poisson variable of mean one is 0, 1, 2, ..."""
    total, limits = 0.0, []
    for k in range(most):
        total += math.exp(-1) / math.factorial(k)
        limits.append(total)
    return limits


def weight(uniform: Column) -> Column:
    """How often a row counts, from a number between 0 and 1."""
    limits = poisson_limits()
    out = F.when(uniform < limits[0], 0.0)
    for k, limit in enumerate(limits[1:], 1):
        out = out.when(uniform < limit, float(k))
    return out.otherwise(float(len(limits)))


def uniform(row_hash: str, tree: int, seed: int) -> Column:
    """A number from 0 to 1 for a row and a tree."""
    mixed = F.xxhash64(F.col(row_hash), F.lit(tree), F.lit(seed))
    return F.pmod(mixed, F.lit(1 << 40)) / float(1 << 40)


def cuts(rows: DataFrame, features: list[str], row_hash: str = HASH) -> dict[str, list[float]]:
    """Where each feature is cut: between neighbouring values, or at quantiles of the sample.

    The sample are the rows with the smallest hashes, at most ``SAMPLE`` on the driver.
    """
    found = rows.select(row_hash, *features).orderBy(row_hash, *features).limit(SAMPLE).drop(row_hash).collect()
    out = {}
    for c in features:
        values = sorted(r[c] for r in found if r[c] is not None and r[c] == r[c])
        different = sorted(set(values))
        if len(different) <= CUTS:
            inner = [(a + b) / 2 for a, b in zip(different, different[1:])]
        else:
            inner = sorted({values[len(values) * k // CUTS] for k in range(1, CUTS)} - {different[0]})
        out[c] = [-math.inf, *inner, math.inf]
    return out


def fit(
    imputed: DataFrame,
    features: list[str],
    label: str,
    params: dict,
    seed: int = 42,
    parallelism: int = 4,
    row_hash: str = HASH,
    uniforms: str | None = None,
) -> PipelineModel:
    """A forest on complete rows with a ``row_hash``; the parameters are those of the library's forest.

    ``uniforms`` may give the uniform numbers by an SQL expression with ``{tree}`` in it.  The model cuts the
    features, lets each tree predict and takes the mean.
    """
    params = dict(params)
    trees = int(params.pop("numTrees", 20))
    at = cuts(imputed, features, row_hash)
    inner = [c for c in features if len(at[c]) > 2] or features[:1]
    for c in inner:
        if len(at[c]) == 2:  # one value alone: a cut that parts nothing
            at[c] = [-math.inf, 0.0, math.inf]
    # Numbers of intervals, as numbers and not as categories.
    plain = ", ".join(f"`{c}{_CUT}` + 0.0D AS `{c}{_CUT}_number`" for c in inner)
    stages = [
        Bucketizer(splitsArray=[at[c] for c in inner], inputCols=inner, outputCols=[c + _CUT for c in inner]),
        SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}{_CUT}_number" for c in inner], outputCol="features"),
    ]
    ready = PipelineModel(stages).transform(imputed)

    def one(tree: int):
        number = uniform(row_hash, tree, seed) if uniforms is None else F.expr(uniforms.format(tree=tree))
        rows = ready.withColumn(WEIGHT, weight(number)).where(F.col(WEIGHT) > 0).select("features", label, WEIGHT)
        # All trees of one row layout would draw the same features for a node; the seed tells them apart.
        base = RandomForestRegressor(
            labelCol=label, weightCol=WEIGHT, numTrees=1, bootstrap=False, seed=seed + tree, maxBins=CUTS + 1,
            predictionCol=f"__tree_{tree}", featureSubsetStrategy=params.get("featureSubsetStrategy", "onethird" if trees > 1 else "all"),
        )
        base = base.copy({base.getParam(k): v for k, v in params.items() if k != "featureSubsetStrategy"})
        return base.fit(rows)

    call = inheritable_thread_target(imputed.sparkSession)(one)
    with ThreadPoolExecutor(max_workers=min(parallelism, trees)) as pool:
        models = list(pool.map(call, range(trees)))
    total = " + ".join(f"__tree_{k}" for k in range(trees))
    mean = SQLTransformer(statement=f"SELECT *, ({total}) / {trees} AS prediction FROM __THIS__")
    return PipelineModel([*stages, *models, mean])
