"""Forests grown from merged rows, against those of the library and against brute force."""

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from yearloom.plans import merged, shallow, training
from yearloom.specs import Family, ModelSpec

FOREST = Family("forest", "forest", (("numTrees", (3, 8)), ("maxDepth", (2, 7))))
SPEC = ModelSpec(
    experiment="merged", model_name="Merged", label="y", features=("a", "b", "c", "d"), required=("y",), keys=("id",),
    families=(FOREST,), folds=3, min_rows=1, partitions=3,
)


def noise(salt, values):
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(values)).cast("double")


@pytest.fixture(scope="module")
def rows(spark):
    """Missing values, a feature of one value, and a third of the rows in one cell; whole labels, so that sums are exact."""
    df = spark.range(3000).select(
        "id", noise(1, 9).alias("a"), noise(2, 3).alias("b"), noise(3, 50).alias("c"), F.lit(7.0).alias("d"), noise(4, 40).alias("n")
    )
    same = F.col("id") % 3 == 0
    df = df.withColumns({c: F.when(same, F.lit(2.0)).otherwise(F.col(c)) for c in "abc"})
    return df.select(
        "id", F.when(F.col("id") % 11 != 1, F.col("a")).alias("a"), "b", "c", "d",
        F.floor(F.col("a") * F.col("b") + 2 * F.abs(F.col("c") - 20) + F.col("n")).cast("double").alias("y"),
    )


def same_tree(model, depth, own, thresholds):
    """Whether two trees ask and say the same; the library's leaves out nodes whose children say the same."""
    said, feature, threshold, left, right = shallow._nodes(model, depth)
    pairs = [(0, 0)]
    for i, j in pairs:
        if abs(said[i] - own[0][j]) > 1e-9:
            return False
        if left[i] != i:
            if own[3][j] == j or feature[i] != own[1][j] or threshold[i] != thresholds[own[1][j]][int(own[2][j])]:
                return False
            pairs += [(left[i], own[3][j]), (right[i], own[4][j])]
    return True


def test_the_trees_are_those_of_the_library(rows):
    frame = training._laid_out(training.model_frame(rows, SPEC), SPEC).cache()
    ready = training.preparation(list("abcd")).fit(frame).transform(frame).select("features", "y")
    kinds = ((10, 8, {}), (20, 6, {}), (1, 4, {}), (6, 0, {}), (5, 5, {"bootstrap": False}), (4, 5, {"subsamplingRate": 0.4}))
    estimators = [RandomForestRegressor(labelCol="y", numTrees=n, maxDepth=d, seed=42, **more) for n, d, more in kinds]
    forests, cuts = merged.grow(ready, estimators, 3000)
    assert cuts.widths == [10, 3, 32, 1]  # with the mean of missing ones
    thresholds = [[s.threshold() for s in of] for of in cuts.splits]
    for estimator, forest in zip(estimators, forests, strict=True):
        model, depth = estimator.fit(ready), estimator.getMaxDepth()
        assert len(forest.trees) == len(model.trees)
        assert all(same_tree(a, depth, b, thresholds) for a, b in zip(model.trees, forest.trees, strict=True))


def test_errors_are_those_of_the_library(rows, monkeypatch):
    by_library = training.tune(rows, SPEC)
    monkeypatch.setattr(merged, "LEAST_ROWS", 0)
    monkeypatch.setattr(training, "_fit_all", lambda *_: pytest.fail("fitted by the library"))
    for own, other in zip(training.tune(rows, SPEC), by_library, strict=True):
        assert own.params == other.params and own.fold_rmse == pytest.approx(other.fold_rmse, rel=1e-9)


def test_rows_are_read_as_often_for_deep_and_many_trees(spark, rows, monkeypatch):
    monkeypatch.setattr(merged, "LEAST_ROWS", 0)
    jobs = []
    for trees, depths in ((2, (1,)), (9, (3, 8))):
        family = Family("forest", "forest", (("numTrees", (trees,)), ("maxDepth", depths)))
        group = f"depths-{depths}"
        spark.sparkContext.setJobGroup(group, "tune")
        training.tune(rows, replace(SPEC, families=(family,)))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    assert jobs[0] == jobs[1]


def test_what_does_not_suit_is_left_to_the_library(rows, monkeypatch):
    small, large = RandomForestRegressor(numTrees=5), RandomForestRegressor(numTrees=100)
    assert merged.suits([small], {"numTrees", "maxDepth"}, 10**6)
    assert not merged.suits([small], {"numTrees"}, 99_999)
    assert not merged.suits([small], {"minInfoGain"}, 10**6)
    assert not merged.suits([small, large], {"numTrees"}, 10**6)
    assert not merged.suits([small, small.copy({small.maxBins: 8})], {"maxBins"}, 10**6)
    monkeypatch.setattr(merged, "LEAST_ROWS", 0)
    monkeypatch.setattr(merged, "MOST_CELLS", 100)
    fits, fit_all = [], training._fit_all
    monkeypatch.setattr(training, "_fit_all", lambda es, *a: fits.extend(es) or fit_all(es, *a))
    grid = training.tune(rows, replace(SPEC, folds=2))
    assert len(fits) == 4 and all(None not in p.fold_rmse for p in grid)


@pytest.mark.parametrize("chunk", [50, 10_000])
def test_sums_of_cells(monkeypatch, chunk):
    """A cell of many rows among cells of few, in chunks and batches of several sizes."""
    monkeypatch.setattr(merged, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(merged, "BUCKET_ROWS", 120)
    r = np.random.default_rng(3)
    widths, trees, buckets, n = [4, 3, 10], [2, 3], 7, 900
    bins = np.column_stack([r.integers(0, w, n) for w in widths]).astype(np.int32)
    bins[::2] = (1, 2, 3)
    y, drawn = r.normal(5, 2, n), r.poisson(1, (n, 5)).astype(np.int32)
    lists = lambda a: pa.ListArray.from_arrays(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32), a.ravel())
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(y[i : i + 37]), lists(bins[i : i + 37]), lists(drawn[i : i + 37, :2]), lists(drawn[i : i + 37, 2:])], ["label", "intervals", "draws_0", "draws_1"]
        )
        for i in range(0, n, 37)
    ]
    packed = [*merged._packed(widths, buckets)([batches[0].slice(0, 0), *batches])]
    records = [row for batch in packed for row in batch.to_pylist()]
    assert {row["sums"] is None for row in records} == {True, False}
    found = {}
    for batch in merged._merged(120, trees, buckets)(packed):
        for row in batch.to_pylist():
            cells = np.frombuffer(row["cells"], np.int32)
            sums = np.frombuffer(row["sums"]).reshape(3, trees[row["forest"]], -1)
            for k, c in enumerate(cells):
                assert (row["forest"], int(c)) not in found
                found[row["forest"], int(c)] = sums[:, :, k]
    cell = bins @ [1, 4, 12]
    assert {c for _, c in found} == {*cell.tolist()} and len(found) == 2 * len({*cell.tolist()})
    for (k, c), sums in found.items():
        w, own = drawn[cell == c][:, [slice(0, 2), slice(2, 5)][k]], y[cell == c][:, None]
        assert np.allclose(sums, [w.sum(0), (w * own).sum(0), (w * own * own).sum(0)])
