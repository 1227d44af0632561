"""Cross-validation from sums, against fits by the library and by brute force."""

from dataclasses import replace
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from yearloom.plans import gram, training
from yearloom.specs import Family, ModelSpec

GRID = (("regParam", (0.0, 0.3, 5.0)), ("elasticNetParam", (0.0, 0.5, 1.0)))
SPEC = ModelSpec(
    experiment="sums",
    model_name="Sums",
    label="y",
    features=("a", "b", "c", "d"),
    required=("y",),
    keys=("id",),
    families=(Family("linear", "linear", GRID),),
    folds=3,
    min_rows=1,
    fold="id % 3",
    split="id % 7 > 0",
)


def rows(n=300):
    """Correlated features far from zero, with missing values in three of them, and one without spread."""
    r = np.random.default_rng(1)
    a, b = r.normal(2000, 3, n), r.normal(5, 1, n)
    c = 2 * b + r.normal(0, 0.2, n)
    y = 3 * a - 2 * b + c + r.normal(0, 2, n) + 1e5
    missing = lambda x, share: [None if m else float(v) for v, m in zip(x, r.random(n) < share, strict=True)]
    nan = [float("nan") if k % 11 == 0 else v for k, v in enumerate(missing(c, 0.1))]
    return [tuple(x) for x in zip(range(n), missing(a, 0.2), missing(b, 0.3), nan, [7.0] * n, y.tolist(), strict=True)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), "id long, a double, b double, c double, d double, y double")


def test_errors_agree_with_fits_by_the_library(df):
    # Without the feature that has no spread, which leaves the library with no single solution.
    grid = training.tune(df, replace(SPEC, features=("a", "b", "c")))
    with_flat = training.tune(df, SPEC)
    assert len(grid) == 9 and all(len(p.fold_rmse) == 3 for p in grid)
    for point, same in zip(grid, with_flat, strict=True):
        assert point.fold_rmse == pytest.approx(same.fold_rmse, rel=1e-9)
    frame = training.model_frame(df, SPEC).where("__split = 'train'")
    for fold in range(3):
        inside, outside = frame.where(F.col("__fold") != fold), frame.where(F.col("__fold") == fold)
        prepare = training.preparation(["a", "b", "c"]).fit(inside)
        ready, held = prepare.transform(inside).cache(), prepare.transform(outside).cache()
        for point in grid:
            model = LinearRegression(labelCol="y", tol=1e-12, maxIter=1000, **point.params).fit(ready)
            error = model.transform(held).select(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
            # With absolute values the library stops where its line search does.
            sharp = point.params["regParam"] * point.params["elasticNetParam"] == 0
            assert point.fold_rmse[fold] == pytest.approx(error, rel=1e-6 if sharp else 1e-3)


def test_absolute_values_have_the_least_sum():
    """The conditions that hold at the minimum, and nowhere else."""
    r = np.random.default_rng(2)
    for _ in range(20):
        x = r.normal(size=(50, 6)) @ r.normal(size=(6, 6))
        matrix = np.corrcoef(x.T)
        right = matrix @ r.normal(size=6) * (r.random(6) < 0.5)
        found = gram._descent(matrix, right, 0.3, 0.1)
        slope = right - matrix @ found - 0.1 * found
        assert np.allclose(slope[found != 0], 0.3 * np.sign(found[found != 0]), atol=1e-7)
        assert (np.abs(slope[found == 0]) <= 0.3 + 1e-7).all()


def test_sums_are_merged_and_imputed(df):
    """Sums of parts are the sums of all rows, and means enter them as if rows had been filled."""
    origin = {"a": 2000.0, "b": 4.0, "y": 1e5}
    parts = gram.sums(
        df.withColumn("part", F.col("id") % 4), ["a", "b", "c"], "y", "part", origin
    )
    whole = reduce(add, parts.values())
    x = np.array([[np.nan if v is None else v for v in (r[1], r[2], r[3], r[5])] for r in rows()], float)
    x -= [2000.0, 4.0, 0.0, 1e5]
    means = np.nanmean(x[:, :3], axis=0)
    assert whole.means() == pytest.approx(means) and whole.rows == 300
    filled = np.column_stack([np.where(np.isnan(x[:, :3]), means, x[:, :3]), x[:, 3], np.ones(300)])
    assert np.allclose(whole.imputed(means), filled.T @ filled, rtol=1e-9, atol=1e-6)
    line = gram.fit(whole)
    solved = np.linalg.lstsq(filled[:, [0, 1, 2, 4]], filled[:, 3], rcond=None)[0]
    assert np.allclose([*line.coefficients, line.intercept], solved, rtol=1e-6)
    assert gram.rmse(whole, line) == pytest.approx(np.sqrt(np.mean((filled[:, [0, 1, 2, 4]] @ solved - filled[:, 3]) ** 2)))


def test_labels_and_features_without_spread(spark):
    flat = spark.createDataFrame([(k, 1.0, None, 2.0, 3.0, 4.0) for k in range(20)], "id long, a double, b double, c double, d double, y double")
    grid = training.tune(flat, replace(SPEC, all_null="drop"))
    assert all(p.fold_rmse == [0.0] * 3 and p.avg_rmse == 0.0 for p in grid)
    assert gram.rmse(gram.Gram(np.zeros((4, 4)), np.zeros(2)), gram.Line(np.zeros(1), np.zeros(1), 0.0)) is None


def test_the_frame_is_read_once(spark, df, tmp_path):
    """However many points and folds there are: two passes over the kept frame, one over the input."""
    df.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for folds, points in ((2, (0.0,)), (9, (0.0, 0.1, 0.2, 0.4, 0.8))):
        spec = replace(SPEC, folds=folds, fold=f"id % {folds}", families=(Family("l", "linear", (("regParam", points),)),))
        spark.sparkContext.setJobGroup(f"tune-{folds}", "tune")
        training.tune(stored, spec)
        jobs.append(len(tracker.getJobIdsForGroup(f"tune-{folds}")))
    assert jobs[0] == jobs[1] <= 6


def test_rows_without_a_fold_are_an_error(df):
    with pytest.raises(ValueError, match="have no fold"):
        training.tune(df, replace(SPEC, fold="CASE WHEN id > 5 THEN id % 3 END"))


def test_tasks_follow_from_the_rows():
    assert [training.layout_tasks(n) for n in (0, 1, 100_000, 100_001, 10**9, 10**11)] == [1, 1, 1, 2, 2000, 10_000]
    assert training.layout_tasks(2 * 10**8) == 2000 and training.layout_tasks(3 * 10**10) == 3000


def test_forests_do_not_depend_on_the_input_layout(df):
    forest = Family("forest", "forest", (("numTrees", (4,)), ("maxDepth", (4,))))
    spec = replace(SPEC, families=(forest,))
    found = []
    for parts in (4, 8, 64):
        result = training.train(df.repartition(parts), spec)
        model = result.candidates[0].model.stages[-1]
        found.append((result.candidates[0].run_id, [t.toDebugString.split("\n", 1)[1] for t in model.trees]))
    assert found[0] == found[1] == found[2]
