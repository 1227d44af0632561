from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from yearloom.plans import shallow, training
from yearloom.specs import Family, ModelSpec


def test_a_cut_forest_is_the_forest_of_that_depth(spark):
    rows = spark.range(400).select(
        *[((F.col("id") * k) % 31).cast("double").alias(f"x{k}_imputed") for k in (3, 7, 11)],
        ((F.col("id") * 17) % 101).cast("double").alias("y"),
    )
    ready = training.VectorAssembler(inputCols=rows.columns[:3], outputCol="features").transform(rows).coalesce(1)
    grown = {d: RandomForestRegressor(labelCol="y", numTrees=4, seed=5, maxDepth=d).fit(ready) for d in (0, 2, 6)}
    for depth in (0, 2):
        cut = shallow.prediction(grown[6], depth, rows.columns[:3]).alias("cut")
        found = grown[depth].transform(ready).select("prediction", cut).collect()
        assert all(abs(a - b) < 1e-9 for a, b in found), depth


def test_points_that_differ_in_depth_only_are_fitted_once(spark, monkeypatch):
    fits = []
    fit_all = training._fit_all
    monkeypatch.setattr(training, "_fit_all", lambda es, *a: fits.extend(es) or fit_all(es, *a))
    spec = ModelSpec(
        experiment="e", model_name="m", label="y", features=("x",), required=("y",), keys=("id",), folds=2, min_rows=1,
        families=(Family("forest", "forest", (("numTrees", (1, 2)), ("maxDepth", (1, 3, 2)))),),
    )
    rows = spark.range(120).select("id", (F.col("id") % 9).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    grid = training.tune(rows, spec)
    assert [e.getMaxDepth() for e in fits] == [3, 3] * 2  # two folds of two forests
    assert len(grid) == 6 and all(None not in p.fold_rmse for p in grid)


def test_large_fits_run_one_after_the_other():
    spec = training.ModelSpec(
        experiment="e", model_name="m", label="y", features=("x",), required=("y",), keys=("id",), families=(), folds=2, min_rows=1
    )
    assert [training._at_once(spec, n) for n in (0, 1000, 1_000_000, 10**9)] == [4, 4, 2, 1]
