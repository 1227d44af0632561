from dataclasses import replace

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from yearloom.operators import frames
from yearloom.plans import city, training
from yearloom.specs import Family, ModelSpec

LINEAR = Family("linear", "linear", (("regParam", (0.0, 0.5)),))
FOREST = Family("forest", "forest", (("numTrees", (5,)), ("maxDepth", (3, 5))))

SPEC = ModelSpec(
    experiment="planted",
    model_name="Planted",
    label="y",
    features=("a", "b"),
    required=("y",),
    keys=("id",),
    families=(LINEAR, FOREST),
    folds=3,
    min_rows=50,
    partitions=4,
)


def noise(salt):
    return (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(2001)) - 1000) / 1000.0


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(400).select("id", (noise(1) * 10).alias("a"), (noise(2) * 10).alias("b"))
    return df.withColumn("y", 3 * F.col("a") - 2 * F.col("b") + 5 + noise(3) * 0.01)


@pytest.fixture(scope="module")
def trained(planted):
    return training.train(planted, SPEC)


def test_planted_coefficients(trained):
    linear = trained.candidates[0]
    assert linear.params == {"regParam": 0.0}
    fitted = linear.model.stages[-1]
    assert list(fitted.coefficients) == pytest.approx([3, -2], abs=0.01)
    assert fitted.intercept == pytest.approx(5, abs=0.01)
    assert linear.rmse < 0.02
    assert trained.champion is linear


def test_split_and_folds(trained, planted):
    rows = trained.rows
    assert sum(rows.values()) == 400 and 0.7 < rows["train"] / 400 < 0.9
    assert trained.candidates[0].validation.count() == rows["validation"]
    assert [len(p.fold_rmse) for p in trained.grid] == [3] * 4


def test_validation_keeps_the_columns(trained, planted):
    assert trained.candidates[0].validation.columns == [*planted.columns, "prediction"]


def test_errors_agree_with_the_evaluator(trained):
    evaluator = RegressionEvaluator(labelCol="y", metricName="rmse")
    for c in trained.candidates:
        assert evaluator.evaluate(c.validation) == pytest.approx(c.rmse, rel=1e-9)


def test_grid_agrees_with_cross_validation_by_the_library(planted, trained):
    """The same folds, with the preparation inside the estimator of each grid point."""
    marked = training.model_frame(planted, SPEC).where("__split = 'train'")
    pipeline = training.preparation(["a", "b"])
    regressor = training.regressor(LINEAR, "y", 42)
    pipeline.setStages([*pipeline.getStages(), regressor])
    points = ParamGridBuilder().addGrid(regressor.regParam, [0.0, 0.5]).build()
    cv = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=points,
        evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"),
        numFolds=3,
        foldCol="__fold",
    )
    expected = cv.fit(marked).avgMetrics
    ours = [p.avg_rmse for p in trained.grid if p.family == "linear"]
    assert ours == pytest.approx(expected, rel=1e-6)


def test_same_rows_in_another_layout_give_the_same_models(planted, trained):
    again = training.train(planted.repartition(7).orderBy(F.desc("b")), SPEC)
    for a, b in zip(trained.candidates, again.candidates):
        assert (a.run_id, a.params) == (b.run_id, b.params)
        assert a.rmse == pytest.approx(b.rmse, rel=1e-12)
    for a, b in zip(trained.grid, again.grid):
        assert a.fold_rmse == pytest.approx(b.fold_rmse, rel=1e-9)


def test_other_rows_or_settings_are_another_run(planted, trained):
    other = training.train(planted.withColumn("y", F.col("y") + 1), SPEC)
    assert other.candidates[0].run_id != trained.candidates[0].run_id


def test_settings_of_the_session_change_nothing(spark, planted, trained):
    """Trees are sampled from a layout that the spec declares."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for setting in ("2", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", setting)
            again = training.train(planted, SPEC)
            assert [c.run_id for c in again.candidates] == [c.run_id for c in trained.candidates]
            for a, b in zip(trained.candidates, again.candidates):
                assert a.rmse == pytest.approx(b.rmse, rel=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_another_declared_layout_is_another_run(planted, trained):
    other = training.train(planted, replace(SPEC, partitions=3, families=(LINEAR,)))
    assert other.candidates[0].run_id != trained.candidates[0].run_id


def test_given_split_and_folds(planted):
    spec = replace(SPEC, families=(LINEAR,), split="id % 5 > 0", fold="id % 3")
    result = training.train(planted, spec)
    assert result.rows == {"train": 320, "validation": 80} and result.folds == [0, 1, 2]


def test_keys_that_do_not_identify_rows(planted):
    """One key holds most rows; they are spread by their other columns."""
    skewed = planted.withColumn("id", F.when(F.col("id") % 3 < 2, -1).otherwise(F.col("id")))
    laid = training._laid_out(training.model_frame(skewed, SPEC), SPEC)
    tasks = laid.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == SPEC.partitions and max(r["count"] for r in tasks) < 200
    result = training.train(skewed, SPEC)
    assert sum(result.rows.values()) == 400
    assert result.candidates[0].rmse is None or result.candidates[0].rmse < 0.05


@pytest.fixture(scope="module")
def sparse(planted):
    """Feature b is known in a single row; feature c in none."""
    return planted.withColumn("b", F.when(F.col("id") == 3, F.col("b"))).withColumn(
        "c", F.lit(None).cast("double")
    )


def test_all_null_features(sparse):
    spec = replace(SPEC, features=("a", "b", "c"), families=(LINEAR,))
    with pytest.raises(ValueError, match="without any value in a training part: b, c"):
        training.train(sparse, spec)
    dropped = training.train(sparse, replace(spec, all_null="drop"))
    assert dropped.candidates[0].features == ["a"]
    zero = training.train(sparse, replace(spec, all_null="zero"))
    assert zero.candidates[0].features == ["a", "b", "c"]
    assert zero.candidates[0].rmse is not None


def test_integer_features_keep_their_fractions(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 2)], "id int, n bigint")
    rows = frames.mean_imputed(df, ["n"]).orderBy("id").collect()
    assert rows[2]["n_imputed"] == pytest.approx(5 / 3)


def test_nan_counts_as_missing(spark):
    rows = [(1, 1.0), (2, float("nan")), (3, None), (4, 3.0)]
    df = spark.createDataFrame(rows, "id int, x double")
    assert frames.complete_rows(df, ["x"]).count() == 2
    filled = frames.mean_imputed(df, ["x"]).orderBy("id").collect()
    assert [r["x_imputed"] for r in filled] == [1.0, 2.0, 2.0, 3.0]


def test_too_few_rows(spark, caplog):
    few = spark.createDataFrame([(i, float(i), 1.0, float(i)) for i in range(3)],
                                "id int, a double, b double, y double")
    result = training.train(few, replace(SPEC, families=(LINEAR,)))
    assert "only 3 rows, below 50" in caplog.text
    assert len(result.folds) == 3 or "folds have rows" in caplog.text
    assert sum(result.rows.values()) == 3
    with pytest.raises(ValueError, match="no rows to train"):
        training.train(few.where("false"), SPEC)


def test_key_split_is_stable_disjoint_and_whole(spark):
    df = spark.range(10_000)
    first = {tuple(r) for r in frames.key_split(df, ["id"]).collect()}
    second = {tuple(r) for r in frames.key_split(df.repartition(13), ["id"]).collect()}
    assert first == second and len(first) == 10_000
    train = sum(1 for _, part in first if part == "train")
    assert 7_800 < train < 8_200
    other = {tuple(r) for r in frames.key_split(df, ["id"], seed=43).collect()}
    assert other != first


def test_random_split_is_disjoint_and_whole(spark):
    df = spark.range(1000)
    train, validation = frames.random_split(df)
    parts = [{r["id"] for r in p.collect()} for p in (train, validation)]
    assert not parts[0] & parts[1] and len(parts[0] | parts[1]) == 1000


def test_training_runs_without_python_in_the_plan(planted, plan):
    text = plan(training.model_frame(planted, SPEC))
    assert "Python" not in text and "Exchange" not in text


def test_city_models():
    assert len(training.grid_points(city.ELASTIC)) == 4
    assert training.grid_points(city.LINEAR) == [{"regParam": 0.1}, {"regParam": 0.01}]
    assert len(training.grid_points(city.FOREST)) == 4
    assert (city.INCIDENT_MODEL.folds, city.INCOME_MODEL.folds) == (3, 2)
    with pytest.raises(ValueError):
        replace(SPEC, required=("a",))
    with pytest.raises(ValueError):
        replace(SPEC, all_null="ignore")
    with pytest.raises(ValueError):
        training.regressor(Family("x", "spline", ()), "y", 1)
