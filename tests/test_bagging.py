"""Forests whose samples belong to the rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_training import SPEC, planted  # noqa: F401
from yearloom.plans import bagging, tracking, training
from yearloom.specs import Family

FOREST = Family("rows", "row_forest", (("numTrees", (4,)), ("maxDepth", (2, 4))))
ROWS = replace(SPEC, families=(FOREST,), partitions=None)


def trees(model):
    return [t.toDebugString.split("\n", 1)[1] for m in model.stages if hasattr(m, "trees") for t in m.trees]


def test_weights_are_poisson(spark):
    rows = spark.range(200_000).select(bagging.weight(bagging.uniform("id", 3, 42)).alias("w"))
    counts = {r["w"]: r["count"] / 200_000 for r in rows.groupBy("w").count().collect()}
    assert counts[0.0] == pytest.approx(0.3679, abs=0.005) and counts[1.0] == pytest.approx(0.3679, abs=0.005)
    assert counts[2.0] == pytest.approx(0.1839, abs=0.004) and sum(k * v for k, v in counts.items()) == pytest.approx(1, abs=0.01)
    other = spark.range(1000).select(F.corr(bagging.uniform("id", 1, 42), bagging.uniform("id", 2, 42))).first()[0]
    assert abs(other) < 0.1


def test_the_same_trees_in_every_layout(spark, planted):  # noqa: F811
    more = planted.unionByName(planted.withColumn("id", F.col("id") + 1000)).withColumn("a", F.col("a") + F.col("id") % 7)
    found = []
    for parts in (4, 8, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts // 2))
        result = training.train(more.repartition(parts), ROWS)
        found.append(result)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    first = found[0].candidates[0]
    assert len(trees(first.model)) == 4 and len(set(trees(first.model))) == 4
    for result in found[1:]:
        own = result.candidates[0]
        assert own.run_id == first.run_id and own.params == first.params
        assert own.rmse == pytest.approx(first.rmse, rel=1e-9)
        assert [p.fold_rmse for p in result.grid] == [pytest.approx(p.fold_rmse, rel=1e-9) for p in found[0].grid]
        # Cuts that part the rows alike may differ by rounding; what the trees say does not.
        both = own.model.transform(more).select("id", *[F.col(f"__tree_{k}").alias(f"t{k}") for k in range(4)])
        same = first.model.transform(more).join(both, "id")
        apart = [F.max(F.abs(F.col(f"__tree_{k}") - F.col(f"t{k}"))) for k in range(4)]
        assert max(same.agg(*apart).first()) < 1e-9


def test_many_rows_have_the_same_cuts_in_every_layout(spark):
    """More rows than the sample, and more values than cuts."""
    rows = spark.range(30_000).select(F.xxhash64("id").alias(bagging.HASH), F.sin("id").alias("x"), F.lit(1.0).alias("flat"))
    first, second = (bagging.cuts(rows.repartition(n), ["x", "flat"]) for n in (3, 17))
    assert first == second and len(first["x"]) == bagging.CUTS + 1 and len(first["flat"]) == 2
    share = rows.where(F.col("x") < first["x"][16]).count() / 30_000
    assert share == pytest.approx(0.5, abs=0.02)


def test_saved_scored_and_compared(spark, planted, tmp_path):  # noqa: F811
    """Beside the other families, from the grid to the model in production."""
    spec = replace(SPEC, families=(*SPEC.families, FOREST))
    result = training.train(planted, spec)
    assert [c.family for c in result.candidates] == ["linear", "forest", "rows"]
    forest, rows = result.candidates[1:]
    assert rows.rmse < 3 * forest.rmse and rows.params == {"numTrees": 4, "maxDepth": 4}
    assert rows.validation.columns == [*planted.columns, "prediction"]
    only = training.train(planted, ROWS)
    tracking.track(spark, str(tmp_path), only)
    model = tracking.production_model(spark, str(tmp_path), "Planted")
    again = training.score(model, planted).agg(F.sum("prediction")).first()[0]
    assert again == pytest.approx(training.score(only.candidates[0].model, planted).agg(F.sum("prediction")).first()[0])


def test_features_of_one_value_and_missing_ones(spark):
    rows = [(k, None if k % 5 == 0 else float(k % 3), 1.0, float(k % 3)) for k in range(90)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    result = training.train(df, ROWS)
    assert result.candidates[0].rmse < 1.0
    flat = training.train(df.withColumn("a", F.lit(2.0)), ROWS)
    assert flat.candidates[0].rmse == pytest.approx(0.82, abs=0.1)
