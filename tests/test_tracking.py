import json

import pytest
from pyspark.sql import functions as F

from yearloom.operators.registry import champions
from yearloom.operators import registry as ops
from yearloom.plans import tracking, training
from yearloom.specs import Family, ModelSpec

SPEC = ModelSpec(
    experiment="planted",
    model_name="Planted",
    label="y",
    features=("a",),
    required=("y",),
    keys=("id",),
    families=(
        Family("strong", "linear", (("regParam", (5.0,)),)),
        Family("weak", "linear", (("regParam", (0.0,)),)),
    ),
    folds=2,
    min_rows=1,
    partitions=2,
)


def train(spark, slope):
    a = F.pmod(F.xxhash64("id"), F.lit(100)).cast("double")
    df = spark.range(60).select("id", a.alias("a"), (a * slope + 1).alias("y"))
    return training.train(df, SPEC)


@pytest.fixture(scope="module")
def trainings(spark):
    return [train(spark, slope) for slope in (2.0, 3.0)]


def state(spark, base):
    rows = tracking.registry(spark, base).collect()
    return {(r["version"], r["run_id"], r["stage"]) for r in rows}


def test_track(spark, trainings, tmp_path):
    base = str(tmp_path)
    first, second = trainings
    best = tracking.track(spark, base, first)
    assert best == first.champion.run_id == first.candidates[1].run_id
    assert state(spark, base) == {(1, best, "Production")}

    # The same training once more changes nothing.
    assert tracking.track(spark, base, first) == best
    assert state(spark, base) == {(1, best, "Production")}
    assert tracking.runs(spark, base).count() == 2

    newer = tracking.track(spark, base, second)
    assert state(spark, base) == {(1, best, "Archived"), (2, newer, "Production")}

    run = tracking.runs(spark, base).where(F.col("run_id") == newer).first()
    assert run["experiment"] == "planted" and run["run_name"] == "Tune_and_Train_weak"
    assert run["params"]["best_regParam"] == "0.0" and run["params"]["best_labelCol"] == "y"
    assert run["metrics"]["rmse"] < 1e-6
    assert json.loads(run["signature"]) == {
        "inputs": {"a": "double"},
        "output": {"prediction": "double"},
    }

    model = tracking.production_model(spark, base, "Planted")
    scored = training.score(model, spark.createDataFrame([(10.0,)], "a double"))
    assert scored.first()["prediction"] == pytest.approx(31.0)
    with pytest.raises(LookupError):
        tracking.production_model(spark, base, "Other")


def test_nothing_to_register(spark, tmp_path):
    assert tracking.champion(spark, str(tmp_path), ["r"]).count() == 0
    assert tracking.registry(spark, str(tmp_path)).count() == 0


def test_champions(spark):
    nan, inf = float("nan"), float("inf")
    runs = [
        ("tie", "a", 1, 2.0),
        ("tie", "b", 2, 2.0),
        ("tie", "c", 0, nan),
        ("none", "d", 0, nan),
        ("none", "e", 1, None),
        ("none", "f", 2, inf),
        ("low", "g", 0, 3.0),
        ("low", "h", 1, 1.0),
    ]
    df = spark.createDataFrame(runs, "experiment string, run_id string, run_order int, rmse double")
    best = {r["experiment"]: r["run_id"] for r in ops.champions(df.repartition(3)).collect()}
    assert best == {"tie": "a", "low": "h"}


@pytest.mark.parametrize("fits", [True, False])
def test_promote(spark, fits):
    rows = [
        ("m", 1, "r1", "Archived"),
        ("m", 2, "r2", "Production"),
        ("m", 3, "r3", "None"),
        ("m", 4, "r4", "Staging"),
        ("n", 1, "r5", "Production"),
    ]
    schema = "name string, version bigint, run_id string, stage string"
    registry = spark.createDataFrame(rows, schema)
    targets = spark.createDataFrame([("m", 3)], "name string, version bigint")
    after = {(r["name"], r["version"]): r["stage"] for r in
             ops.promote(registry, targets, fits).collect()}
    assert after == {
        ("m", 1): "Archived",
        ("m", 2): "Archived",
        ("m", 3): "Production",
        ("m", 4): "Staging",
        ("n", 1): "Production",
    }


def test_champions_are_found_by_hash_aggregates(spark, plan):
    rows = [
        ("a", 1, "r1", 2.0), ("a", 2, "r2", 2.0), ("a", 3, "r3", float("nan")), ("a", 4, "r4", None),
        ("b", 1, "r5", float("inf")), (None, 2, "r6", 5.0), (None, 1, "r7", 5.0), ("c", 1, "r8", 0.0),
    ]
    runs = spark.createDataFrame(rows, "experiment string, run_order int, run_id string, rmse double")
    best = champions(runs)
    assert {(r["experiment"], r["run_id"]) for r in best.collect()} == {("a", "r1"), (None, "r7"), ("c", "r8")}
    assert best.columns == runs.columns
    assert "HashAggregate" in plan(best)


def test_two_writers_at_once(spark, trainings, tmp_path):
    """Both have read the tables before either of them wrote."""
    base = str(tmp_path)
    first, second = (t.champion.run_id for t in trainings)
    ids = [tracking.log_training(spark, base, t) for t in trainings]
    seen = tracking.version_events(spark, base).count()
    assert seen == 0
    for run in (first, second, first):  # what each would append; the first one twice
        tracking._append(spark, base, "Planted", run, [ops.REGISTERED, ops.PROMOTED])
    assert {(v, r) for v, r, _ in state(spark, base)} == {(1, first), (2, second)}
    # The same runs are logged by another writer that did not see them.
    rows = tracking.runs(spark, base).collect()
    again = spark.createDataFrame(rows, tracking.RUNS).withColumn("logged_at", F.current_timestamp())
    again.write.mode("append").parquet(f"{base}/runs")
    assert tracking.runs(spark, base).count() == len(rows) == sum(map(len, ids))
    tracking.promote(spark, base, "Planted", second)
    tracking.promote(spark, base, "Planted", first)
    assert state(spark, base) == {(1, first, "Production"), (2, second, "Archived")}
    tracking.production_model(spark, base, "Planted")


def test_events_in_any_order(spark):
    """Versions and stages do not depend on how events are ordered or repeated."""
    events = [
        ("m", "b", "registered", 2), ("m", "a", "registered", 2), ("m", "c", "registered", 1), ("m", "b", "promoted", 5),
        ("m", "a", "promoted", 4), ("m", "lost", "promoted", 3), ("n", "a", "registered", 9), ("m", "b", "registered", 7),
    ]
    expected = {("m", 1, "c", "None"), ("m", 2, "a", "Archived"), ("m", 3, "b", "Production"), ("n", 1, "a", "None")}
    for rows in (events, events[::-1] * 2):
        df = spark.createDataFrame(rows, "name string, run_id string, event string, at int")
        found = ops.state_of_events(df.withColumn("at", F.timestamp_seconds("at"))).collect()
        assert {tuple(r) for r in found} == expected and len(found) == 4
