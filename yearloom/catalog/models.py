"""Regression queries: on the master table, and on line items row by row."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.catalog import star
from yearloom.catalog.star import PANEL, table
from yearloom.operators import frames
from yearloom.plans import bagging, city, gram, tracking, training
from yearloom.session import scratch_path, store
from yearloom.specs import Family, ModelSpec

# The city's two models on the nations' master table.
NATION_KEYS = (PANEL.entity, PANEL.period)
INCIDENT_MODEL = replace(city.INCIDENT_MODEL, keys=NATION_KEYS)
INCOME_MODEL = replace(city.INCOME_MODEL, keys=NATION_KEYS)

# The incident model's families on row-level data.
PRICE_MODEL = ModelSpec(
    experiment="Item_Price_Prediction",
    model_name="ItemPricePredictor",
    label="price",
    features=("quantity", "discount", "tax", "retail_price"),
    required=("price",),
    keys=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"),
    families=city.INCIDENT_MODEL.families,
    folds=3,
    min_rows=50,
)


def price_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their part's retail price; the tax of open ones is unknown."""
    items = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return items.select(
        *PRICE_MODEL.keys,
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("tax"),
        F.col("p_retailprice").alias("retail_price"),
    )


def linear_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Slope and intercept of price over quantity, by order status and over all, from one pass."""
    items = table(spark, folder, "lineitem").select("l_linestatus", "l_extendedprice", "l_quantity")
    origin = {"l_extendedprice": 30_000.0, "l_quantity": 25.0}  # near their means, against rounding
    parts = gram.sums(items, ["l_quantity"], "l_extendedprice", "l_linestatus", origin)
    rows = []
    if parts:
        line = gram.fit(reduce(add, parts.values()))
        slope = float(line.coefficients[0])
        rows.append((slope, line.intercept + origin["l_extendedprice"] - slope * origin["l_quantity"]))
    return spark.createDataFrame(rows, "slope double, intercept double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept")
    )


def cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validated errors of every grid point of the row-level model."""
    rows = store(price_rows(spark, folder), "prices")
    scores = training.cv_table(spark, PRICE_MODEL, training.tune(rows, PRICE_MODEL))
    return scores.withColumns({c: F.to_json(c) for c in ("params", "fold_rmse")})


# One feature, arithmetic split and folds, no penalty: plain SQL gives the same errors.
LINE_MODEL = ModelSpec(
    experiment="Item_Line_Prediction",
    model_name="ItemLinePredictor",
    label="price",
    features=("quantity",),
    required=("price",),
    keys=("l_orderkey", "l_linenumber"),
    families=(Family("LinearRegression", "linear", (("regParam", (0.0,)),)),),
    folds=3,
    min_rows=50,
    split="l_orderkey % 5 > 0",
    fold="l_orderkey % 3",
)


def line_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items; the quantity of open ones is unknown."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("quantity"),
    )


def line_cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validated errors of a line, with means imputed inside each fold."""
    scores = training.cv_table(spark, LINE_MODEL, training.tune(line_rows(spark, folder), LINE_MODEL))
    return scores.select(
        "experiment",
        "model_type",
        F.round("avg_rmse", 4).alias("avg_rmse"),
        *[F.round(F.col("fold_rmse")[k], 4).alias(f"fold_{k}") for k in range(LINE_MODEL.folds)],
    )


# Two families with several points each: a penalised line, and one tree that is cut at
# different depths.  Over few values a deep tree predicts their means, so SQL gives the same errors.
TUNED_MODEL = replace(
    LINE_MODEL,
    experiment="Item_Tuned_Prediction",
    features=("tens",),
    families=(
        Family("LinearRegression", "linear", (("regParam", (0.0, 2000.0)), ("elasticNetParam", (0.0, 0.5)))),
        Family("RandomForestRegressor", "forest", (("numTrees", (1,)), ("bootstrap", (False,)), ("maxDepth", (0, 5)))),
    ),
)


def tuned_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validated errors of all points of two families, and the best point of each."""
    tens = F.ceil(F.col("quantity") / 10).cast("double")
    grid = training.tune(line_rows(spark, folder).withColumn("tens", tens), TUNED_MODEL)
    scores = training.cv_table(spark, TUNED_MODEL, grid)
    return scores.select(
        "experiment",
        "model_type",
        *[F.col("params")[p].alias(c) for p, c in (("regParam", "penalty"), ("elasticNetParam", "mixing"), ("maxDepth", "depth"))],
        F.round("avg_rmse", 4).alias("avg_rmse"),
        *[F.round(F.col("fold_rmse")[k], 4).alias(f"fold_{k}") for k in range(TUNED_MODEL.folds)],
        "best",
    )


def _features(spark: SparkSession, folder: str, spec: ModelSpec) -> DataFrame:
    """The complete rows of a model, with its features after imputation and its label."""
    rows = training.model_frame(store(star.master(spark, folder), "master"), spec)
    features = list(spec.features)
    filled = frames.mean_imputer(features).fit(rows).transform(rows)
    return filled.select(
        *[F.col(f"__key_{k}").alias(k) for k in spec.keys],
        F.round(spec.label, 4).alias("label"),
        *[F.round(c + frames.IMPUTED, 4).alias(f"x{i}") for i, c in enumerate(features)],
    )


def incident_features(spark: SparkSession, folder: str) -> DataFrame:
    """The incident model's feature set."""
    return _features(spark, folder, INCIDENT_MODEL)


def income_features(spark: SparkSession, folder: str) -> DataFrame:
    """The income model's feature set."""
    return _features(spark, folder, INCOME_MODEL)


def line_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of the line items held out, by the model in production, saved and loaded."""
    base = scratch_path(spark, "tracking")
    result = training.train(line_rows(spark, folder), LINE_MODEL)
    tracking.track(spark, base, result)
    model = tracking.production_model(spark, base, LINE_MODEL.model_name)
    scored = training.score(model, result.champion.validation.drop("prediction"))
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 4).alias("prediction"))


def tracked_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The run, its error and its version, after the same training was tracked twice."""
    base = scratch_path(spark, "tracking")
    for _ in range(2):
        tracking.track(spark, base, training.train(line_rows(spark, folder), LINE_MODEL))
    stages = tracking.registry(spark, base).select("run_id", "name", "version", "stage")
    return tracking.runs(spark, base).join(stages, "run_id", "left").select(
        "experiment", "run_name", "model_type", "cv_folds", "name", "version", "stage",
        F.round(F.col("metrics")["rmse"], 4).alias("rmse"),
        F.col("params")[f"{tracking.TUNED}regParam"].alias("reg_param"),
        "signature",
    )


def forest_group_means(spark: SparkSession, folder: str) -> DataFrame:
    """One deep tree on all rows and one feature of a few values predicts each value's mean."""
    items = table(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("line"), F.col("l_quantity").alias("quantity")
    )
    prepare = training.preparation(["line"]).fit(items)
    ready = prepare.transform(items).select("line", "features", "quantity")
    tree = {"numTrees": 1, "bootstrap": False, "maxDepth": 7}
    model = training.regressor(Family("forest", "forest", ()), "quantity", 42, tree).fit(ready)
    scored = model.transform(ready)
    return scored.groupBy("line").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.max("prediction"), 6).alias("prediction")
    )


BAGGED_TREES = 5
# A number from 0 to 1 for a line item and a tree, by arithmetic that SQL repeats.
BAGGED_UNIFORM = "((l_orderkey * 7919 + l_linenumber * 104729 + ({tree} + 1) * 15485863) * 48271 % 2147483647) / 2147483647.0D"


def bagged_means(spark: SparkSession, folder: str) -> DataFrame:
    """A forest of deep trees on one feature of a few values, whose samples belong to the rows."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").cast("double").alias("line"), F.col("l_quantity").alias("quantity")
    )
    items = items.withColumn(bagging.HASH, F.xxhash64("l_orderkey", "l_linenumber"))
    model = bagging.fit(items, ["line"], "quantity", {"numTrees": BAGGED_TREES, "maxDepth": 7}, uniforms=BAGGED_UNIFORM)
    trees = [f"__tree_{k}" for k in range(BAGGED_TREES)]
    scored = model.transform(items).groupBy("line")
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.max("prediction"), 6).alias("prediction"),
        F.round(F.max(F.greatest(*trees)) - F.min(F.least(*trees)), 6).alias("spread"),
    )


def _nation_training(spark: SparkSession, folder: str, spec: ModelSpec) -> training.Training:
    master = store(star.master(spark, folder), "master")
    return training.train(master, spec)


def validation_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The nation-years held out, scored by the incident champion after saving and loading it."""
    base = scratch_path(spark, "tracking")
    result = _nation_training(spark, folder, INCIDENT_MODEL)
    tracking.track(spark, base, result)
    model = tracking.production_model(spark, base, INCIDENT_MODEL.model_name)
    held_out = result.champion.validation.drop("prediction")
    return training.score(model, held_out)


def tracked_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of the income model and the stage each one reached."""
    base = scratch_path(spark, "tracking")
    tracking.track(spark, base, _nation_training(spark, folder, INCOME_MODEL))
    stages = tracking.registry(spark, base).select("run_id", "name", "version", "stage")
    runs = tracking.runs(spark, base).drop("logged_at", "model_path")
    shown = runs.withColumns({c: F.to_json(c) for c in ("params", "metrics")})
    return shown.join(stages, "run_id", "left")


QUERIES = {
    "line_cv_scores": line_cv_scores,
    "tuned_lines": tuned_lines,
    "incident_features": incident_features,
    "income_features": income_features,
    "line_predictions": line_predictions,
    "tracked_lines": tracked_lines,
    "forest_group_means": forest_group_means,
    "bagged_means": bagged_means,
    "linear_fit": linear_fit,
    "cv_scores": cv_scores,
    "validation_scores": validation_scores,
    "tracked_runs": tracked_runs,
}
