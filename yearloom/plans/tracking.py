"""Runs and model versions as tables of events.

Both tables only grow.  What they say is worked out when they are read: a run that was logged twice
is one run, and version numbers and stages follow from the times and run ids of the events.  So
several writers at once neither overwrite anything nor give a number twice.
"""

from __future__ import annotations

import json
import logging
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.operators.registry import PRODUCTION, PROMOTED, REGISTERED, champions, state_of_events
from yearloom.plans.training import Candidate, Training

log = logging.getLogger(__name__)

RUNS = (
    "experiment string, run_id string, run_name string, run_order int, model_type string, "
    "params map<string,string>, metrics map<string,double>, model_path string, "
    "signature string, cv_folds int, logged_at timestamp"
)
EVENTS = "name string, run_id string, event string, at timestamp"
# The beginnings of run names and of the names of tuned parameters.
RUN_NAME, TUNED = "Tune_and_Train_", "best_"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def runs(spark: SparkSession, base: str) -> DataFrame:
    """The logged runs; of one that was logged several times the first row."""
    logged = _read(spark, f"{base}/runs", RUNS)
    first = F.min_by(F.struct(*logged.columns), F.struct("logged_at", "model_path")).alias("first")
    return logged.groupBy("run_id").agg(first).select("first.*")


def version_events(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, f"{base}/versions", EVENTS)


def registry(spark: SparkSession, base: str) -> DataFrame:
    """The number and the current stage of every version of every model."""
    return state_of_events(version_events(spark, base))


def signature(candidate: Candidate) -> str:
    """Input columns and output of a model, from the schema alone."""
    fields = candidate.validation.schema
    inputs = {c: fields[c].dataType.simpleString() for c in candidate.features}
    output = fields["prediction"].dataType.simpleString()
    return json.dumps({"inputs": inputs, "output": {"prediction": output}})


def log_training(spark: SparkSession, base: str, training: Training) -> list[str]:
    """Save each family's best model and add its run; runs already there stay as they are."""
    ids = [c.run_id for c in training.candidates]
    found = runs(spark, base).where(F.col("run_id").isin(ids)).select("run_id").distinct()
    known = {row["run_id"] for row in found.collect()}  # at most one per family
    rows = []
    for c in training.candidates:
        if c.run_id in known:
            log.info("run %s is already logged", c.run_id)
            continue
        # Of its own, so that a writer with the same run does not write over it.
        path = f"{base}/models/{c.run_id}-{uuid.uuid4().hex[:8]}"
        c.model.save(path)
        row = (
            training.spec.experiment,
            c.run_id,
            f"{RUN_NAME}{c.family}",
            c.order,
            c.family,
            {f"{TUNED}{k}": v for k, v in c.settings.items()},
            {} if c.rmse is None else {"rmse": float(c.rmse)},
            path,
            signature(c),
            len(training.folds),
            datetime.now(timezone.utc),
        )
        rows.append(row)
    if rows:
        spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").parquet(f"{base}/runs")
    return ids


def champion(spark: SparkSession, base: str, run_ids: list[str]) -> DataFrame:
    """The best of the given runs: none or one row per experiment."""
    scored = runs(spark, base).where(F.col("run_id").isin(run_ids))
    return champions(scored.withColumn("rmse", F.col("metrics")["rmse"]))


def _append(spark: SparkSession, base: str, name: str, run_id: str, events: list[str]) -> None:
    now = datetime.now(timezone.utc)
    rows = spark.createDataFrame([(name, run_id, event, now) for event in events], EVENTS)
    rows.coalesce(1).write.mode("append").parquet(f"{base}/versions")


def register(spark: SparkSession, base: str, name: str, run_id: str) -> None:
    """Make the run the next version of the model, in production; once per run."""
    known = (F.col("name") == name) & (F.col("run_id") == run_id)
    if not version_events(spark, base).where(known).isEmpty():
        log.info("run %s is already a version of %s", run_id, name)
        return
    _append(spark, base, name, run_id, [REGISTERED, PROMOTED])


def promote(spark: SparkSession, base: str, name: str, run_id: str) -> None:
    """Put a registered run's version in production; the one that was there becomes archived."""
    _append(spark, base, name, run_id, [PROMOTED])


def track(spark: SparkSession, base: str, training: Training) -> str | None:
    """Log the runs, choose the champion, register it; returns its run id."""
    ids = log_training(spark, base, training)
    best = champion(spark, base, ids).select("run_id").first()
    if best is None:
        log.warning("no run of %s has an error that is a number", training.spec.experiment)
        return None
    register(spark, base, training.spec.model_name, best["run_id"])
    return best["run_id"]


def production_model(spark: SparkSession, base: str, name: str) -> PipelineModel:
    """The model in production under this name."""
    wanted = (F.col("name") == name) & (F.col("stage") == PRODUCTION)
    paths = registry(spark, base).where(wanted).join(runs(spark, base), "run_id")
    row = paths.select("model_path").first()
    if row is None:
        raise LookupError(f"no version of {name} is in production")
    return PipelineModel.load(row["model_path"])
