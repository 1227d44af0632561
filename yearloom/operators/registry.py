"""Champions, versions and stages, as aggregates and joins over run and model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearloom.operators.joins import size_checked_join
from yearloom.session import store

# The stages of a model version.
PRODUCTION, ARCHIVED, NO_STAGE = "Production", "Archived", "None"
REGISTERED, PROMOTED = "registered", "promoted"


def champions(
    runs: DataFrame, group: str = "experiment", score: str = "rmse", order: str = "run_order"
) -> DataFrame:
    """The run with the lowest score per group; of equal ones the first.

    Runs without a score, or with NaN or infinity, never win.
    """
    value = F.col(score)
    valid = runs.where(value.isNotNull() & ~F.isnan(value) & (value < F.lit(float("inf"))))
    # The lowest score is a hash aggregate; only the few runs that have it are compared whole.
    lowest = valid.groupBy(F.col(group).alias("__group")).agg(F.min(value).alias("__lowest"))
    same = F.col(group).eqNullSafe(F.col("__group")) & (value == F.col("__lowest"))
    tied = valid.join(lowest, same, "left_semi")
    best = F.min_by(F.struct("*"), F.col(order)).alias("best")
    return tied.groupBy(group).agg(best).select("best.*")


def state_of_events(events: DataFrame) -> DataFrame:
    """Versions and stages from events (``name``, ``run_id``, ``event``, ``at``) in any order.

    A run's first registration counts.  Versions are numbered by that time, then by run id, so
    writers that know nothing of each other give no number twice.  The run that was promoted last (of several at
    one time the one with the largest id) is in production, others that ever were are archived.  An
    event that is noted again at the same time changes nothing.  Promotions of runs that are not registered do not count.
    """
    registered, promoted = F.col("event") == REGISTERED, F.col("event") == PROMOTED
    runs = events.groupBy("name", "run_id").agg(
        F.min(F.when(registered, F.col("at"))).alias("__first"), F.max(F.when(promoted, F.col("at"))).alias("__last")
    )
    known = runs.where(F.col("__first").isNotNull())
    numbered = Window.partitionBy("name").orderBy("__first", "run_id")
    newest = F.max(F.when(F.col("__last").isNotNull(), F.struct("__last", "run_id"))).over(Window.partitionBy("name"))
    stage = (
        F.when(F.col("__last").isNull(), F.lit(NO_STAGE))
        .when(newest["run_id"] == F.col("run_id"), F.lit(PRODUCTION))
        .otherwise(F.lit(ARCHIVED))
    )
    version = F.row_number().over(numbered).cast("long")
    return known.select("name", version.alias("version"), "run_id", stage.alias("stage"))


def next_versions(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Give each candidate (``name``, ``run_id``) the version after its model's latest."""
    latest = registry.groupBy("name").agg(F.max("version").alias("latest"))
    version = F.coalesce(F.col("latest"), F.lit(0).cast("bigint")) + 1
    return candidates.join(latest, "name", "left").select(
        "name", version.alias("version"), "run_id", F.lit(NO_STAGE).alias("stage")
    )


def promote(registry: DataFrame, targets: DataFrame, fits: bool | None = None) -> DataFrame:
    """The registry with each target (``name``, ``version``) in production.

    Other versions of the same models that were in production become archived;
    everything else keeps its stage.
    """
    wanted = targets.select("name", F.col("version").alias("__target"))
    joined = size_checked_join(registry, wanted, ["name"], "left", fits=fits)
    is_target = F.col("version") == F.col("__target")
    replaced = F.col("__target").isNotNull() & (F.col("stage") == PRODUCTION)
    stage = (
        F.when(is_target, F.lit(PRODUCTION))
        .when(replaced, F.lit(ARCHIVED))
        .otherwise(F.col("stage"))
    )
    return joined.withColumn("stage", stage).drop("__target")


def register_and_promote(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Add each candidate as the next version of its model and put it in production."""
    added = store(next_versions(registry, candidates), "new-versions")
    columns = ["name", "version", "run_id", "stage"]
    return promote(registry.select(*columns).unionByName(added.select(*columns)), added)
