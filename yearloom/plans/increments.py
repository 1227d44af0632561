"""A master table that is kept up to date by landed files.

The sums and counts of every fact are stored per landed file, entity and period, in buckets of
entities.  A file that is landed again or withdrawn takes its old states along: they belong to
a run that the ledger no longer names for it.  So nothing is subtracted, and sums stay exact.  Only the buckets
with entities that changed files mention, before or now, are merged again.

All tables only grow: states and rows of the master table lie in folders of their runs, and
a last table tells which run made a bucket last.  It is written at the end, so a run that breaks off is done again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.operators.panel import fact_state, master_of_states, merged_state
from yearloom.session import store
from yearloom.sources import ledger
from yearloom.specs import FactSpec, PanelSpec

BUCKETS = 256  # of entities
FILE = "file_name"
_MADE = "bucket int, run int"
_NONE = -1  # stands for a run that changed no bucket

# Of a run's folder, the rows of a fact with entity, period, its columns, and the name of their file.
Reader = Callable[[str, str], DataFrame]


def _bucket(panel: PanelSpec, buckets: int) -> Column:
    return F.pmod(F.xxhash64(panel.entity), F.lit(buckets)).cast("int").alias("bucket")


def _store_states(
    spark: SparkSession, base: str, panel: PanelSpec, fact: FactSpec, run: int, read: Reader, buckets: int
) -> None:
    rows = read(ledger.run_folder(base, run), fact.name)
    state = fact_state(rows, fact, [panel.entity, panel.period, FILE])
    state = state.select("*", _bucket(panel, buckets)).repartition("bucket")
    state.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/states/{fact.name}/run={run}")


def _landed_runs(spark: SparkSession, base: str, fact: FactSpec) -> DataFrame:
    return ledger.events(spark, base).where(F.col("dataset") == fact.name)


def _states(spark: SparkSession, base: str, panel: PanelSpec, fact: FactSpec) -> DataFrame | None:
    """All stored states of a fact, of old and present files; None before the first."""
    runs = _landed_runs(spark, base, fact).where(F.col("event") == ledger.LANDED)
    if runs.isEmpty():
        return None
    return spark.read.option("basePath", f"{base}/states/{fact.name}").parquet(f"{base}/states/{fact.name}")


def update(
    spark: SparkSession, base: str, panel: PanelSpec, read: Reader, buckets: int = BUCKETS
) -> list[int]:
    """Bring the master table up to the ledger; gives the buckets that were made again.

    ``base`` is the folder of the ledger, ``read`` gives the rows of a run's files.  The number of
    buckets must not change.  The datasets of the ledger are named like the facts.
    """
    done = made(spark, base).agg(F.max("run")).first()[0] or 0
    last = ledger.last_run(spark, base)
    if last <= done:
        return []
    pending = ledger.events(spark, base).where(F.col("run") > done)
    for row in pending.where(F.col("event") == ledger.LANDED).select("dataset", "run").distinct().orderBy("run", "dataset").collect():
        _store_states(spark, base, panel, panel.fact(row["dataset"]), row["run"], read, buckets)
    changed = set()
    states = {f.name: _states(spark, base, panel, f) for f in panel.facts}
    for name, state in states.items():
        if state is not None:
            files = pending.where(F.col("dataset") == name).select(FILE).distinct()
            # No more than there are buckets.
            changed |= {r["bucket"] for r in state.join(files, FILE, "left_semi").select("bucket").distinct().collect()}
    if changed:
        now = ledger.current(ledger.events(spark, base))
        present = {}
        for fact in panel.facts:
            state = states[fact.name]
            if state is None:
                keys = f"{panel.entity} string, {panel.period} int"
                present[fact.name] = fact_state(
                    spark.createDataFrame([], ", ".join([keys, *[f"`{m.column}` double" for m in fact.measures if m.column]])),
                    fact, [panel.entity, panel.period],
                )
                continue
            files = now.where(F.col("dataset") == fact.name).select(FILE, "run")
            own = state.where(F.col("bucket").isin(sorted(changed))).join(files, [FILE, "run"], "left_semi")
            present[fact.name] = merged_state(own, fact, panel)
        master = master_of_states(present, panel).select("*", _bucket(panel, buckets))
        master.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/master/run={last}")
    rows = [(b, last) for b in sorted(changed)] or [(_NONE, last)]
    spark.createDataFrame(rows, _MADE).coalesce(1).write.mode("append").parquet(f"{base}/made")
    return sorted(changed)


def made(spark: SparkSession, base: str) -> DataFrame:
    """Which run made which bucket."""
    return ledger.appended(spark, f"{base}/made", _MADE)


def master(spark: SparkSession, base: str, panel: PanelSpec, schema: str) -> DataFrame:
    """The master table as it is now; ``schema`` gives its columns, see ``zones.master_schema``."""
    # One row per bucket.
    latest = made(spark, base).where(F.col("bucket") != _NONE).groupBy("bucket").agg(F.max("run").alias("run"))
    rows = ledger.appended(spark, f"{base}/master", f"{schema}, {_MADE}")
    return rows.join(F.broadcast(store(latest, "made")), ["bucket", "run"], "left_semi").drop("bucket", "run")
