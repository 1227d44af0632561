"""Landing of what is new: a ledger of files, to which events are only appended.

A run lists the files, compares the list with the ledger, copies the files that are new or
changed, and then appends what happened.  A file counts as changed if its length or time of
modification is another.  Files that are no longer listed are withdrawn.  A run that breaks off has
appended nothing, so the next one takes its number and its work.  One run at a time is assumed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.session import store
from yearloom.sources import landing

EVENTS = (
    "dataset string, file_name string, path string, length bigint, modification_time timestamp, "
    "event string, run int"
)
LANDED, WITHDRAWN = "landed", "withdrawn"
_FILE = ["dataset", "file_name"]


def appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that is only appended to; without rows before the first ones."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def events(spark: SparkSession, base: str) -> DataFrame:
    return appended(spark, f"{base}/ledger", EVENTS)


def current(ledger: DataFrame) -> DataFrame:
    """The landed files as they are now, each with the run that copied it last."""
    last = F.max_by(F.struct("path", "length", "modification_time", "event", "run"), "run").alias("last")
    latest = ledger.groupBy(*_FILE).agg(last).select(*_FILE, "last.*")
    return latest.where(F.col("event") == LANDED)


def changes(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """New, changed and withdrawn files: the columns of ``manifest`` and the ``event``."""
    columns = ["path", "length", "modification_time"]
    known = files.select(*_FILE, *[F.col(c).alias(f"known_{c}") for c in columns])
    both = manifest.join(known, _FILE, "full")
    gone = F.col("path").isNull()
    same = (F.col("length") == F.col("known_length")) & F.col("modification_time").eqNullSafe(F.col("known_modification_time"))
    changed = both.where(gone | ~F.coalesce(same, F.lit(False)))
    return changed.select(
        *_FILE,
        *[F.coalesce(c, f"known_{c}").alias(c) for c in columns],
        F.when(gone, WITHDRAWN).otherwise(LANDED).alias("event"),
    )


def run_folder(base: str, run: int) -> str:
    """Where a run puts the files it copies, a folder for each dataset."""
    return f"{base}/files/run={run}"


def last_run(spark: SparkSession, base: str) -> int:
    return events(spark, base).agg(F.max("run")).first()[0] or 0


def land_changes(spark: SparkSession, globs: dict[str, str], base: str) -> int | None:
    """Copy the files that are new or changed, and note them and the withdrawn ones.

    Gives the number of the run, or None if nothing changed; then no file is opened.  Files of one
    dataset need different names.
    """
    manifest = landing.raw_manifest(spark, globs).select("dataset", "path", "file_name", "modification_time", "length")
    mine = F.col("dataset").isin(list(globs))
    known = current(events(spark, base)).where(mine)
    found = store(changes(manifest, known), "changed-files")
    counts = {r["event"]: r["count"] for r in found.groupBy("event").count().collect()}
    if not counts:
        return None
    run = last_run(spark, base) + 1
    if counts.get(LANDED):
        wanted = found.where(F.col("event") == LANDED)
        wanted = wanted.select("dataset", "path", "file_name", "modification_time", "length")
        copied = landing.restore_files(landing.raw_ranges(wanted), run_folder(base, run))
        copied = copied.select("dataset", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("copied"))
        wrong = wanted.join(copied, _FILE, "left").where(~F.col("length").eqNullSafe(F.col("copied"))).count()
        if wrong:
            raise RuntimeError(f"{wrong} files changed while they were copied")
    names = [part.split()[0] for part in EVENTS.split(", ")]
    noted = found.withColumn("run", F.lit(run)).select(*names)
    noted.coalesce(1).write.mode("append").parquet(f"{base}/ledger")
    return run
