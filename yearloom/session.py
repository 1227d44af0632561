"""The session of the command line, and the shared folder for stored results."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str) -> SparkSession:
    """Session for the command line; master and sizes come from spark-submit."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a master that runs in one process gets a fresh temporary
    folder; a cluster, on one machine or many, must name a folder that all executors reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="yearloom-")


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what is stored inside it, at its end.

    For the stages of the command line, whose results are written to places of their own.
    Outside a scope stored results stay, as the frames read from them are still to be used.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses; deleted when the application ends."""
    path = f"{_own_folder(spark, shared_folder(spark).rstrip('/'))}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_own: dict[tuple[str, str], str] = {}


def _own_folder(spark: SparkSession, shared: str) -> str:
    """This application's folder in the shared one, which its file system deletes at the end."""
    key = (spark.sparkContext.applicationId, shared)
    if key not in _own:
        _own[key] = f"{shared}/yearloom/{key[0]}-{uuid.uuid4().hex[:8]}"
        place = spark._jvm.org.apache.hadoop.fs.Path(_own[key])
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(place)
        system.deleteOnExit(place)
    return _own[key]


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result is computed once, however often it is used afterwards, has no
    lineage left to recompute when executors are lost, and tells its size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
