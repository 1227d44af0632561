"""Writers: whole tables, and tables partitioned by period."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from yearloom.operators.joins import holds_map

FORMATS = ("parquet", "orc", "json", "csv")


def check_format(df: DataFrame, fmt: str) -> None:
    """Refuse, before any work, what the format cannot hold."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {', '.join(FORMATS)}")
    if fmt == "csv":
        nested = [f.name for f in df.schema.fields if _nested(f.dataType)]
        if nested:
            raise ValueError(f"csv cannot hold the nested columns {', '.join(nested)}")


def _nested(kind: DataType) -> bool:
    return isinstance(kind, (StructType, ArrayType, MapType))


def _writer(df: DataFrame, fmt: str, overwrite: bool) -> DataFrameWriter:
    check_format(df, fmt)
    writer = df.write.format(fmt).mode("overwrite" if overwrite else "errorifexists")
    return writer.options(header=True, escape='"') if fmt == "csv" else writer


def write_table(df: DataFrame, path: str, fmt: str = "parquet", overwrite: bool = False) -> None:
    """Write ``df``; an existing target is an error unless ``overwrite``."""
    _writer(df, fmt, overwrite).save(path)


def by_period(df: DataFrame, period: str) -> DataFrame:
    """Bring the rows of a period together, in as many tasks as their volume needs.

    With adaptive execution a large period is cut into several tasks and small
    ones share a task.  Without it, a hash of the row spreads every period.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", F.col(period))
    tasks = int(conf.get("spark.sql.shuffle.partitions"))
    columns = [f"`{f.name}`" for f in df.schema.fields if not holds_map(f.dataType)]
    return df.repartition(period, F.pmod(F.xxhash64(*columns), F.lit(tasks)))


def write_by_period(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    overwrite: bool = False,
    period: str = "year",
    only_given: bool = False,
) -> None:
    """Write ``df`` with one directory per period.

    With ``only_given``, an overwrite replaces the periods that ``df`` holds and
    leaves the others; by default it replaces the whole table.
    """
    check_format(df, fmt)
    writer = _writer(by_period(df, period), fmt, overwrite).partitionBy(period)
    if only_given:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
