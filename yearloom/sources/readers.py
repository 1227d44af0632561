"""Readers: lazy DataFrames with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.operators.joins import holds_map
from yearloom.specs import DatasetSpec, LookupSpec

CSV_OPTIONS = {
    "header": True,
    "encoding": "UTF-8",
    "escape": '"',  # a quote within a quoted field is doubled
    "enforceSchema": False,  # the header of every file is checked against the schema
    "mode": "FAILFAST",
}


def raw_files(spark: SparkSession, glob: str, recursive: bool = False) -> DataFrame:
    """``path``, ``modificationTime`` and ``length`` of the files; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return reader.load(glob).select("path", "modificationTime", "length")


def read_dataset(spark: SparkSession, spec: DatasetSpec, base: str) -> DataFrame:
    """The raw rows of one dataset, as declared by its schema.

    A JSON array on one line is one record to Spark, and so is a CSV file whose fields may
    hold line breaks: such a file is read by one task.  Large arrays are better landed with
    one object per line, large CSV files without line breaks (``multi_line=False``).
    """
    options = {"mode": "FAILFAST"}
    schema = spec.schema
    if spec.format == "csv":
        options = CSV_OPTIONS | {"multiLine": spec.multi_line}
    if spec.corrupt_column:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": spec.corrupt_column}
        schema += f", `{spec.corrupt_column}` string"
    reader = spark.read.schema(schema).options(**(options | spec.options))
    return reader.format(spec.format).load(f"{base}/{spec.glob}")


def _corrupt_text(df: DataFrame, spec: DatasetSpec) -> Column:
    """The text of a record that does not fit the schema, else null.

    Spark parses the columns that a query asks for, and finds faults in those alone, so the
    text refers to all of them, in a condition that is never true.
    """
    others = [f.name for f in df.schema.fields if not holds_map(f.dataType)]
    row = F.xxhash64(*[f"`{c}`" for c in others if c != spec.corrupt_column])
    return F.coalesce(F.col(f"`{spec.corrupt_column}`"), F.when((row == 1) & (row == 2), F.lit("")))


def good_records(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The records that fit the schema, without the column for those that don't."""
    return df.where(_corrupt_text(df, spec).isNull()).drop(spec.corrupt_column)


def corrupt_records(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The text (``record``) and the file of the records that don't fit the schema."""
    rows = df.select(
        _corrupt_text(df, spec).alias("record"), F.col("_metadata.file_name").alias("file_name")
    )
    return rows.where(F.col("record").isNotNull())


def undeclared_fields(spark: SparkSession, spec: DatasetSpec, base: str) -> list[str]:
    """Top-level JSON fields that some file has and the schema does not; reads all files."""
    reader = spark.read.options(**(spec.options | {"samplingRatio": 1.0}))
    found = reader.format(spec.format).load(f"{base}/{spec.glob}").columns
    declared = {c.lower() for c in spark.createDataFrame([], spec.schema).columns}
    return [c for c in found if c.lower() not in declared]


def read_landing(
    spark: SparkSession, specs: Iterable[DatasetSpec], base: str
) -> dict[str, DataFrame]:
    return {spec.name: read_dataset(spark, spec, base) for spec in specs}


def read_lookup(spark: SparkSession, spec: LookupSpec, base: str) -> DataFrame:
    return spark.read.schema(spec.schema).options(**CSV_OPTIONS).csv(f"{base}/{spec.file}")


def preview_dataset(spark: SparkSession, spec: DatasetSpec, base: str) -> DataFrame:
    """The dataset without declared types: JSON inferred, CSV all strings."""
    glob = f"{base}/{spec.glob}"
    if spec.format == "csv":
        return spark.read.option("header", True).csv(glob)
    return spark.read.format(spec.format).load(glob)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    years: Iterable[int] | None = None,
    period: str = "year",
    schema: str | None = None,
) -> DataFrame:
    """A stored table in the format it was written in; ``years`` prunes partitions.

    Text formats do not keep types, so they need the ``schema``.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, escape='"', enforceSchema=False)
    df = reader.load(path)
    return df if years is None else df.where(F.col(period).isin(list(years)))


def read_tables(
    spark: SparkSession,
    base: str,
    names: Iterable[str],
    fmt: str = "parquet",
    years: Iterable[int] | None = None,
    schemas: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    schemas = schemas or {}
    return {
        name: read_table(spark, f"{base}/{name}", fmt, years, schema=schemas.get(name))
        for name in names
    }
