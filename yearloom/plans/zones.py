"""The stages between zones: landing to formatted, formatted to exploitation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from yearloom.operators.joins import fits_broadcast
from yearloom.operators.panel import master_table, sorted_master
from yearloom.operators.reconcile import name_lookup, reconcile, with_period
from yearloom.session import store
from yearloom.sources import readers, writers
from yearloom.specs import DatasetSpec, LookupSpec, PanelSpec


def format_dataset(
    df: DataFrame, spec: DatasetSpec, names: DataFrame, fits: bool | None = None
) -> DataFrame:
    """Raw rows with their year and identifier; rows without an identifier stay."""
    return reconcile(with_period(df, spec.period), names, spec.name_column, fits)


def format_zone(
    spark: SparkSession,
    specs: Iterable[DatasetSpec],
    lookup: LookupSpec,
    landing_base: str,
    lookup_base: str,
    formatted_base: str,
    fmt: str = "parquet",
    overwrite: bool = False,
    only_given_years: bool = False,
) -> None:
    """Format each landed dataset and write it by year.

    The lookup is cleaned once and stored, for the three datasets to share.
    """
    raw = readers.read_lookup(spark, lookup, lookup_base)
    names = store(name_lookup(raw, lookup.name_column, lookup.id_column), "names")
    fits = fits_broadcast(names)
    formatted = {
        spec.name: format_dataset(
            readers.read_dataset(spark, spec, landing_base), spec, names, fits
        )
        for spec in specs
    }
    for df in formatted.values():
        writers.check_format(df, fmt)
    for name, df in formatted.items():
        writers.write_by_period(
            df, f"{formatted_base}/{name}", fmt, overwrite, only_given=only_given_years
        )


def formatted_schema(spec: DatasetSpec, lookup: LookupSpec) -> str:
    """Schema of a formatted dataset, for formats that do not keep types."""
    columns = spec.schema
    if spec.period.kind == "parts":
        columns += f", {spec.period.date_column} date"
    if spec.period.kind == "column":
        old = spec.period.columns[0]
        columns = ", ".join(
            c for c in _split_columns(columns) if c.split()[0].strip("`") != old
        )
    return f"{columns}, {lookup.id_column} string, year int"


def _split_columns(ddl: str) -> list[str]:
    """Top-level columns of a DDL text."""
    parts, depth = [""], 0
    for character in ddl:
        depth += {"<": 1, ">": -1}.get(character, 0)
        if character == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += character
    return [" ".join(p.split()) for p in parts]


def exploit_zone(
    spark: SparkSession,
    panel: PanelSpec,
    formatted_base: str,
    exploitation_base: str,
    table: str,
    fmt: str = "parquet",
    overwrite: bool = False,
    input_fmt: str = "parquet",
    schemas: dict[str, str] | None = None,
    years: Iterable[int] | None = None,
) -> None:
    """Build the master table from the formatted datasets and write it, sorted."""
    names = [fact.name for fact in panel.facts]
    facts = readers.read_tables(spark, formatted_base, names, input_fmt, years, schemas)
    master = sorted_master(master_table(facts, panel), panel)
    writers.write_table(master, f"{exploitation_base}/{table}", fmt, overwrite)


def master_schema(panel: PanelSpec) -> str:
    """Schema of the master table, for formats that do not keep types."""
    measures = [m for fact in panel.facts for m in fact.measures]
    columns = [f"{m.name} {'double' if m.how == 'avg' else 'bigint'}" for m in measures]
    return ", ".join([f"{panel.entity} string", f"{panel.period} int", *columns])
