"""From raw names and dates to identifiers and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.functions import clean_key, date_from_parts, year_from_filename
from yearloom.operators.joins import size_checked_join
from yearloom.specs import PeriodSpec

_KEY = "__name_key"
_PATH = "__source_path"


def name_lookup(
    lookup: DataFrame, name_column: str, id_column: str, on_conflict: str = "raise"
) -> DataFrame:
    """One row per cleaned name: the name key and its identifier.

    Several spellings of a name fall together.  Two identifiers for one name are
    an error when the result is used, or the smaller one with ``"min"``.
    """
    if on_conflict not in ("raise", "min"):
        raise ValueError(f"unknown on_conflict {on_conflict!r}")
    low, high = F.min(F.col(id_column)), F.max(F.col(id_column))
    if on_conflict == "min":
        chosen = low
    else:
        clash = F.concat(F.lit("two identifiers for the name "), F.col(_KEY))
        chosen = F.when(low == high, low).when(low.isNotNull(), F.raise_error(clash))
    return (
        lookup.select(clean_key(name_column).alias(_KEY), F.col(id_column))
        .where(F.col(_KEY).isNotNull())
        .groupBy(_KEY)
        .agg(chosen.alias(id_column))
    )


def reconcile(
    df: DataFrame, names: DataFrame, name_column: str, fits: bool | None = None
) -> DataFrame:
    """Add the identifier of ``names`` (see ``name_lookup``); NULL where there is none."""
    # No cleaned name is a blank, so that value matches nothing, just like NULL.  A key
    # that cannot be NULL spares Spark a null check that would clean each name twice.
    key = F.coalesce(clean_key(F.col(f"`{name_column}`")), F.lit(" "))
    keyed = df.withColumn(_KEY, key)
    return size_checked_join(keyed, names, [_KEY], "left", fits=fits).drop(_KEY)


def unmatched(df: DataFrame, id_column: str) -> DataFrame:
    """The rows that found no identifier."""
    return df.where(F.col(id_column).isNull())


def matched(df: DataFrame, id_column: str) -> DataFrame:
    """The rows that found an identifier."""
    return df.where(F.col(id_column).isNotNull())


def with_period(df: DataFrame, period: PeriodSpec, name: str = "year") -> DataFrame:
    """Add the integer period column.  Files whose path does not match drop out."""
    if period.kind == "column":
        return df.withColumnRenamed(period.columns[0], name)
    if period.kind == "parts":
        opened = date_from_parts(*[F.col(f"`{c}`") for c in period.columns])
        return df.withColumn(period.date_column, opened).withColumn(
            name, F.year(period.date_column)
        )
    return (
        df.withColumn(_PATH, F.col("_metadata.file_path"))
        .withColumn(name, year_from_filename(_PATH, period.pattern))
        .where(F.col(name).isNotNull())
        .drop(_PATH)
    )
