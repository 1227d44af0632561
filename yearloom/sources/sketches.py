"""A profile that is kept per part of a table and merged for any choice of parts without a scan.

Each part (a year, a landed file) has a row per column with counts, ends, a sketch of how many
different values there are, and for numbers a sketch of their order.  Sketches have a bounded size
whatever the number of rows, so profiles of many parts are merged in one small aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.sources.landing import NESTED

PRECISION = 12  # two to this power registers: about 1.6 % error of numbers of values
ACCURACY = 400  # about 0.7 % error of ranks
NUMBERS = ("byte", "short", "integer", "long", "float", "double")


def part_profiles(df: DataFrame, part: str) -> DataFrame:
    """One row per part and column: ``column_name``, ``row_count``, ``null_count``, ``values`` and ``ranks``.

    One aggregate over the table, partial within tasks.  ``part`` may be NULL.  NaN counts as a value but has no rank.
    """
    aggregates, entries = [F.count(F.lit(1)).alias("__rows")], []
    fields = [f for f in df.schema.fields if f.name != part]
    for i, field in enumerate(fields):
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        value = column
        if kind in ("float", "double"):
            value = F.when(column == 0, F.lit(0.0)).otherwise(column)
        elif kind in NESTED:
            value = F.to_json(F.struct(column))
        hashed = F.when(column.isNotNull(), F.xxhash64(value))
        aggregates += [
            F.count_if(column.isNull()).alias(f"__n{i}"),
            F.hll_sketch_agg(hashed, F.lit(PRECISION)).alias(f"__v{i}"),
        ]
        ranks = F.lit(None).cast("binary")
        if kind in NUMBERS or kind.startswith("decimal"):
            number = column.cast("double")
            aggregates.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(ACCURACY)).alias(f"__r{i}"))
            ranks = F.col(f"__r{i}")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("__rows").alias("row_count"),
                F.col(f"__n{i}").alias("null_count"),
                F.col(f"__v{i}").alias("values"),
                ranks.alias("ranks"),
            )
        )
    grouped = df.groupBy(F.col(f"`{part}`").alias("part")).agg(*aggregates)
    return grouped.select("part", F.inline(F.array(*entries)))


def merged_profile(profiles: DataFrame, quantiles: Iterable[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column, of all parts in ``profiles``: counts, about how many values, and ``quantiles``.

    ``quantiles`` is an array in the order that was asked for, null where there are no numbers.
    """
    merged = profiles.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("approx_distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )
    known = F.kll_sketch_get_n_double("ranks") > 0
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.when(known, F.kll_sketch_get_quantile_double("ranks", wanted))
    return merged.withColumn("quantiles", found).drop("ranks")
