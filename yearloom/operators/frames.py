"""Model frames: complete rows, splits, imputation, errors and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.operators.joins import fits_broadcast, holds_map, size_checked_join
from yearloom.session import store

IMPUTED = "_imputed"


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that have a value, and not NaN, in each of ``columns``."""
    return df.dropna(subset=columns)


def key_bucket(keys: list[str], seed: int, buckets: int) -> Column:
    """A bucket from 0 on, as a hash of the keys: the same row always gets the same one."""
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed))
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def key_split(
    df: DataFrame,
    keys: list[str],
    train_percent: int = 80,
    seed: int = 42,
    bucket: Column | None = None,
    name: str = "split",
) -> DataFrame:
    """Mark rows ``train`` or ``validation`` by their keys, whatever the layout.

    ``bucket`` replaces the hash by another number between 0 and 99.
    """
    number = key_bucket(keys, seed, 100) if bucket is None else bucket
    part = F.when(number < train_percent, F.lit("train")).otherwise(F.lit("validation"))
    return df.withColumn(name, part)


_DIGIT = 16  # bits of a hash that are counted at a time


def _counted_cut(rows: DataFrame, strata: list[str], number: str, wanted: DataFrame) -> DataFrame:
    """Per stratum the ``number`` at which its ``__left`` smallest end (``__cut``), and how many of
    those with that very number belong to them (``__left``).

    The numbers are longs.  They are counted by their first bits; then, of those with the bits that the
    cut falls in, by the next ones, so no stratum is sorted or seen by one task.
    """
    cuts = wanted.withColumn("__cut", F.lit(0).cast("long"))
    by_count = Window.partitionBy(*strata).orderBy("__bits")
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        bits = F.shiftright(number, shift)
        if shift < 64 - _DIGIT:
            bits = bits.bitwiseAND(F.lit((1 << _DIGIT) - 1))
            joined = size_checked_join(rows, cuts, strata, "inner", null_safe=True, fits=fits_broadcast(cuts))
            inside = joined.where(F.shiftright(number, shift + _DIGIT) == F.col("__cut"))
        else:
            inside = size_checked_join(rows, cuts, strata, "inner", null_safe=True, fits=fits_broadcast(cuts))
        counts = inside.groupBy(*strata, "__cut", "__left", bits.cast("long").alias("__bits")).count()
        upto = counts.withColumn("__upto", F.sum("count").over(by_count))
        hit = upto.where((F.col("__upto") >= F.col("__left")) & (F.col("__upto") - F.col("count") < F.col("__left")))
        prefix = F.shiftleft("__cut", _DIGIT).bitwiseOR(F.col("__bits")) if shift < 64 - _DIGIT else F.col("__bits")
        left = F.col("__left") - (F.col("__upto") - F.col("count"))
        cuts = store(hit.select(*strata, left.alias("__left"), prefix.alias("__cut")), "split-cuts")
    return cuts


def exact_split(
    df: DataFrame,
    keys: list[str],
    strata: list[str],
    train_percent: int = 80,
    seed: int = 42,
    number: Column | None = None,
    name: str = "split",
) -> DataFrame:
    """Mark exactly ``train_percent`` of each stratum's rows as ``train``, rounded half up.

    Those are the rows with the smallest hashes of their keys, the same ones in every layout.
    Rows that share keys are told apart by hashes of all columns; which of full copies are
    taken makes no difference.  NULL is a stratum of its own.  ``number`` replaces the hash of the keys by another long.
    """
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed)) if number is None else number.cast("long")
    plain = [f"`{f.name}`" for f in df.schema.fields if not holds_map(f.dataType)]
    rows = df.withColumns({"__key_hash": hashed, "__row_hash": F.xxhash64(*plain)})
    names = [f"__stratum_{i}" for i in range(len(strata))]
    rows = rows.withColumns({n: F.col(f"`{s}`") for n, s in zip(names, strata, strict=True)})
    share = F.floor((F.count(F.lit(1)) * train_percent + 50) / 100).alias("__left")
    wanted = rows.groupBy(*names).agg(share).where("__left > 0")
    first = _counted_cut(rows.select(*names, "__key_hash"), names, "__key_hash", store(wanted, "split-sizes"))
    first = store(first.select(*names, F.col("__cut").alias("__key_cut"), "__left"), "split-keys")
    # Rows with the very hash of the cut: mostly one for each stratum.
    tied = size_checked_join(rows, first, names, "inner", null_safe=True).where(F.col("__key_hash") == F.col("__key_cut"))
    second = _counted_cut(
        tied.select(*names, "__row_hash"), names, "__row_hash", first.select(*names, "__left")
    ).select(*names, F.col("__cut").alias("__row_cut"), F.col("__left").alias("__copies"))
    cuts = store(first.drop("__left").join(_null_safe_names(second, names), _same(names)).drop(*[f"__r{n}" for n in names]), "split-ends")
    marked = size_checked_join(rows, cuts, names, "left", null_safe=True)
    key, row = F.col("__key_hash"), F.col("__row_hash")
    same_key = key == F.col("__key_cut")
    copy = same_key & (row == F.col("__row_cut"))
    # Full copies at the cut are numbered; others need no order.
    number_of = F.row_number().over(Window.partitionBy(*names, "__row_hash").orderBy("__key_hash"))
    inside = (key < F.col("__key_cut")) | (same_key & (row < F.col("__row_cut")))
    part = F.when(F.coalesce(inside, F.lit(False)), "train").otherwise("validation")
    is_copy = F.coalesce(copy, F.lit(False))
    rest = marked.where(~is_copy).withColumn(name, part)
    copies = marked.where(is_copy).withColumn("__nth", number_of)
    copies = copies.withColumn(name, F.when(F.col("__nth") <= F.col("__copies"), "train").otherwise("validation")).drop("__nth")
    return rest.unionByName(copies).select(*[f"`{c}`" for c in df.columns if c != name], name)


def _null_safe_names(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"__r{n}" for n in names})


def _same(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__r{n}")) for n in names])


def random_split(
    df: DataFrame, train_percent: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded random split, which depends on how the rows are laid out."""
    share = train_percent / 100
    train, validation = df.randomSplit([share, 1 - share], seed=seed)
    return train, validation


def split_counts(df: DataFrame, name: str = "split") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"))


def as_doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers as doubles: the mean of an integer column would lose its fraction."""
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})


def mean_imputer(columns: list[str]) -> Estimator:
    return Imputer(
        inputCols=columns, outputCols=[c + IMPUTED for c in columns], strategy="mean"
    )


def mean_imputed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_imputed``: the value, or the column's mean where it is missing."""
    numbers = as_doubles(df, columns)
    return mean_imputer(columns).fit(numbers).transform(numbers)


def rmse(label: str, prediction: str) -> Column:
    """Root mean squared error, as an aggregate."""
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), F.lit(2.0))))


def rmse_by(df: DataFrame, group: list[str], label: str, prediction: str) -> DataFrame:
    return df.groupBy(*group).agg(rmse(label, prediction).alias("rmse"))


def small_data_check(counts: DataFrame, thresholds: dict[str, int]) -> DataFrame:
    """``check, value, threshold, status`` from named counts in one row.

    ``status`` is ``warning`` where the count is below its threshold.
    """
    checks = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(name).cast("long").alias("value"),
            F.lit(limit).cast("long").alias("threshold"),
            F.when(F.col(name) < limit, F.lit("warning")).otherwise(F.lit("ok")).alias("status"),
        )
        for name, limit in thresholds.items()
    ]
    return counts.select(F.inline(F.array(*checks)))
