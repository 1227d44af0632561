"""A join with a small or large keyed side that does not depend on luck.

The keyed side is broadcast only after its size was measured.  Beyond the bound
both sides are shuffled, and keys that hold a large share of the rows are
spread over several tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

from yearloom.session import store

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_WIDTH = 16  # bytes assumed for a number, boolean, date or timestamp

# A key is hot when it holds more than this share of the rows, so there are
# fewer than 1 / HOT_SHARE hot keys whatever the size of the data.
HOT_SHARE = 1 / 1000

ROWS = "__rows"
_SALT = "__salt"
_PARTS = "__parts"


def _width(name: str, kind: DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + FIXED_WIDTH
    if isinstance(kind, (StructType, ArrayType, MapType, VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + FIXED_WIDTH
    return F.lit(FIXED_WIDTH)


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of ``df``, from one aggregate."""
    width = reduce(
        lambda a, b: a + b, [_width(f.name, f.dataType) for f in df.schema.fields], F.lit(0)
    )
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(width.cast("long")).alias("bytes")
    ).first()
    return row["rows"], row["bytes"] or 0


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def size_checked_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    fits: bool | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` with ``right``, which holds each key at most once.

    ``null_safe`` makes NULL keys equal to each other.  ``fits`` is the outcome of
    ``fits_broadcast(right)``, for callers that join the same side several times;
    ``counts`` are the rows of ``left`` per key (column ``ROWS``), if already known.
    The result has the columns of ``left`` and then the non-key columns of ``right``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    if fits_broadcast(right) if fits is None else fits:
        return _join(left, F.broadcast(_renamed(right, on)), on, how, null_safe)
    return _spread_join(left, right, on, how, null_safe, counts)


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__right_{k}" for k in keys})


def _join(left, right, keys, how, null_safe) -> DataFrame:
    def same(k):
        a, b = F.col(f"`{k}`"), F.col(f"`__right_{k}`")
        return a.eqNullSafe(b) if null_safe else a == b

    condition = reduce(lambda a, b: a & b, [same(k) for k in keys])
    return left.join(right, condition, how).drop(*[f"__right_{k}" for k in keys])


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, computed once."""
    return store(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)), "key-counts")


def hot_keys(counts: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """Keys that hold more than ``HOT_SHARE`` of the rows, and the tasks each should take.

    Fewer than ``1 / HOT_SHARE`` keys qualify, so the result can be broadcast.
    """
    total = counts.agg(F.sum(ROWS)).first()[0] or 1
    parts = F.ceil(F.col(ROWS) * F.lit(2.0 * tasks / total)).cast("int")
    return counts.where(F.col(ROWS) > total * HOT_SHARE).select(*keys, parts.alias(_PARTS))


def _spread_join(left, right, on, how, null_safe, counts) -> DataFrame:
    """Shuffle join in which a hot key takes tasks in proportion to its rows.

    The salt is a hash of the row, so a task that runs twice sends each row to
    the same place.  Full copies of one row share a salt; those are left to the
    skew splitting of adaptive execution, which cuts by input and not by value.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = key_counts(left, on) if counts is None else counts
    hot = F.broadcast(_renamed(hot_keys(counts, on, tasks), on))

    hashable = [f"`{f.name}`" for f in left.schema.fields if not holds_map(f.dataType)]
    row_hash = F.xxhash64(*hashable)
    some_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in on])
    salt = F.when(F.col(_PARTS).isNotNull(), F.pmod(row_hash, F.col(_PARTS)))
    if not null_safe:  # rows with a NULL key match nothing, so any place will do
        salt = F.when(some_null, F.pmod(row_hash, F.lit(tasks))).otherwise(salt)
    salted = (
        _join(left, hot, on, "left", null_safe)
        .withColumn(_SALT, F.coalesce(salt.cast("int"), F.lit(0)))
        .drop(_PARTS)
    )

    copies = F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)
    spread = (
        _join(right, hot, on, "left", null_safe)
        .withColumn(_SALT, F.explode(copies))
        .drop(_PARTS)
    )
    keys = [*on, _SALT]
    return _join(salted, _renamed(spread, keys), keys, how, null_safe).drop(_SALT)


def holds_map(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return True
    if isinstance(kind, ArrayType):
        return holds_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    return False
