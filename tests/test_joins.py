import pytest
from pyspark.sql import functions as F

from yearloom.operators.joins import (
    fits_broadcast,
    hot_keys,
    key_counts,
    measured_size,
    size_checked_join,
)


@pytest.fixture(scope="module")
def left(spark):
    """A key with half of the rows, another with a sixth, NULLs, and full copies."""
    i = F.col("id")
    key = (
        F.when(i % 6 < 3, F.lit("hot"))
        .when(i % 6 == 3, F.lit("warm"))
        .when(i % 6 == 4, F.lit(None))
        .otherwise(F.concat(F.lit("k"), i % 500))
    )
    return spark.range(60_000).select((i / 2).cast("int").alias("row"), key.alias("k"))


@pytest.fixture(scope="module")
def right(spark):
    rows = [("hot", 1), ("warm", 2), (None, 3)] + [(f"k{n}", n) for n in range(0, 400)]
    return spark.createDataFrame(rows, "k string, value int")


def brute_force(left, right, how, null_safe):
    values = {r["k"]: r["value"] for r in right.collect()}
    if not null_safe:
        values.pop(None)
    rows = [(r["row"], r["k"]) for r in left.collect()]
    joined = [(a, k, values.get(k)) for a, k in rows if how == "left" or k in values]
    return sorted(joined, key=str)


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_join_matches_brute_force(spark, left, right, how, null_safe, fits):
    joined = size_checked_join(left, right, ["k"], how, null_safe, fits=fits)
    assert joined.columns == ["row", "k", "value"]
    rows = sorted([tuple(r) for r in joined.collect()], key=str)
    assert rows == brute_force(left, right, how, null_safe)


def test_two_keys(spark):
    left = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "a", 7)], "x int, y string, v int")
    right = spark.createDataFrame([(1, "a", "p"), (2, "a", "q")], "x int, y string, w string")
    for fits in (True, False):
        rows = size_checked_join(left, right, ["x", "y"], fits=fits).collect()
        expected = {(1, "a", 5, "p"), (1, "b", 6, None), (2, "a", 7, "q")}
        assert {tuple(r) for r in rows} == expected


def test_large_side_is_not_broadcast_and_hot_keys_are_spread(spark, left, right, plan):
    small = size_checked_join(left, right, ["k"], fits=True)
    assert "BroadcastHashJoin [k" in plan(small)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    previous = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        large = size_checked_join(left, right, ["k"], fits=False)
        text = plan(large)
        assert "SortMergeJoin [k" in text and "__salt" in text
        for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert forbidden not in text
        tasks = large.where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
        assert tasks >= 4
    finally:
        for name, value in previous.items():
            spark.conf.set(name, value)


def test_hot_keys_take_tasks_by_their_share(left):
    parts = {r["k"]: r["__parts"] for r in hot_keys(key_counts(left, ["k"]), ["k"], 100).collect()}
    assert parts["hot"] == 100 and parts["warm"] == 34 and parts[None] == 34


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    rows, size = measured_size(df)
    assert rows == 2 and size == 3 + 4 * 16
    assert fits_broadcast(df) and not fits_broadcast(df, max_rows=1)
    assert not fits_broadcast(df, max_bytes=10)
    assert measured_size(df.limit(0)) == (0, 0)


def test_unknown_join_type(left, right):
    with pytest.raises(ValueError):
        size_checked_join(left, right, ["k"], "full")
