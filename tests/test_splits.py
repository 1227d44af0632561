"""Splits of exact size, and values carried over gaps in groups of any size."""

import random

import pytest
from pyspark.sql import functions as F

from yearloom.operators import frames, panel


def parts(df):
    return sorted(tuple(r) for r in df.collect())


def test_exact_sizes_and_the_same_rows_in_every_layout(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "b").alias("s"))
    first = frames.exact_split(df, ["id"], ["s"])
    counts = {(r["s"], r["split"]): r["count"] for r in first.groupBy("s", "split").count().collect()}
    assert counts == {("hot", "train"): 2800, ("hot", "validation"): 700, ("b", "train"): 800, ("b", "validation"): 200,
                      (None, "train"): 400, (None, "validation"): 100}
    again = frames.exact_split(df.repartition(17).orderBy(F.desc("id")), ["id"], ["s"])
    assert parts(first) == parts(again)
    assert parts(first) != parts(frames.exact_split(df, ["id"], ["s"], seed=7))
    # Those with the smallest hashes.
    hashed = first.withColumn("h", F.xxhash64("id", F.lit(42)))
    ends = hashed.groupBy("s").agg(
        F.max(F.when(F.col("split") == "train", F.col("h"))).alias("a"), F.min(F.when(F.col("split") != "train", F.col("h"))).alias("b")
    )
    assert all(r["a"] < r["b"] for r in ends.collect())


@pytest.mark.parametrize("percent", [0, 1, 50, 100])
def test_any_share_of_few_rows(spark, percent):
    df = spark.createDataFrame([(k, k // 3) for k in range(10)], "id long, s int")
    found = frames.exact_split(df, ["id"], ["s"], percent).groupBy("s").agg(F.count_if(F.col("split") == "train").alias("n")).collect()
    assert {r["s"]: r["n"] for r in found} == {s: ((1 if s == 3 else 3) * percent + 50) // 100 for s in range(4)}
    assert frames.exact_split(df.limit(0), ["id"], ["s"], percent).count() == 0


def test_rows_that_share_keys_and_full_copies(spark):
    """One key holds most rows, and many of those are copies of each other."""
    rows = [(1, "s", k // 40) for k in range(400)] + [(k, "s", 0) for k in range(2, 102)]
    df = spark.createDataFrame(rows, "id long, s string, __x int")
    first, again = (frames.exact_split(d, ["id"], ["s"]) for d in (df, df.repartition(9)))
    assert first.where("split = 'train'").count() == 400 and first.count() == 500
    assert parts(first) == parts(again)


def test_carried_as_by_a_window(spark):
    r = random.Random(2)
    rows = [(r.choice(["hot"] * 8 + ["a", "b", None]), k, r.choice([None, None, None, k]), None if k % 3 else k) for k in range(3000)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, year int, x int, y long")
    found = panel.carried_forward(df, "g", ["year"], ["x", "y"])
    last, out = {}, []
    for g, k, x, y in sorted(rows, key=lambda row: row[1]):
        old = last.get(g, (None, None))
        last[g] = tuple(o if v is None else v for v, o in zip((x, y), old))
        out.append((g, k, *last[g]))
    assert found.columns == df.columns
    assert sorted(map(str, out)) == sorted(str(tuple(row)) for row in found.collect())
    assert panel.carried_forward(df.limit(0), "g", ["year"], ["x"]).count() == 0


def test_no_group_is_in_one_task(spark):
    """A single group is cut to several ranges, each of which only looks at its own rows."""
    df = spark.range(200_000).select(F.lit("one").alias("g"), "id", F.when(F.col("id") == 5, 1.0).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = panel.carried_forward(df, "g", ["id"], ["x"])
        tasks = found.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < 150_000
        assert found.where("x = 1.0").count() == 199_995
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
