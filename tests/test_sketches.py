"""Profiles that are kept per part and merged."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearloom.sources import sketches


def test_merged_as_from_all_rows(spark):
    r = np.random.default_rng(3)
    rows = [(int(k % 5), int(r.integers(3000)), float(r.normal()), "abc"[k % 3]) for k in range(20_000)]
    df = spark.createDataFrame(rows, "part int, n int, x double, s string")
    kept = sketches.part_profiles(df, "part").cache()
    assert kept.count() == 15
    for parts in ([0, 1, 2, 3, 4], [1, 3], [4]):
        own = [row for row in rows if row[0] in parts]
        found = {r["column_name"]: r for r in sketches.merged_profile(kept.where(F.col("part").isin(parts)), [0.1, 0.9]).collect()}
        assert all(found[c]["row_count"] == len(own) and found[c]["null_count"] == 0 for c in "nxs")
        assert found["n"]["approx_distinct"] == pytest.approx(len({row[1] for row in own}), rel=0.06)
        assert found["s"]["approx_distinct"] == 3 and found["s"]["quantiles"] is None
        for q, value in zip((0.1, 0.9), found["x"]["quantiles"], strict=True):
            assert np.mean([row[2] <= value for row in own]) == pytest.approx(q, abs=0.015)


def test_nulls_nan_empty_parts_and_clashing_names(spark):
    rows = [(1, None, None, None), (None, 1, float("nan"), [1]), (1, 2, 0.0, [1]), (1, 2, -0.0, None)]
    df = spark.createDataFrame(rows, "part int, row_count int, x double, ranks array<int>")
    found = {r["column_name"]: r for r in sketches.merged_profile(sketches.part_profiles(df, "part"), [0.5]).collect()}
    assert {c: (r["row_count"], r["null_count"], r["approx_distinct"]) for c, r in found.items()} == {
        "row_count": (4, 1, 2), "x": (4, 1, 2), "ranks": (4, 2, 1)}
    assert found["x"]["quantiles"] == [0.0] and found["ranks"]["quantiles"] is None
    none = sketches.part_profiles(df.where("part = 1").select("part", F.lit(None).cast("int").alias("n")), "part")
    assert sketches.merged_profile(none).first()["quantiles"] is None
    assert sketches.merged_profile(sketches.part_profiles(df.limit(0), "part")).count() == 0
