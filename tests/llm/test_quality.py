import math
import zlib

import numpy as np
import pytest

from yearloom.llm import catalog, quality


def test_messy_rows(messy, same_extras):
    result = quality.features(messy)
    same_extras(result.drop("features"))
    assert all(len(r["features"]) == len(quality.NAMES) and all(map(math.isfinite, r["features"])) for r in result.collect())
    assert quality.features(messy.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, 1.0)], [(0, 1.0), (0, 2.0)], [(None, 1.0), (7, 2.0)]])
def test_without_both_labels_all_scores_are_the_share(spark, rows):
    d = len(quality.NAMES)
    df = spark.createDataFrame([(y, [x] * d) for y, x in rows], "label int, features array<double>")
    model = quality.fit(df)
    known = [y for y, _ in rows if y in (0, 1)]
    expected = sum(known) / len(known) if known else 0.5
    assert {r["score"] for r in quality.score(df, model).collect()} <= {expected}


def test_fit_equals_the_formula(spark):
    """Log-density differences from inverses and determinants of the shrunken covariances."""
    r, d = np.random.default_rng(4), len(quality.NAMES)
    x = {0: r.standard_normal((60, d)) * 2, 1: r.standard_normal((90, d)) + 0.5}
    rows = [(k, v.tolist()) for k in x for v in x[k]]
    df = spark.createDataFrame(rows, "label int, features array<double>").repartition(5)
    model = quality.fit(df)
    pooled = np.diag(sum(len(v) * v.var(0) for v in x.values()) / 150)
    density = {}
    test = r.standard_normal((20, d))
    for k, v in x.items():
        s = (1 - quality.SHRINKAGE) * np.cov(v.T, bias=True) + quality.SHRINKAGE * pooled + quality.FLOOR * np.eye(d)
        gap = test - v.mean(0)
        density[k] = math.log(len(v) / 150) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(s), gap)
    assert np.allclose(model.scores(test), 1 / (1 + np.exp(density[0] - density[1])))


def test_null_vectors_have_no_score(spark):
    df = spark.createDataFrame([(None,), ([0.0] * len(quality.NAMES),)], "features array<double>")
    assert [r["score"] for r in quality.score(df, quality.Discriminant(0.25)).collect()] == [None, 0.25]


def test_held_out_accuracy(spark, folder):
    folder = folder.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = catalog.op9_quality(spark, folder)
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    for row in rows.collect():
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3)
    known = rows.where("held_out").join(labels, "doc_id").collect()
    good = [r["predicted"] for r in known if r["quality"] == 1]
    assert sum(good) >= 0.97 * len(good)
    assert sum(r["predicted"] == r["quality"] for r in known) >= 0.9 * len(known)
