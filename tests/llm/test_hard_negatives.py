import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearloom.llm import catalog, hard_negatives

ROWS = "vec_id bigint, embedding array<float>, label int"


def whole(vector):
    if not vector or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * x) for x in np.array(vector, np.float32).astype(float).tolist()]


def brute(rows, every, positives=5, negatives=10):
    """All scores of each anchor, sorted."""
    known = [(i, x, label) for i, v, label in rows if i is not None and label is not None and (x := whole(v))]
    out = []
    for i, x, label in known:
        if i % every:
            continue
        others = [(-sum(map(int.__mul__, x, y)), j, other) for j, y, other in known if j != i and len(x) == len(y)]
        others.sort(key=lambda r: r[:2])
        for score, j, _ in [r for r in others if r[2] == label][:positives]:
            fits = [r for r in others if r[2] != label and 30 * -score <= 100 * -r[0] <= 90 * -score]
            out += [(i, j, k, n, -score, -s) for k, (s, n, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(df, every, **options):
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % every == 0, **options).collect()))


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("size", [1, 5, 64, 70])
def test_as_by_brute_force(spark, monkeypatch, small, size):
    if small:  # stored rows of a few vectors, blocks of a few anchors
        monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 2000)
        monkeypatch.setattr(hard_negatives, "FEW", 2.0)
    r, rows = np.random.default_rng(size), []
    centres = r.standard_normal((6, size))
    for k in range(240):
        v = (centres[r.integers(6)] + 0.8 * r.standard_normal(size)) / math.sqrt(size)
        rows.append((k, v.astype(np.float32).tolist(), int(r.integers(3))))
    rows += [(300 + k, rows[k // 8][1], k % 3) for k in range(40)]  # ties
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    expected = brute(rows, 6)
    assert mined(df, 6) == expected and len(expected) > 100


def test_messy_vectors(spark):
    rows = [
        (0, [1.0, 0.5], 1), (0, [0.5, 1.0], 1), (1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [1.0, math.nan], 2),
        (5, [math.inf, 0.0], 2), (6, [0.7, 0.2], None), (None, [1.0, 0.5], 1), (7, [1.0, 0.5], 1), (7, [1.0, 0.5], 1),
        (8, [0.5, 0.3], 2), (8, [0.5, 0.3], 2), (9, [0.0, 0.0], 2), (10, [1.0, 0.5, 0.1], 2), (20, [-1.0, 0.0], 3),
    ]
    df = spark.createDataFrame(rows, ROWS)
    expected = brute(rows, 10)
    assert expected and mined(df, 10) == expected
    assert mined(df.selectExpr("*", "'x' AS id", "1 AS line", "2 AS score", "3 AS anchor", "4 AS parts"), 10) == expected
    assert mined(df.where("vec_id = 9"), 9) == [] and mined(df.limit(0), 10) == []
    assert mined(df.where("embedding IS NULL"), 1) == []


def test_bounds_hold():
    """Every segment level bounds the exact score of every pair."""
    r = np.random.default_rng(3)
    for size in (1, 3, 16, 33, 64):
        x = np.floor(256 * r.standard_normal((40, size)))
        short, exact, place = hard_negatives.summaries(x).astype(float), x @ x.T, 0
        for many in hard_negatives._levels(size):
            mean, apart = short[:, place : place + many], short[:, place + many : place + 2 * many]
            place += 2 * many
            slack = 1e-5 * np.abs(exact).max() + 1
            assert (np.abs(exact - mean @ mean.T) <= apart @ apart.T + slack).all()
        assert place == short.shape[1]


def test_query_as_by_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 and label is not None else label) for i, v, label in rows]
    assert sorted(map(tuple, catalog.op11_hard_negatives(spark, folder).collect())) == brute(moved, 100)
