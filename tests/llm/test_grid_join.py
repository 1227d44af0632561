import math

import numpy as np
import pytest

from yearloom.llm import catalog, grid_join

ROWS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    units, root, links = [], {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}
    for i, v, label in rows:
        ok = v and label is not None and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        units.append((i, x / np.sqrt(x @ x) if ok else None, label))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x, label) in enumerate(units):
        for j, y, other in units[:a]:
            if x is not None and y is not None and label == other and len(x) == len(y) and x @ y >= cosine:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((str(i), links[i], str(find(i)), i is None or find(i) == i) for i, _, _ in rows)


def result(df):
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in grid_join.find(df).collect())


@pytest.mark.parametrize("small", [False, True])
def test_links_as_by_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(grid_join, "BLOCK", 16)
        monkeypatch.setattr(grid_join, "LEAF", 4)
    r, rows = np.random.default_rng(2), []
    centres = r.standard_normal((12, 16))
    for k in range(260):
        v = centres[r.integers(12)] + r.choice([0.05, 0.2, 0.4]) * r.standard_normal(16)
        rows.append((k * 7 % 260, v.astype(np.float32).tolist(), int(k % 3 > 0)))
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(20)]  # copies
    df = spark.createDataFrame(rows, ROWS)
    assert result(df) == brute(rows)


def test_messy_vectors(spark):
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, float("nan")], 1),
        (6, [1.0, float("inf")], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 1),
        (10, [3.0, 0.1], 1), (11, [1.0, 0.0], 2), (12, [1.0, 0.0, 0.0], 1), (13, [1e-30, 0.0], 1),
        (14, [3e38, 0.0], 1), (None, [1.0, 0.0], 1), (15, [-1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, ROWS)
    # Columns of other names and a copy of the table's own inner names do no harm.
    assert result(df.selectExpr("*", "1 AS id", "2 AS n", "'x' AS unit")) == brute(rows)
    assert grid_join.find(df.limit(0)).count() == 0


def test_rows_that_share_a_key(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (9, [0.01, 1.0], 1)]
    found = {(r[0], r[2]) for r in grid_join.find(spark.createDataFrame(rows, ROWS)).collect()}
    assert found == {(5, 2), (2, 2), (9, 2)}


def test_query_as_by_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = catalog.op7_grid_join(spark, folder).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in found) == brute(rows)
