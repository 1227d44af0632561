import math

import numpy as np
import pytest

from tests.llm.test_hard_negatives import whole
from yearloom.llm import catalog, impact_index

ROWS = "vec_id bigint, embedding array<float>"


def brute(rows, every, most=5):
    known = [(i, x) for i, v in rows if i is not None and (x := whole(v))]
    out = []
    for i, x in known:
        if i % every == 0:
            own = sorted((-sum(map(int.__mul__, x, y)), j) for j, y in known if j != i and len(x) == len(y))
            out += [(i, k, j, -s) for k, (s, j) in enumerate(own[:most], 1)]
    return sorted(out)


def found(df, every, most=5):
    index = impact_index.build(df)
    queries = impact_index.build(df.where(f"vec_id % {every} = 0"))
    return sorted(map(tuple, impact_index.search(index, queries, most).collect()))


@pytest.mark.parametrize(("size", "scale"), [(1, 1.0), (4, 0.01), (16, 1.0), (64, 0.125), (64, 300.0)])
def test_as_by_brute_force(spark, monkeypatch, size, scale):
    monkeypatch.setattr(impact_index, "SHARD", 150)
    monkeypatch.setattr(impact_index, "QUERY_BYTES", 4000)
    r = np.random.default_rng(size)
    rows = [(k, (scale * r.standard_normal(size)).astype(np.float32).tolist()) for k in range(700)]
    rows += [(1000 + k, rows[k % 7][1]) for k in range(60)]  # ties
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    assert found(df, 20) == brute(rows, 20)


def test_searches_stop_early_and_keep_all_members():
    """Of sparse and skewed vectors few postings are needed; no member is ever missed."""
    r = np.random.default_rng(5)
    x = np.floor(40 * r.pareto(1.0, (3000, 24)) * (r.random((3000, 24)) < 0.3))
    x = np.minimum(x, 5000)
    shard = list(impact_index_shards(x))[0]
    taken = []
    for q in x[:40]:
        scores = x @ q
        best = np.sort(scores)[-6:]
        members = shard.members(q, -1, -np.inf, 5)
        assert set(np.flatnonzero(scores >= best[1])) <= set(members.tolist())
        taken.append(len(members) / len(x))
    assert np.mean(taken) < 0.1


def impact_index_shards(x):
    import pyarrow as pa

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    before, impact_index.TaskContext = impact_index.TaskContext, Context
    try:
        vectors = pa.array((x / 256).tolist(), pa.list_(pa.float64()))
        batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), vectors], ["id", "parts"])
        for out in impact_index._shards(iter([batch])):
            yield impact_index._Shard.of(out.to_pylist()[0])
    finally:
        impact_index.TaskContext = before


def test_messy_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (0, [0.5, 1.0]), (1, None), (2, []), (3, [1.0, None]), (4, [1.0, math.nan]), (5, [math.inf, 0.0]),
        (None, [1.0, 0.5]), (7, [1.0, 0.5]), (7, [1.0, 0.5]), (9, [0.0, 0.0]), (10, [1.0, 0.5, 0.1]), (20, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, ROWS)
    expected = brute(rows, 10)
    assert len(expected) > 5 and found(df, 10) == expected
    assert found(df.selectExpr("*", "'x' AS id", "1 AS line", "2 AS score", "3 AS query", "4 AS parts"), 10) == expected
    assert found(df.limit(0), 1) == [] and found(df.where("embedding IS NULL"), 1) == []


def test_query_as_by_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    result = catalog.op12_impact_search(spark, folder)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, result.collect())) == brute(rows, 50)
