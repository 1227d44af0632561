import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from yearloom.llm import vectors


def test_whole_numbers_of_messy_vectors():
    rows = [[0.5, -0.001], None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [3.0], [-0.0, 0.0], [1e30, 0.0]]
    found = {}
    for rows_of, whole in vectors.whole_numbers(pa.array(rows, pa.list_(pa.float64()))):
        found.update(zip(rows_of.tolist(), whole.tolist(), strict=True))
    assert found == {0: [128.0, -1.0], 6: [768.0], 7: [0.0, 0.0]}
    # The same in a slice of a longer array.
    part = pa.array([[9.0], *rows], pa.list_(pa.float64())).slice(1)
    assert sorted(i for r, _ in vectors.whole_numbers(part) for i in r.tolist()) == [0, 6, 7]


@pytest.mark.parametrize("top", [3, 2**14, 2**30, 2**28 * 7])
def test_products_are_exact(top):
    r = np.random.default_rng(top)
    a, b = r.integers(-top, top, (5, 7)).astype(float), r.integers(-top, top, (6, 7)).astype(float)
    a, b = (vectors.unpacked(vectors.packed(x), len(x), 7) for x in (a, b))
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    assert vectors.products(a, b).tolist() == exact
    assert vectors.pair_products(a, b[:5]).tolist() == [exact[k][k] for k in range(5)]


ROWS = st.lists(st.tuples(st.integers(0, 4), st.integers(-3, 3), st.integers(0, 9)), max_size=60)


@settings(max_examples=50, deadline=None)
@given(ROWS, st.integers(1, 4), st.integers(1, 7))
def test_best_rows_of_each_line(rows, most, each):
    best = vectors.Best(5, most)
    for start in range(0, len(rows), each):
        best.add(*(np.array(x, np.int64) for x in zip(*rows[start : start + each], strict=True)))
    found = list(zip(best.line.tolist(), best.score.tolist(), best.key.tolist(), strict=True))
    for line in range(5):
        own = sorted((r for r in rows if r[0] == line), key=lambda r: (-r[1], r[2]))
        assert [r for r in found if r[0] == line] == own[:most]
        assert best.least[line] == (own[most - 1][1] if len(own) >= most else -np.inf)
