"""Near copies of vectors by an epsilon grid order join.

Unit vectors are projected on their leading principal directions, sorted by the cells of a
grid on them whose width is the largest distance of a link, and cut into blocks.  Two blocks
of a label are joined unless the boxes around their projections are too far apart.  Within
a pair of blocks, intervals of the sequence are halved again and again; halves whose boxes
are too far apart are skipped, and small ones are compared by a matrix product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.components import components
from yearloom.session import store

COSINE = 0.93
AXES = 8  # leading directions that boxes are kept for
SORTED = 4  # of these, the ones that vectors are sorted by
BLOCK = 2048  # vectors; a block is sent to every block that it may be near to
LEAF = 128  # vectors of an interval that is compared as a whole
SLACK = 1e-9  # for rounding, where distances only rule pairs out


def _units(vectors: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length one in double precision; None for those that link with nothing."""
    out = []
    for row in vectors:
        unit = None
        if row.is_valid and len(row.values) and row.values.null_count == 0:
            x = np.asarray(row.values, np.float64)
            top = float(np.abs(x).max())
            if 0 < top < math.inf:
                x = x / top  # keeps the squares of very large and small parts in range
                unit = x / math.sqrt(float(x @ x))
        out.append(unit)
    return out


def _unit_bytes(vectors: pa.Array) -> pa.Array:
    return pa.array([None if u is None else u.tobytes() for u in _units(vectors)], pa.binary())


def _products(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Of one task, the rows, their sum and the sum of their products."""
    total = np.zeros(1 + size + size * size)
    for batch in batches:
        x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float64).reshape(-1, size)
        total += np.concatenate([[len(x)], x.sum(0), (x.T @ x).reshape(-1)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"]
    )


def principal_axes(units: DataFrame, size: int) -> np.ndarray:
    """The leading directions of all vectors of ``size`` parts, one in each column.

    Tasks sum up products and Spark adds them; the driver gets about ``size`` squared values.
    """
    sums = (
        units.where(F.octet_length("unit") == 8 * size)
        .select("unit")
        .mapInArrow(lambda batches: _products(batches, size), "place long, value double")
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
    )
    total = np.zeros(1 + size + size * size)
    for row in sums.collect():
        total[row["place"]] = row["value"]
    n = max(1.0, total[0])
    mean = total[1 : 1 + size] / n
    spread = total[1 + size :].reshape(size, size) / n - np.outer(mean, mean)
    return np.linalg.eigh(spread)[1][:, ::-1][:, :AXES]


def _projected(unit: bytes, axes: np.ndarray | None) -> np.ndarray:
    x = np.frombuffer(unit, np.float64)
    y = x @ axes if axes is not None and len(x) == len(axes) else x[:AXES]
    return np.concatenate([y, np.zeros(AXES - len(y))])


def _blocks(batches: Iterator[pa.RecordBatch], axes: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Cuts the sorted rows of a task into blocks of one label and one number of parts."""
    number = TaskContext.get().partitionId() << 32
    held: list[tuple[int, int, bytes]] = []
    at = None

    def block() -> pa.RecordBatch:
        nonlocal number
        y = np.stack([_projected(u, axes) for _, _, u in held])
        row = {
            "block": number, "label": at[0], "parts": at[1],
            "low": y.min(0).tolist(), "high": y.max(0).tolist(),
            "ids": [i for i, _, _ in held], "copies": [n for _, n, _ in held],
            "units": b"".join(u for _, _, u in held), "places": y.tobytes(),
        }
        number += 1
        held.clear()
        return pa.RecordBatch.from_pylist([row], _SCHEMA)

    for batch in batches:
        for label, i, n, unit in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if held and (len(held) == BLOCK or at != (label, len(unit))):
                yield block()
            at = (label, len(unit))
            held.append((i, n, unit))
    if held:
        yield block()


_SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("label", pa.string()), ("parts", pa.int64()),
        ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
        ("ids", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())),
        ("units", pa.binary()), ("places", pa.binary()),
    ]
)
_BLOCKS = (
    "block long, label string, parts long, low array<double>, high array<double>, "
    "ids array<long>, copies array<long>, units binary, places binary"
)


def _near(x, y, xs, ys, cosine: float) -> np.ndarray:
    """Which vectors of two sequences are linked; ``xs`` and ``ys`` are their projections."""
    out = np.zeros((len(x), len(y)), bool)
    reach = 2 - 2 * cosine + SLACK
    work = [(0, len(x), 0, len(y))]
    while work:
        a, b, c, d = work.pop()
        gap = np.maximum(xs[a:b].min(0) - ys[c:d].max(0), ys[c:d].min(0) - xs[a:b].max(0))
        if (np.maximum(gap, 0) ** 2).sum() > reach:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            out[a:b, c:d] = x[a:b] @ y[c:d].T >= cosine
        elif b - a >= d - c:
            work += [(a, (a + b) // 2, c, d), ((a + b) // 2, b, c, d)]
        else:
            work += [(a, b, c, (c + d) // 2), (a, b, (c + d) // 2, d)]
    return out


def _labels(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a table of links, the number of their component."""
    n, m = near.shape
    rows, columns = np.arange(n), np.full(m, n + m)
    r, c = np.nonzero(near)
    while True:
        before = rows.copy()
        np.minimum.at(columns, c, rows[r])
        np.minimum.at(rows, r, columns[c])
        rows = np.minimum(rows, rows[rows])
        if (rows == before).all():
            return rows, columns


def _pair(table: pa.Table, cosine: float) -> pa.Table:
    """Of each linked vector of two blocks: how many it is linked to, and one it reaches."""
    sides = table.to_pylist()
    parts = sides[0]["parts"] // 8
    first, second = sides[0], sides[-1]
    x, y = (np.frombuffer(s["units"], np.float64).reshape(-1, parts) for s in (first, second))
    xs, ys = (np.frombuffer(s["places"], np.float64).reshape(-1, AXES) for s in (first, second))
    near = _near(x, y, xs, ys, cosine)
    ids, copies = (np.array(first["ids"]), np.array(second["ids"])), (np.array(first["copies"]), np.array(second["copies"]))
    if len(sides) == 1:
        near |= near.T
        np.fill_diagonal(near, True)  # row k and column k are the same vector
    rows, columns = _labels(near)
    if len(sides) == 1:
        np.fill_diagonal(near, False)
    found = []
    r, c = np.nonzero(near)
    counts = np.bincount(r, copies[1][c], near.shape[0]).astype(np.int64)
    linked = counts > 0
    found.append((ids[0][linked], counts[linked], ids[0][rows[linked]]))
    if len(sides) == 2:
        counts = np.bincount(c, copies[0][r], near.shape[1]).astype(np.int64)
        linked = counts > 0
        found.append((ids[1][linked], counts[linked], ids[0][columns[linked]]))
    return pa.table(
        {name: pa.array(np.concatenate(v), pa.int64()) for name, v in zip(("id", "n", "root"), zip(*found, strict=True), strict=True)}
    )


def _apart(i: str, j: str):
    """Square of the distance of the boxes of two blocks."""
    gaps = [
        F.greatest(
            F.lit(0.0),
            F.col(f"{i}.low")[k] - F.col(f"{j}.high")[k],
            F.col(f"{j}.low")[k] - F.col(f"{i}.high")[k],
        )
        for k in range(AXES)
    ]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])


def find(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """One row per input row: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Two vectors of the same label, not null, and of as many parts are linked if their cosine
    is at least ``cosine``.  Vectors that are null, empty or zero, or hold a null or
    non-finite part, link with nothing.  ``n_links`` counts the other vectors linked
    directly; ``component_id`` is the smallest key that links reach, the row's own included.

    Keys are whole numbers.  Rows that share a key are one vertex, whose links are added
    up.  A row without a key links with nothing: it has no component and is kept.
    """
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.arrow_udf(_unit_bytes, "binary")(F.col(f"`{vector}`").cast("array<double>")).alias("unit"),
    )
    rows = store(rows, "grid-vectors")
    known = rows.where("id is not null and label is not null and unit is not null")
    # Equal vectors are compared once, for all their copies.
    classes = known.groupBy("label", "unit").agg(
        F.min("id").alias("class"), F.count(F.lit(1)).alias("copies")
    )
    classes = store(classes, "grid-classes")
    common = (
        classes.groupBy(F.octet_length("unit").alias("size")).count().orderBy(F.desc("count"), "size").first()
    )
    axes = principal_axes(classes, common["size"] // 8) if common else None

    width = math.sqrt(2 - 2 * cosine + SLACK)

    def cells(units: pa.Array) -> pa.Array:
        found = [np.floor(_projected(u, axes)[:SORTED] / width).astype(int).tolist() for u in units.to_pylist()]
        return pa.array(found, pa.list_(pa.int32()))

    placed = classes.withColumn("cells", F.arrow_udf(cells, "array<int>")("unit"))
    order = ["label", F.octet_length("unit"), *(F.col("cells")[k] for k in range(SORTED)), "class"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("label", "class", "copies", "unit")
    blocks = store(placed.mapInArrow(lambda batches: _blocks(batches, axes), _BLOCKS), "grid-blocks")

    # A block meets the blocks whose first cells are its own or next to them.
    boxes = blocks.select("block", "label", "parts", "low", "high")
    cell = lambda side: F.floor(F.col(side)[0] / width)
    here = boxes.withColumn("cell", F.explode(F.sequence(cell("low"), cell("high"))))
    there = boxes.withColumn("cell", F.explode(F.sequence(cell("low") - 1, cell("high") + 1)))
    pairs = here.alias("i").join(
        there.alias("j"),
        (F.col("i.label") == F.col("j.label"))
        & (F.col("i.parts") == F.col("j.parts"))
        & (F.col("i.cell") == F.col("j.cell"))
        & (F.col("i.block") <= F.col("j.block"))
        & (_apart("i", "j") <= width * width),
    )
    pairs = pairs.select(F.col("i.block").alias("i"), F.col("j.block").alias("j")).distinct()
    sides = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    work = sides.join(blocks.select("block", "parts", "ids", "copies", "units", "places"), "block")
    found = work.groupBy("i", "j").applyInArrow(lambda t: _pair(t, cosine), "id long, n long, root long")
    found = store(found, "grid-links")

    counts = found.groupBy("id").agg(F.sum("n").alias("near"))
    ends = components(
        found.select("id", "root").unionByName(
            known.join(classes, ["label", "unit"]).where("id != class").select("id", F.col("class").alias("root"))
        )
    )
    own = known.join(classes, ["label", "unit"]).join(counts, F.col("class") == counts["id"], "left")
    own = own.groupBy(known["id"].alias("own")).agg(
        F.sum(F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    result = rows.select("id").join(own, F.col("id") == F.col("own"), "left")
    result = result.join(ends, F.col("id") == F.col("vertex"), "left")
    component = F.coalesce("component", "id")
    return result.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
