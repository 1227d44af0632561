"""Near copies of documents by circulant MinHash, banding, and exact verification.

1. Each text becomes its set of word shingles, a digest of the set, and one key per band
   of its signature.  Documents with equal sets are one class from here on.
2. Classes that share a key are candidates.  Each key has a leader, and every class is
   compared with the leaders of its keys: as many comparisons as rows, not as pairs.
3. Where the classes of a key do not all end up linked to each other, those outside the
   key's largest component are compared with all others of the key, in blocks.
4. Components of all confirmed links.

Links are confirmed on the full sets, 64 bits for each shingle.  A pair of similarity
s has a key in common with probability 1 - (1 - s^rows)^bands: 0.999997 at s = 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.common import pieces
from yearloom.llm.components import components
from yearloom.llm.shingles import Circulant, shingles
from yearloom.session import store

SHINGLE = 5  # words
SIMILAR = 80  # hundredths of the union
BANDS, ROWS = 24, 4
ORDERS = 4  # different choices of leaders
MEMBERS = 512  # classes compared with one copy of a leader
OUTSIDERS, OTHERS = 512, 2048  # classes of a block, at most about
BLOCK_SHINGLES = 2_000_000
MATRIX_ROWS = 2048


def _sketches(texts: pa.Array, size: int) -> pa.Array:
    circulant = Circulant(BANDS, ROWS)
    counts, digests, keys = [], [], []
    for _, part in pieces(texts):
        for text in part:
            found = shingles(text, size)
            counts.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            keys.append(circulant.keys(circulant.signature(found)) if len(found) else None)
    ends = np.concatenate([[0], np.cumsum([0 if k is None else len(k) for k in keys])])
    flat = np.concatenate([np.zeros(0, np.int64), *(k for k in keys if k is not None)])
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), lists], ["n", "digest", "keys"]
    )


def _sets(texts: pa.Array, size: int) -> pa.Array:
    return pa.array(
        [shingles(t, size).tobytes() for _, part in pieces(texts) for t in part], pa.binary()
    )


def _similar(shared, a, b, hundredths: int):
    return 100 * shared >= hundredths * (a + b - shared)


def _linked(one: np.ndarray, other: np.ndarray, hundredths: int) -> bool:
    small, large = sorted((one, other), key=len)
    if 100 * len(small) < hundredths * len(large):
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return _similar(int((large[place] == small).sum()), len(small), len(large), hundredths)


def _stars(batches: Iterator[pa.RecordBatch], hundredths: int) -> Iterator[pa.RecordBatch]:
    """Compares rows with the leader that stands before them; one leader is kept at a time."""
    at, own = None, []
    for batch in batches:
        links = ([], [])
        for group, salt, member, is_leader, content in zip(
            *(batch.column(k).to_pylist() for k in range(4)), batch.column(4), strict=True
        ):
            found = np.frombuffer(content.as_buffer(), np.uint64)
            if is_leader:
                own = [*own, found] if at == (group, salt) else [found]
                at = (group, salt)
            elif at == (group, salt) and any(_linked(found, x, hundredths) for x in own):
                links[0].append(member)
                links[1].append(group)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links], ["a", "b"])


def _shared_counts(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of some sets (``rows``) with all, by products of matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = counts[number] > 1  # what stands in one set is shared by none
    number, owner = number[often], owner[often]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    number = np.cumsum(np.concatenate([[False], number[1:] != number[:-1]])) if len(number) else number
    out = np.zeros((len(rows), len(sets)), np.float64)
    last = int(number[-1]) + 1 if len(number) else 0
    for start in range(0, last, MATRIX_ROWS):
        low, high = np.searchsorted(number, [start, start + MATRIX_ROWS])
        matrix = np.zeros((MATRIX_ROWS, len(sets)), np.float32)
        matrix[number[low:high] - start, owner[low:high]] = 1
        out += matrix[:, rows].T @ matrix
    return out


def _block(block: pa.Table, hundredths: int) -> pa.Table:
    """Links between the outsiders of a block and all its members, one per pair of components."""
    labels = np.array(block.column("label").to_pylist(), np.int64)
    rows = np.flatnonzero(np.array(block.column("outside").to_pylist(), bool))
    sets = [np.frombuffer(content.as_buffer(), np.uint64) for content in block.column("content")]
    sizes = np.array([len(s) for s in sets], np.float64)
    if not len(rows):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    shared = _shared_counts(sets, rows)
    near = _similar(shared, sizes[rows][:, None], sizes[None, :], hundredths)
    near &= labels[rows][:, None] != labels[None, :]
    a, b = np.nonzero(near)
    low, high = np.minimum(labels[rows[a]], labels[b]), np.maximum(labels[rows[a]], labels[b])
    pairs = np.unique(np.stack([low, high], 1), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _leaders(sketches: DataFrame) -> DataFrame:
    """Rows (key, id, leader, size) of the classes that share a key with another class."""
    rows = sketches.select("id", F.explode("keys").alias("key"))
    # The leader is chosen by comparing flipped bits, in one of a few orders: a plain minimum
    # of a number, which is aggregated before rows are shuffled.
    flip = F.xxhash64(F.lit(17), F.pmod("key", F.lit(ORDERS)))
    keys = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.col("id").bitwiseXOR(flip)).alias("flipped")
    )
    keys = keys.where("size > 1").select("key", "size", F.col("flipped").bitwiseXOR(flip).alias("leader"))
    return rows.join(keys, "key")


def _star_links(shared: DataFrame, sets: DataFrame, hundredths: int) -> DataFrame:
    pairs = shared.where("id != leader").select("leader", "id").distinct()
    pairs = store(pairs, "near-pairs")
    copies = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("copies"))
    members = pairs.join(copies, "leader").select(
        "leader", F.pmod(F.xxhash64("id"), F.col("copies")).alias("salt"), "id", F.lit(False).alias("first")
    )
    leaders = copies.select(
        "leader",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"),
        F.col("leader").alias("id"),
        F.lit(True).alias("first"),
    )
    rows = members.unionByName(leaders).join(sets, "id")
    rows = rows.select("leader", "salt", "id", "first", "content").repartition("leader", "salt")
    rows = rows.sortWithinPartitions("leader", "salt", F.desc("first"))
    return rows.mapInArrow(lambda batches: _stars(batches, hundredths), "a long, b long")


def _rest_links(shared: DataFrame, labels: DataFrame, sets: DataFrame, hundredths: int) -> DataFrame:
    """Links between the components of a key that its leader does not connect."""
    rows = shared.where("size > 2").join(labels, F.col("id") == F.col("vertex"), "left")
    rows = rows.select("key", "id", F.coalesce("component", "id").alias("label"))
    rows = store(rows.join(sets.select("id", "n"), "id"), "near-rest")
    parts = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    keys = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("labels"),
        F.sum("c").alias("all_c"), F.sum("s").alias("all_s"),
        F.max(F.struct("c", "s", "label")).alias("main"),
    ).where("labels > 1")

    def blocks(count, size, most):
        return F.ceil(F.greatest(count / F.lit(most), size / F.lit(BLOCK_SHINGLES)))

    keys = keys.select(
        "key",
        F.col("main.label").alias("main"),
        blocks(F.col("all_c") - F.col("main.c"), F.col("all_s") - F.col("main.s"), OUTSIDERS).alias("us"),
        blocks(F.col("all_c"), F.col("all_s"), OTHERS).alias("xs"),
    )
    rows = rows.join(keys, "key").withColumn("is_main", F.col("label") == F.col("main"))
    place = F.xxhash64("id")
    others = rows.select(
        "key", "id", "label", F.lit(False).alias("outside"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("us") - 1)).alias("u"),
        F.pmod(place, F.col("xs")).alias("x"),
    )
    outside = rows.where(~F.col("is_main")).select(
        "key", "id", "label", F.lit(True).alias("outside"),
        F.pmod(place, F.col("us")).alias("u"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("xs") - 1)).alias("x"),
    )
    grouped = others.unionByName(outside).join(sets.select("id", "content"), "id")
    return grouped.groupBy("key", "u", "x").applyInArrow(
        lambda block: _block(block, hundredths), "a long, b long"
    )


def find(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    hundredths: int = SIMILAR,
) -> DataFrame:
    """One row per input row: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Two texts are linked if their sets of ``size``-word shingles have ``100 * intersection
    >= hundredths * union``.  A text of fewer words has one shingle; null, empty and
    white-space texts have none and link with nothing.  ``component_id`` is the smallest
    key that links reach, the row's own included.

    Keys are whole numbers.  Rows that share a key are one vertex of the graph, linked
    where any of them is.  A row without a key links with nothing: it has no component
    and is kept.  An empty table gives an empty result.
    """
    docs = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    sketch = F.arrow_udf(
        lambda texts: _sketches(texts, size), "struct<n:bigint,digest:binary,keys:array<bigint>>"
    )
    docs_sketched = docs.select("id", sketch("text").alias("s")).select("id", "s.*")
    sketches = store(docs_sketched, "near-sketches")

    known = sketches.where("id is not null and n > 0")
    classes = known.groupBy("digest").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("rows"))
    classes = store(classes, "near-classes")
    ones = known.join(classes.select("digest", F.col("class").alias("id")), ["digest", "id"], "left_semi")
    ones = ones.dropDuplicates(["digest"]).select("id", "keys")
    shared = store(_leaders(ones), "near-keys")

    wanted = shared.select("id").distinct()
    # Not to be moved or repeated by the optimizer, which would make each set twice.
    content = F.arrow_udf(lambda texts: _sets(texts, size), "binary").asNondeterministic()
    # A key that several texts share is one class with all their sets.
    # Keys of a share of all rows: beyond small tables they are always merged with the texts.
    chosen = docs.join(wanted.hint("merge"), "id", "left_semi").select("id", content("text").alias("content"))
    chosen = chosen.select("id", "content", (F.octet_length("content") / 8).cast("long").alias("n"))
    sets = store(chosen.where("n > 0"), "near-sets")

    links = store(_star_links(shared, sets, hundredths), "near-links")
    # Documents with equal sets are linked by their class; keys of several texts join classes.
    same = known.join(classes.where("rows > 1"), "digest").select("id", "class").where("id != class")
    first = components(links)
    rest = store(_rest_links(shared, first, sets, hundredths), "near-links")
    joined = first.select(F.col("vertex").alias("a"), F.col("component").alias("b")).unionByName(rest)
    joined = joined.unionByName(same.select(F.col("id").alias("a"), F.col("class").alias("b")))
    labels = components(joined)
    result = sketches.select("id", "n").join(labels, F.col("id") == F.col("vertex"), "left")
    component = F.coalesce("component", "id")
    return result.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
