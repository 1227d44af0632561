"""Benchmark passages in training documents, found with suffix arrays of the documents.

Each task cuts its documents into shards and turns their words into numbers: the number of
the word in the benchmark, or 0.  The suffix array of a shard holds its word suffixes in
order, compared as far as a benchmark window reaches; suffixes that begin with words no
window begins with are left out, since no search can end there.  Every benchmark window,
the start of a test suffix, is then looked up by binary search; the places found are
extended to the longest verbatim match.
"""

from __future__ import annotations

import functools
import uuid
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from yearloom.llm.common import WORDS, pieces
from yearloom.session import store

WINDOW = 10  # words
BLOCK_BYTES = 16 * 1024 * 1024  # benchmark text searched for at a time
SHARD_BYTES = 4 * 1024 * 1024  # document text in one suffix array
MOST_ITEMS = 250_000  # items named in one batch of rows, or a single row

_FOUND = (
    "struct<n_words:bigint,hits:array<struct<first:int,past:int>>,items:array<string>,"
    "longest:int,longest_at:int,longest_item:string>"
)
_KIND = pa.struct(
    [
        ("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
        ("items", pa.list_(pa.string())), ("longest", pa.int32()), ("longest_at", pa.int32()),
        ("longest_item", pa.string()),
    ]
)


class Tests:
    """The windows of a block of benchmark items, packed for binary search."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        flat, starts, lengths, owners = array("q"), [], [], []
        for name, text in items:
            words = WORDS(text.lower())
            size = min(window, len(words))
            for start in range(len(words) - size + 1 if words else 0):
                starts.append(len(flat) + start)
                lengths.append(size)
                owners.append(number[name])
            flat.extend(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
            flat.append(0)
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.per_key = max(1, 62 // self.bits)
        self.flat = np.array(flat, np.int64)
        starts, lengths, owners = (np.array(x, np.int64) for x in (starts, lengths, owners))
        # By length: the keys of the different windows, where one stands, the number of their
        # set of items, and the first of it.
        self.groups = []
        self.sets: list[np.ndarray] = []
        known: dict[bytes, int] = {}
        for size in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == size)
            keys = self.keys(self.flat, starts[own], size)
            _, first, inverse = np.unique(
                np.stack(keys, 1), axis=0, return_index=True, return_inverse=True
            )
            pairs = np.unique(np.stack([inverse.reshape(-1), owners[own]], 1), axis=0)
            ends = np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
            sets = np.zeros(len(first), np.int64)
            for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                members = pairs[a:b, 1].tobytes()
                sets[k] = known.setdefault(members, len(known))
                if len(known) > len(self.sets):
                    self.sets.append(np.frombuffer(members, np.int64))
            self.groups.append(
                (size, [k[first] for k in keys], starts[own][first], sets, pairs[ends[:-1], 1])
            )

    def items(self, sets: list[int]) -> list[str]:
        """The names of the items in any of the sets."""
        if not sets:
            return []
        members = np.unique(np.concatenate([self.sets[k] for k in sets]))
        return [self.names[k] for k in members.tolist()]

    def keys(self, words: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
        """The words from each place on, some to a key, so that keys compare as suffixes do."""
        padded = np.concatenate([words, np.zeros(size, np.int64)])
        out = []
        for start in range(0, size, self.per_key):
            key = np.zeros(len(at), np.int64)
            for k in range(start, min(start + self.per_key, size)):
                key = (key << self.bits) | padded[at + k]
            out.append(key)
        return out


def _bounds(sorted_keys: list[np.ndarray], wanted: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of all windows at once: where each begins and ends in the suffix array."""

    def search(after: bool) -> np.ndarray:
        low = np.zeros(len(wanted[0]), np.int64)
        high = np.full(len(low), len(sorted_keys[0]), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            less = np.zeros(len(open_), bool)
            same = np.ones(len(open_), bool)
            for have, want in zip(sorted_keys, wanted, strict=True):
                a, b = have[middle], want[open_]
                less |= same & (a < b)
                same &= a == b
            go = less | same if after else less
            low[open_[go]] = middle[go] + 1
            high[open_[~go]] = middle[~go]
        return low

    return search(False), search(True)


def _longer(tests: Tests, words: np.ndarray, at: np.ndarray, test: np.ndarray, size: int) -> np.ndarray:
    """Words of the longest match from each place, of which ``size`` are known to be equal."""
    length = np.full(len(at), size, np.int64)
    open_ = np.arange(len(at))
    while open_.size:
        a, b = at[open_] + length[open_], test[open_] + length[open_]
        inside = (a < len(words)) & (b < len(tests.flat))
        open_, a, b = open_[inside], a[inside], b[inside]
        open_ = open_[(words[a] == tests.flat[b]) & (words[a] > 0)]
        length[open_] += 1
    return length


def _shard(tests: Tests, texts: list[bytes]) -> list[dict]:
    """What each text of a shard shares with the tests; for items, the numbers of their sets."""
    flat, starts, counts = array("q"), [], []
    get = tests.vocabulary.get
    for text in texts:
        words = WORDS(text.lower())
        starts.append(len(flat))
        counts.append(len(words))
        flat.extend(map(get, words, repeat(0)))
        flat.append(0)
    words, first = np.frombuffer(flat, np.int64), np.array(starts, np.int64)
    rows = [
        {"n_words": n, "hits": [], "items": [], "longest": 0, "longest_at": None, "longest_item": None}
        for n in counts
    ]
    hits, owners, best = [], [], []
    known = np.flatnonzero(words)
    for size, keys, starts_of, sets, items in tests.groups:
        lead = min(size, tests.per_key)
        prefix = tests.keys(words, known, lead)[0]
        wanted = np.unique(keys[0])
        slot = np.searchsorted(wanted, prefix)
        slot[slot == len(wanted)] = 0
        suffixes = known[wanted[slot] == prefix]
        if not suffixes.size:
            continue
        own = tests.keys(words, suffixes, size)
        order = np.lexsort(own[::-1])
        suffixes, own = suffixes[order], [k[order] for k in own]
        low, high = _bounds(own, keys)
        found = high - low
        window = np.repeat(np.arange(len(found)), found)
        if not window.size:
            continue
        places = suffixes[np.arange(len(window)) - np.repeat(np.cumsum(found) - found, found) + low[window]]
        hits.append(np.stack([places, places + size], 1))
        doc = np.searchsorted(first, places, "right") - 1
        owners.append(np.unique(np.stack([doc, sets[window]], 1), axis=0))
        length = _longer(tests, words, places, starts_of[window], size)
        best.append(np.stack([doc, -length, places, items[window]], 1))
    if not hits:
        return rows
    spans = np.concatenate(hits)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    past = np.concatenate([reach[new[1:] - 1], reach[-1:]])
    docs = np.searchsorted(first, spans[new, 0], "right") - 1
    for d, a, b in zip(docs.tolist(), spans[new, 0].tolist(), past.tolist(), strict=True):
        rows[d]["hits"].append({"first": a - starts[d], "past": b - starts[d]})
    for d, number in np.unique(np.concatenate(owners), axis=0).tolist():
        rows[d]["items"].append(number)
    best = np.concatenate(best)
    best = best[np.lexsort(best.T[::-1])]
    for d, length, at, item in best[np.unique(best[:, 0], return_index=True)[1]].tolist():
        rows[d] |= {"longest": -length, "longest_at": at - starts[d], "longest_item": tests.names[item]}
    return rows


@functools.lru_cache(maxsize=1)
def _tests(key: str, window: int, shared: Broadcast) -> Tests:
    """Built once per worker process and block."""
    return Tests(shared.value, window)


def _named(tests: Tests, rows: list[dict], named: bool) -> Iterator[tuple[int, list[dict]]]:
    """The rows with their items' names, or none, and the place of the first, some at a time."""
    start, size = 0, 0
    own: list[dict] = []
    for i, row in enumerate(rows):
        own.append(row | {"items": tests.items(row["items"]) if named else []})
        size += len(own[-1]["items"])
        if size >= MOST_ITEMS:
            yield start, own
            start, size, own = i + 1, 0, []
    if own:
        yield start, own


def _searched(
    df: DataFrame, text: str, found: str, items: list[tuple[str, bytes]], window: int, named: bool, merge: bool
) -> DataFrame:
    """``df`` with what a block of the benchmark finds, merged with what the last ones found."""
    shared, key = df.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    others = [f for f in df.schema.fields if f.name != found]
    schema = StructType([*others, StructField(found, DataType.fromDDL(_FOUND))])
    names, many = [f.name for f in schema.fields], len(others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = _tests(key, window, shared)
        for batch in batches:
            for first, texts in pieces(batch.column(batch.num_columns - 1), SHARD_BYTES):
                for start, rows in _named(tests, _shard(tests, texts), named):
                    part = batch.slice(first + start, len(rows))
                    if merge:
                        rows = list(map(_merged, part.column(many).to_pylist(), rows))
                    yield pa.RecordBatch.from_arrays([*part.columns[:many], pa.array(rows, _KIND)], names)

    hidden = F.col(f"`{text}`").cast("string").alias(f"__text_{key}")
    old = [F.col(f"`{found}`")] if merge else []
    rows = df.select(*[f"`{f.name}`" for f in others], *old, hidden).mapInArrow(run, schema)
    return rows.select(*[f"`{c}`" for c in [*df.columns, *([] if found in df.columns else [found])]])


def _merged(old: dict | None, new: dict) -> dict:
    """What two blocks of the benchmark found in the same document."""
    if old is None:
        return new
    spans = sorted((s["first"], s["past"]) for s in old["hits"] + new["hits"])
    hits: list[list[int]] = []
    for a, b in spans:
        if hits and a <= hits[-1][1]:
            hits[-1][1] = max(hits[-1][1], b)
        else:
            hits.append([a, b])
    longer = max(old, new, key=lambda r: r["longest"])
    return longer | {
        "hits": [{"first": a, "past": b} for a, b in hits],
        "items": sorted({*old["items"], *new["items"]}),
    }


def find(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    found: str = "found",
    named: bool = True,
) -> DataFrame:
    """Add what each whole text shares with the benchmark, as one struct column.

    ``n_words``; ``hits``, the word spans [first, past) inside occurrences of a window;
    ``items``, the sorted ids of items with an occurring window; and the longest verbatim
    match: its words, first word and item.  A window is ``window`` consecutive words of an
    item; an item of fewer words is one window, one without words none.

    Null and empty texts have no words and no hits.  Items without an id count under the
    empty id, repeated ids as one item.  Without items nothing is hit.  Every row is kept;
    other columns are untouched and a column of the name ``found`` is replaced.

    The benchmark is searched for in blocks of about ``BLOCK_BYTES`` of text; only one
    block at a time is in the memory of the driver and of a worker.  (A single item beyond
    that size is a block of its own.)  The items of a document are named when its row is
    written; with ``named`` off the lists of items stay empty.
    """
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("words"),
    ).distinct()  # rows that are repeated would all be in one block
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES) or 1
    block = F.pmod(F.xxhash64("name", "words"), F.lit(count))
    for k in range(count):
        own = [(r["name"], r["words"].encode()) for r in items.where(block == k).collect()]
        df = _searched(store(df, "decontaminate") if k else df, text, found, own, window, named, k > 0)
    return df


def hit_words(found: str = "found"):
    """The number of words inside occurrences, from the column that ``find`` adds."""
    return F.aggregate(
        F.col(f"`{found}`.hits"), F.lit(0).cast("long"), lambda n, s: n + (s["past"] - s["first"])
    )


def remove(df: DataFrame, benchmark: DataFrame, text: str = "text", **named) -> DataFrame:
    """The documents without any benchmark window, with their columns as they were."""
    found = f"found_{uuid.uuid4().hex}"
    rows = find(df, benchmark, text=text, found=found, **{"named": False} | named)
    return rows.where(F.size(f"{found}.hits") == 0).drop(found)
