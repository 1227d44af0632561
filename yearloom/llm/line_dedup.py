"""Removal of passages of lines that stand in several places.

1. Lines are grouped to content-defined chunks: a rolling hash over the hashes of neighbouring
   lines puts a boundary wherever it is smaller than at a gap beside it, and a line of some words is a
   chunk of its own.  Lines put in or left out elsewhere move no boundary.
2. From every chunk on, the shortest run of chunks that makes a passage is an anchor if it stands more than once.
   The first place of an anchor is its keeper.  From every other place the run is
   extended line by line, both ways, as long as both texts are equal.  That gives an extent: a passage
   that stands in the keeper as well.  Runs that begin inside an extent with the same keeper are not extended again.
3. Each line of an extent is owed to the extent with the first keeper, and goes.  What is owed to a keeper
   stays there, whatever the keeper itself could lose.  So everything that goes stands in the result,
   what an extent loses in one piece.
4. A passage may end up cut in all its places, where different keepers meet.  Short windows of
   lines at such cuts are therefore compared too, and the first place of a repeated one stays as it is.

Lines are compared by hashes; all lines that go, and those they are owed to, are
then compared byte by byte, and hashes that different lines share count as unequal.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.common import pieces
from yearloom.operators.joins import ROWS, size_checked_join
from yearloom.session import store

LONG_LINE = 5  # words of a line that is a chunk of its own
LINES, WORDS = 2, 20  # least lines, and words, of a passage
MANY_WORDS = 50  # words of a passage of a single line
ROWS_AT_ONCE = 256
REACH = 1000  # lines that an extent goes beyond the outermost anchors with its keeper

_hash = xxhash.xxh3_64_intdigest
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and numbers of words of the lines that hold words; other lines do not count."""
    hashes, words = array("Q"), array("i")
    for line in text.split(b"\n"):
        if count := len(line.split()):
            hashes.append(_hash(line))
            words.append(count)
    return np.frombuffer(hashes, np.uint64), np.frombuffer(words, np.int32)


def chunks(hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first line of each chunk, and the line after its last one."""
    n = len(hashes)
    if not n:
        return np.zeros(0, int), np.zeros(0, int)
    with np.errstate(over="ignore"):
        rolled = hashes[:-1] * _MULTIPLIER + hashes[1:]
    # Of two gaps next to each other the one with the smaller hash is a boundary.
    smaller = rolled[:-1] <= rolled[1:]
    boundary = np.zeros(n - 1, bool)
    boundary[:-1] |= smaller
    boundary[1:] |= ~smaller
    long = words >= LONG_LINE
    boundary |= long[:-1] | long[1:]
    starts = np.r_[0, np.flatnonzero(boundary) + 1]
    return starts, np.r_[starts[1:], n]


def is_passage(lines: int, words: int) -> bool:
    return lines >= LINES and words >= WORDS or words >= MANY_WORDS


def runs(hashes: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, int]]:
    """First line and line after the last of the anchors.

    From each chunk on, the shortest run of chunks with the words of a passage; if that is a single
    line, also the run with the next chunk.  A passage of over 50 words always holds one, as
    chunks of several lines have two lines of less than ``LONG_LINE`` words.
    """
    starts, ends = chunks(hashes, words)
    total = np.r_[0, np.cumsum(words)]
    last = np.searchsorted(total[ends], total[starts] + WORDS)
    starts, ends, last = starts.tolist(), ends.tolist(), last.tolist()
    for start, k in zip(starts, last, strict=True):
        if k < len(ends):
            yield start, ends[k]
            if k + 1 < len(ends) and not is_passage(ends[k] - start, int(total[ends[k]] - total[start])):
                yield start, ends[k + 1]


def _sequences(texts: pa.Array) -> pa.Array:
    """Per text the hashes and words of its lines, and the hash and first line of its anchors."""
    lines, words, counts, hashes, places = [], [], [0], array("Q"), array("i")
    for _, part in pieces(texts):
        for text in part:
            own, count = line_hashes(text)
            for start, end in runs(own, count):
                hashes.append(_hash(own[start:end].tobytes()))
                places.append(start)
            lines.append(own.tobytes())
            words.append(count.tobytes())
            counts.append(len(hashes))
    rows = pa.StructArray.from_arrays(
        [pa.array(np.frombuffer(hashes, np.int64)), pa.array(np.frombuffer(places, np.int32))], ["hash", "start"]
    )
    chunked = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows)
    return pa.StructArray.from_arrays(
        [pa.array(lines, pa.binary()), pa.array(words, pa.binary()), chunked], ["lines", "words", "anchors"]
    )


_SEQUENCES = "struct<lines:binary,words:binary,anchors:array<struct<hash:bigint,start:int>>>"


def _equal(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """How many values at the beginnings are the same."""
    n, done, step = min(len(a), len(b), max(0, most)), 0, 16
    while done < n:
        end = min(n, done + step)
        apart = a[done:end] != b[done:end]
        if apart.any():
            return done + int(apart.argmax())
        done, step = end, 2 * step
    return n


def extents(
    own: np.ndarray, words: np.ndarray, keeper: np.ndarray, anchors: list[tuple[int, int]], low: int = 0, same: bool = False
) -> Iterator[tuple[int, int, int]]:
    """First line here, first line there and number of lines of the passages equal to the keeper's.

    ``own`` and ``words`` are the lines here from ``low`` on, ``keeper`` all lines there.  ``anchors``
    are pairs of lines, here and there, with which equal runs begin.  In the ``same`` text a passage
    and its keeper do not overlap.
    """
    done = 0
    for s, t in sorted(anchors):
        if s < done or same and s <= t:
            continue
        at, room = s - low, s - t if same else len(keeper)
        after = _equal(own[at:], keeper[t:], room)
        before = _equal(own[:at][::-1], keeper[:t][::-1], room - after) if after else 0
        if is_passage(before + after, int(words[at - before : at + after].sum())):
            done = s + after
            yield s - before, t - before, before + after


def _lists(column: pa.Array) -> list[list[tuple[int, ...]]]:
    """The lists of structs of whole numbers in a column, as tuples."""
    ends = np.cumsum(pc.list_value_length(column).fill_null(0)).tolist()
    rows = list(zip(*(c.to_pylist() for c in column.flatten().flatten()), strict=True))
    return [rows[a:b] for a, b in zip([0, *ends], ends)]


def _numbers(content: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(content.as_buffer(), kind)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, as lists take much more room in Python than in Arrow."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _found(batches: Iterator[pa.RecordBatch], unequal: frozenset[int]) -> Iterator[pa.RecordBatch]:
    """Extents of rows with a text's lines (from ``low`` on), its anchors, and a keeper's lines."""
    odd = np.array(sorted(unequal), np.uint64)
    names = [x.split()[0] for x in _EXTENTS.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32()] * 3
    for batch in _parts(batches):
        out = []
        keys = [batch.column(c).to_pylist() for c in ("id", "digest", "keeper", "kept_digest")]
        rest = (batch.column(c) for c in ("lines", "words", "kept_lines"))
        for i, d, k, e, lines, words, kept, low, anchors in zip(
            *keys, *rest, batch.column("low").to_pylist(), _lists(batch.column("anchors")), strict=True
        ):
            own = _numbers(lines, np.uint64)
            if len(odd):
                own = np.where(np.isin(own, odd), ~own, own)
            found = extents(own, _numbers(words, np.int32), _numbers(kept, np.uint64), anchors, low, (i, d) == (k, e))
            out += [(i, d, k, e, *place) for place in found]
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


_EXTENTS = "id long, digest long, keeper long, kept_digest long, start int, there int, n int"


def owed(found: list[dict]) -> list[dict]:
    """Extents of a text without the lines that an extent with an earlier keeper has."""
    taken = np.zeros(max((e["start"] + e["n"] for e in found), default=0), bool)
    out = []
    for e in sorted(found, key=lambda e: (e["keeper"], e["kept_digest"], e["there"], e["start"], e["n"])):
        lines = slice(e["start"], e["start"] + e["n"])
        edges = np.flatnonzero(np.diff(np.r_[True, taken[lines], True].astype(np.int8))).tolist()
        taken[lines] = True
        out += [
            e | {"start": e["start"] + a, "there": e["there"] + a, "n": b - a}
            for a, b in zip(edges[::2], edges[1::2], strict=True)
        ]
    return out


_OWED = "array<struct<keeper:bigint,kept_digest:bigint,start:int,there:int,n:int>>"


def _owed_all(found: pa.Array) -> pa.Array:
    names = ("keeper", "kept_digest", "start", "there", "n")
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    kind, parts = pa.list_(pa.struct(list(zip(names, kinds, strict=True)))), []
    for start in range(0, len(found), ROWS_AT_ONCE):
        rows = [owed([dict(zip(names, e)) for e in own]) for own in _lists(found.slice(start, ROWS_AT_ONCE))]
        parts.append(pa.array(rows, kind))
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _marks(n: int, going: list[tuple], staying: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Per line the number of its extent (-1: none), and whether it goes."""
    extent = np.full(n, -1)
    for k, (start, many) in enumerate(going):
        extent[start : start + many] = k
    goes = extent >= 0
    for start, many in staying:
        goes[start : start + many] = False
    return extent, goes


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short runs of lines that their text would lose a part of, and that no one keeper has whole."""
    for batch in _parts(batches):
        out = []
        marked = (_lists(batch.column(c)) for c in ("going", "staying"))
        for i, lines, words, going, staying in zip(
            batch.column("id").to_pylist(), batch.column("lines"), batch.column("words"), *marked, strict=True
        ):
            own, words = _numbers(lines, np.uint64), _numbers(words, np.int32)
            n = len(own)
            extent, goes = _marks(n, going, staying)
            total, lost = np.r_[0, np.cumsum(words)], np.r_[0, np.cumsum(goes)]
            change = np.r_[0, np.cumsum(extent[1:] != extent[:-1])]
            starts = np.arange(n)
            ends = np.maximum(np.searchsorted(total, total[:-1] + WORDS), starts + LINES)
            starts, ends = starts[ends <= n], ends[ends <= n]
            whole = (extent[starts] >= 0) & (change[starts] == change[ends - 1])
            for s, e in zip(*(x[(lost[ends] > lost[starts]) & ~whole].tolist() for x in (starts, ends)), strict=True):
                out.append((_hash(own[s:e].tobytes()), i, s, e - s))
        hashes = np.array([r[0] for r in out], np.uint64).view(np.int64)
        columns = [pa.array(hashes), *(pa.array([r[k] for r in out], t) for k, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32())))]
        yield pa.RecordBatch.from_arrays(columns, ["hash", "id", "start", "n"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and bytes of the lines that go or are owed something."""
    for batch in _parts(batches):
        for first, part in pieces(batch.column(0)):
            rows = set()
            lists = (_lists(batch.column(k).slice(first, len(part))) for k in (1, 2))
            for text, going, staying in zip(part, *lists, strict=True):
                lines = [line for line in text.split(b"\n") if line.split()]
                for start, many in (*going, *staying):
                    rows.update((_hash(line), line) for line in lines[start : start + many])
            hashes = np.array([h for h, _ in rows], np.uint64).view(np.int64)
            columns = [pa.array(hashes), pa.array([c for _, c in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "content"])


def _cut(text: bytes, going: list[tuple], staying: list[tuple]) -> tuple[bytes, int, int]:
    """The text without its repeated passages, its number of lines and of lines that went."""
    lines = text.split(b"\n")
    full = [k for k, line in enumerate(lines) if line.split()]
    _, goes = _marks(len(full), going, staying)
    gone = np.zeros(len(lines), bool)
    gone[np.array(full, int)[goes]] = True
    kept, before = [], False
    for k, line in enumerate(lines):
        before = bool(gone[k]) if line.split() else before  # blank lines go along
        gone[k] = before
        if not before:
            kept.append(line)
    return b"\n".join(kept), len(lines), int(gone.sum())


def _cut_all(texts: pa.Array, going: pa.Array, staying: pa.Array) -> pa.Array:
    out, lines, gone = [], [], []
    for first, part in pieces(texts):
        lists = (_lists(x.slice(first, len(part))) for x in (going, staying))
        for text, go, stay in zip(part, *lists, strict=True):
            kept, many, removed = _cut(text, go, stay) if go else (text, text.count(b"\n") + 1, 0)
            out.append(kept.decode())
            lines.append(many)
            gone.append(removed)
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())],
        ["text", "lines", "gone"],
    )


_PLACE = "array<struct<start:int,n:int>>"
_PLACES = "2147483648BD"  # lines that one text may have


def _extents_of(sequences: DataFrame, unequal: frozenset[int]) -> DataFrame:
    """All extents of all texts; see ``_EXTENTS``."""
    places = sequences.select("id", "digest", F.inline("anchors"))
    # The first place as one number, the key and then the line, as such a minimum needs no sorting.
    place = F.expr(f"CAST(CAST(id AS DECIMAL(38,0)) * {_PLACES} + start AS DECIMAL(38,0))")
    again = places.groupBy("hash").agg(F.count(F.lit(1)).alias(ROWS), F.min(place).alias("place"))
    again = store(again.where(F.col(ROWS) > 1), "repeated-runs")
    there = F.expr(f"CAST(pmod(place, {_PLACES}) AS INT)").alias("there")
    keepers = again.select("hash", F.expr(f"(place - pmod(place, {_PLACES})) div {_PLACES}").alias("keeper"), there)
    own = size_checked_join(places, keepers, ["hash"], "inner", counts=again.select("hash", ROWS))
    own = own.where((F.col("id") != F.col("keeper")) | (F.col("start") != F.col("there")))
    anchor = F.collect_set(F.struct("start", "there")).alias("anchors")
    pairs = store(own.groupBy("id", "digest", "keeper").agg(anchor), "anchors")

    lines = sequences.select("id", "digest", "lines", "words")
    low = F.greatest(F.array_min("anchors")["start"] - REACH, F.lit(0))
    high = F.array_max("anchors")["start"] + REACH
    here = lines.join(pairs.hint("merge"), ["id", "digest"])
    piece = lambda c, width: F.substring(c, low * width + 1, (high - low) * width)
    here = here.select(
        "id", "digest", "keeper", "anchors", low.alias("low"), piece(F.col("lines"), 8).alias("lines"), piece(F.col("words"), 4).alias("words")
    )
    there = lines.select(F.col("id").alias("keeper"), F.col("digest").alias("kept_digest"), F.col("lines").alias("kept_lines"))
    counts = store(pairs.groupBy("keeper").agg(F.count(F.lit(1)).alias(ROWS)), "keeper-counts")
    there = there.join(counts.select("keeper").hint("merge"), "keeper", "left_semi")
    both = size_checked_join(here, there, ["keeper"], "inner", counts=counts)
    return both.mapInArrow(lambda batches: _found(batches, unequal), _EXTENTS)


def _marked(sequences: DataFrame, unequal: frozenset[int]) -> DataFrame:
    """Per text with any: the extents that are ``going``, and the places owed to others, ``staying``."""
    found = _extents_of(sequences, unequal).groupBy("id", "digest").agg(
        F.collect_set(F.struct("keeper", "kept_digest", "start", "there", "n")).alias("found")
    )
    going = found.select("id", "digest", F.arrow_udf(_owed_all, _OWED)("found").alias("going"))
    going = store(going, "extents")
    kept = going.select(F.inline("going")).groupBy(F.col("keeper").alias("id"), F.col("kept_digest").alias("digest"))
    kept = kept.agg(F.collect_set(F.struct(F.col("there").alias("start"), "n")).alias("staying"))
    both = going.select("id", "digest", F.expr(f"CAST(transform(going, e -> struct(e.start, e.n)) AS {_PLACE})").alias("going"))
    none = F.array().cast(_PLACE)
    both = both.join(kept, ["id", "digest"], "full")
    marked = both.select("id", "digest", F.coalesce("going", none).alias("going"), F.coalesce("staying", none).alias("staying"))
    return store(marked, "marks")


def _with_windows(marked: DataFrame, sequences: DataFrame) -> DataFrame:
    """Adds to what is ``staying`` the first place of every repeated window at a cut."""
    losing = marked.where(F.size("going") > 0).hint("merge")
    losing = sequences.select("id", "digest", "lines", "words").join(losing, ["id", "digest"])
    windows = losing.select("id", "lines", "words", "going", "staying").mapInArrow(_windows, "hash long, id long, start int, n int")
    place = F.min(F.struct("id", "start", "n")).alias("place")
    first = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("many"), place).where("many > 1")
    stays = first.select("place.*").groupBy("id").agg(F.collect_set(F.struct("start", "n")).alias("more"))
    joined = marked.join(stays, "id", "left")
    staying = F.concat("staying", F.coalesce("more", F.array().cast(_PLACE)))
    return store(joined.select("id", "digest", "going", staying.alias("staying")), "cuts")


def sequences(docs: DataFrame) -> DataFrame:
    """The lines of the texts with words, stored once for each key and digest."""
    all_of = F.arrow_udf(_sequences, _SEQUENCES)("text").alias("all")
    rows = docs.where("id is not null").select("id", "digest", all_of).distinct()
    return store(rows.select("id", "digest", "all.*").where("octet_length(lines) > 0"), "lines")


def marks(lines: DataFrame, unequal: frozenset[int] = frozenset()) -> DataFrame:
    """What goes and stays of the texts (``sequences``) that repeat anything.

    ``going`` and ``staying`` are places among the lines that hold words: first line and
    number of lines; what is in both stays.  Lines with an ``unequal`` hash equal no others.
    """
    return _with_windows(_marked(lines, unequal), lines)


def _different(marked: DataFrame) -> frozenset[int]:
    """Hashes that different lines share, of the lines that go or stay; grouping compares their bytes."""
    owing = marked.where(F.size("going") + F.size("staying") > 0)
    contents = owing.mapInArrow(_contents, "hash bigint, content binary")
    different = contents.groupBy("hash", "content").agg(F.lit(1).alias("one")).groupBy("hash").count()
    # Hashes of 64 bits: two or more lines share one about once in ten billion lines.
    return frozenset(r["hash"] % (1 << 64) for r in different.where("count > 1").select("hash").collect())


def cut(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "cut") -> DataFrame:
    """Add a struct: the ``text`` without repeated passages, its ``lines``, and those ``gone``.

    A passage is a run of at least two lines and 20 words, or a line of 50; blank lines between its
    lines do not count and go along.  Repeats within a text go as well.  Every passage that stands
    twice in the input stands in the result, cut to windows of 20 words at worst.

    Null and empty texts have an empty ``text`` and one line.  Keys are whole numbers.  Rows without a
    key keep their text, and no other row loses what only they hold.  Of rows that share a key each text counts once, so
    full copies of a row lose the same.  Every row is kept; other columns are untouched, a column of the name ``out``
    is replaced.
    """
    content = F.col(f"`{text}`").cast("string")
    number, digest = F.col(f"`{key}`").cast("long"), F.xxhash64(content)
    lines = sequences(df.select(number.alias("id"), digest.alias("digest"), content.alias("text")))
    lists, unequal = ["__going", "__staying"], frozenset()
    while True:
        found = marks(lines, unequal).toDF("__id", "__digest", *lists)
        # The texts are moved once, and what is read from here on is stored with them.
        joined = df.join(found.hint("merge"), (number == F.col("__id")) & (digest == F.col("__digest")), "left")
        joined = joined.drop("__id", "__digest").withColumns({c: F.coalesce(c, F.array().cast(_PLACE)) for c in lists})
        joined = store(joined, "marked-texts")
        more = _different(joined.select(content.alias("text"), *(F.col(c).alias(c[2:]) for c in lists)))
        if more <= unequal:
            break
        unequal |= more
    # Not to be moved or repeated by the optimizer, which would cut each text twice.
    call = F.arrow_udf(_cut_all, "struct<text:string,lines:bigint,gone:bigint>").asNondeterministic()
    return joined.withColumn(out, call(content, *lists)).drop(*lists)


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their repeated passages removed; rows of which nothing is left go."""
    names = df.columns
    rows = cut(df, key, text, "__cut").where((F.col("__cut.gone") == 0) | (F.trim("__cut.text") != ""))
    changed = F.when(F.col("__cut.gone") > 0, F.col("__cut.text")).otherwise(F.col(f"`{text}`"))
    return rows.withColumn(text, changed).select(*[f"`{n}`" for n in names])
