"""Byte-pair encoding and decoding of whole texts, as a streaming transducer.

A word is read from left to right, symbol by symbol.  For every beginning of it the transducer
knows the last token that the beginning would have by itself, and where that token starts: of
all tokens that end there it is the only one that can follow the last token of the shorter beginning, as
no rule would have joined anything across their border.  So the tokens of all beginnings are a
tree, and the word's tokens are the path to its end.

What follows can only continue from a beginning after which a longer token may still be open.
Tokens on the paths of all of those can no longer change and are emitted.  How many symbols it
takes at most follows from the rules.  Let two words share their first n symbols.  Before any
merge they share n one-symbol tokens.  A rule (a, b) shortens this common run of tokens
only if it joins the last shared token, a, to what follows in one of the words.  After
that, what follows begins with a, so the next rule (c, d) that shortens the run is a later
one whose d begins with a.  The longest such chain, weighed by the lengths of its left
parts, is the most that is ever lost; memory is bounded by it and not by the word.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType
from tokenizers import Tokenizer

from yearloom.llm.common import add_columns, pieces

MEMO_WORDS = 100_000  # remembered words of one worker, if not said otherwise
MEMO_BORDERS = 80_000  # remembered pairs of tokens
MEMO_BEGINNINGS = 60_000  # remembered beginnings of words
MEMO_LENGTH = 48  # bytes of the longest word that is remembered
BUFFER = 64  # symbols read before stable tokens are emitted
ENDING = 3  # symbols that tell how long a token can be
START_BITS = 8  # of where a token of a short word starts
ID_BITS = 20  # of an id in a rule
ID_MASK = (1 << ID_BITS) - 1
START_MASK = (1 << START_BITS) - 1
NO_RULE = 1 << 60
BLOCK = 1 << 16  # ids decoded, or characters read, at a time


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Merge rules, ids, and the special strings of a tokenizer file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.pre_tokenizer = content["pre_tokenizer"]
        same = {t: t for t in self.ids}  # one object for all mentions of a token
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        merges = [(same.get(a, a), same.get(b, b)) for a, b in pairs]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.specials = {t["content"]: t["id"] for t in content["added_tokens"]}
        names = {i: s for s, i in chain(self.ids.items(), self.specials.items())}
        self.names = [names.get(i) for i in range(max(names, default=-1) + 1)]
        self.letters = _byte_letters()
        self.inner = [self.ids[c] for c in self.letters]
        self.final = [self.ids[c + self.suffix] for c in self.letters]
        self.by_id = [np.int32(i).tobytes() for i in range(len(self.names))]
        self.longest = max(map(self._length, self.ids))
        self.lookahead = sufficient_lookahead(merges, self._length)
        self._take_apart()

    @functools.cached_property
    def rules(self) -> dict[int, int]:
        """Pair of ids to rank and id of what it makes."""
        return {
            self.ids[a] << ID_BITS | self.ids[b]: rank << ID_BITS | self.ids[a + b]
            for (a, b), rank in self.ranks.items()
        }

    def _take_apart(self) -> None:
        # What each token is made of, by which rule; the first rule counts.
        same = {t: t for t in self.ids}
        self.made = {same.get(a + b, a + b): (rank, a, b) for (a, b), rank in reversed(self.ranks.items())}
        self.borders: dict[int, bool] = {}
        # Tokens that the rules do make of their own symbols, as all of a trained list.
        self.known = {t: i for t, i in self.ids.items() if len(t.removesuffix(self.suffix) or t) == 1}
        for t, (rank, a, b) in sorted(self.made.items(), key=lambda item: item[1][0]):
            if a in self.known and b in self.known and self._apart(a, b, rank):
                self.known[t] = self.ids[t]
        # Symbols of the longest token with an ending; others have fewer symbols than an ending.
        self.reach: dict[str, int] = {}
        for t in self.known:
            end = t[-ENDING - len(self.suffix) * self.ends(t) :]
            self.reach[end] = max(self.reach.get(end, 0), self._length(t))

    def ends(self, token: str) -> bool:
        """Whether a token stands at the end of words only."""
        return self.suffix != "" and token.endswith(self.suffix)

    @functools.cached_property
    def beginnings(self) -> frozenset[str]:
        """All beginnings of tokens that go on; an end of word is no symbol, but more than none."""
        return frozenset(t[:k] for t in self.known for k in range(1, len(t.removesuffix(self.suffix)) + (t.endswith(self.suffix) and self.suffix != "")))

    def follows(self, left: int, right: int) -> bool:
        """Whether both tokens stay apart where the one follows the other."""
        pair = left << ID_BITS | right
        found = self.borders.get(pair)
        if found is None:
            if len(self.borders) >= MEMO_BORDERS:
                self.borders.clear()
            found = self.borders[pair] = self._apart(self.names[left], self.names[right], len(self.ranks))
        return found

    def _apart(self, left: str, right: str, before: int) -> bool:
        """Takes both apart, the later rule first, and looks for one across the border before that."""
        while True:
            across = self.ranks.get((left, right))
            if across is not None and across < before:
                return False
            one, other = self.made.get(left), self.made.get(right)
            if one is None and other is None:
                return True
            if other is None or one is not None and one[0] > other[0]:
                before, left = one[0], one[2]
            else:
                # Of equal rules the one further left is applied first.
                before, right = other[0] + 1, other[1]

    def _length(self, symbols: str) -> int:
        return len(symbols) - len(self.suffix) * bool(self.suffix and symbols.endswith(self.suffix)) or 1

    def symbols(self, word: bytes) -> list[str]:
        out = list(word.decode("latin-1").translate(self.letters))
        out[-1] += self.suffix
        return out


def sufficient_lookahead(merges: list[tuple[str, str]], length=len) -> int:
    """Symbols after a token beyond which nothing can change it.

    Needs rules whose parts are made by earlier rules, as in any trained list; then
    merging the best rule first is the same as applying the rules one after the other.
    """
    best: dict[str, int] = {}  # heaviest chain whose last rule has this left part
    made = {a + b: rank for rank, (a, b) in reversed(list(enumerate(merges)))}
    most = 0
    for rank, (a, b) in enumerate(merges):
        if made.get(a, -1) >= rank or made.get(b, -1) >= rank:
            raise ValueError(f"rule {rank} uses a part that only a later rule makes")
        weight = length(a) + max((best.get(b[:k], 0) for k in range(1, len(b) + 1)), default=0)
        best[a] = max(best.get(a, 0), weight)
        most = max(most, weight)
    return most


def merged_ids(parts: list[int], rules: dict[int, int]) -> list[int]:
    """Apply the rules to the ids of a whole word, best rule first and from left to right.

    This and ``merged`` say what a word's tokens are; tests compare with them.
    """
    get = rules.get
    found = [get(a << ID_BITS | b, NO_RULE) for a, b in pairwise(parts)]
    while found and (best := min(found)) != NO_RULE:
        i = found.index(best)
        parts[i] = best & ID_MASK
        del parts[i + 1], found[i]
        if i < len(found):
            found[i] = get(parts[i] << ID_BITS | parts[i + 1], NO_RULE)
        if i:
            found[i - 1] = get(parts[i - 1] << ID_BITS | parts[i], NO_RULE)
    return parts


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same for the symbols of a word of any length, in n log n time."""
    n = len(symbols)
    parts: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (rank, i, parts[i], parts[i + 1])
        for i in range(n - 1)
        if (rank := ranks.get((parts[i], parts[i + 1]))) is not None
    ]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n:
                rank = ranks.get((parts[left], parts[right]))
                if rank is not None:
                    heapq.heappush(heap, (rank, left, parts[left], parts[right]))
    return [p for p in parts if p is not None]


def _last_token(v: Vocabulary, read: str, left: list[int], guess: int, tail: str = "") -> tuple[int, int]:
    """The one token that ends what was read and can follow what is before it, and where it starts.

    ``left`` has the last tokens of all shorter beginnings (-1: none).  ``guess`` is a likely start, not
    farther back than a token can be long.
    """
    known, borders, n, j = v.known.get, v.borders.get, len(read), guess
    first = n - v.longest if n > v.longest else 0
    while True:
        token = known(read[j:] + tail if tail else read[j:])
        if token is not None:
            before = left[j]
            if before < 0 or (fits := borders(before << ID_BITS | token)) or fits is None and v.follows(before, token):
                return token, j
        # From the guess to the end, then from the beginning to the guess.
        j += 1
        if j == n:
            j = first
        if j == guess:
            raise ValueError("a symbol is not in the vocabulary")


class Transducer:
    """Encodes one word of any length symbol by symbol; see the module."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.read = ""  # symbols since the last emitted token
        self.last = [-1]  # by place in ``read``: the token that ends there
        self.start = [0]

    def feed(self, symbols: str, end: bool = False) -> None:
        """Read more symbols; with ``end`` the last of them ends the word."""
        v = self.vocabulary
        for k, symbol in enumerate(symbols):
            self.read += symbol
            tail = v.suffix if end and k + 1 == len(symbols) else ""
            guess = max(self.start[-1], len(self.read) - v.longest)
            token, start = _last_token(v, self.read, self.last, guess, tail)
            self.last.append(token)
            self.start.append(start)

    def path(self, place: int) -> list[int]:
        """The tokens up to a place."""
        out = []
        while place:
            out.append(self.last[place])
            place = self.start[place]
        return out[::-1]

    def stable(self) -> list[int]:
        """Tokens that no continuation changes; they are given once."""
        read, n, opened = self.read, len(self.read), self.vocabulary.beginnings
        # From which places a token may go on beyond what was read.
        front = {n} | {q for q in range(max(0, n - self.vocabulary.longest), n) if read[q:] in opened}
        while len(front) > 1:  # back to where their paths meet
            farthest = max(front)
            front.discard(farthest)
            front.add(self.start[farthest])
        place = front.pop()
        out = self.path(place)
        if place:
            self.read = read[place:]
            self.last = self.last[place:]
            self.start = [0, *(max(0, k - place) for k in self.start[place + 1 :])]
        return out


class Beginnings:
    """The same for short words, remembering the last token of beginnings and where it starts.

    Words mostly begin like others.  Of a word's beginnings only those are looked at that a token of the
    vocabulary can follow.  Forgets everything when full.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.last: dict[str, int] = {}

    def _last(self, read: str, tail: str = "") -> int:
        """The one token that ends what was read and can follow what is before it, and where it starts."""
        v, last = self.vocabulary, self.last
        known, borders, n, whole = v.known.get, v.borders.get, len(read), read + tail
        longest = v.reach.get(whole[-ENDING - len(tail) :], ENDING - 1)
        for start in range(n - longest if n > longest else 0, n):
            token = known(whole[start:])
            if token is None:
                continue
            if not start:
                return token << START_BITS
            before = read[:start]
            found = last.get(before)
            if found is None:
                found = last[before] = self._last(before)
            left = found >> START_BITS
            fits = borders(left << ID_BITS | token)
            if fits or fits is None and v.follows(left, token):
                return token << START_BITS | start
        raise ValueError("a symbol is not in the vocabulary")

    def ids(self, word: bytes) -> list[int]:
        v, last = self.vocabulary, self.last
        if len(last) >= MEMO_BEGINNINGS:
            last.clear()
        read = word.decode("latin-1").translate(v.letters)
        found = self._last(read, v.suffix)
        out = [found >> START_BITS]
        while start := found & START_MASK:
            found = last[read[:start]]
            out.append(found >> START_BITS)
        return out[::-1]


class _Memo(dict):
    """Packed ids of short words.  Two halves: when one is full, the one before is forgotten."""

    def __init__(self, encoder: Encoder, words: int):
        self.encoder, self.words = encoder, words
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.before.get(word)
        if found is None:
            content = word.encode()
            found = b"".join(self.encoder.word_ids(content))
            if len(content) > MEMO_LENGTH:
                return found
        if len(self) >= self.words // 2:
            self.before = dict(self)
            self.clear()
        self[word] = found
        return found


def _latin_pattern() -> re.Pattern:
    """The pattern of words for texts without characters beyond U+024F, where classes are short."""
    space, digit = r"\t-\r \x85\xa0", "0-9\xb2\xb3\xb9\xbc-\xbe"
    letter = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
    return re.compile(rf"{COMMON}|[{letter}]+|[{digit}]|[^{space}{digit}{letter}]+")


# The pattern of words in the tokenizer file.
COMMON = r"'s|'t|'re|'ve|'m|'ll|'d"
LATIN = _latin_pattern()
ANY = regex.compile(rf"{COMMON}|\p{{L}}+|\p{{N}}|[^\p{{White_Space}}\p{{L}}\p{{N}}]+")


class Scripts:
    """The pattern of words for texts in any script.

    The pattern module may know letters and digits that the tokenizer library's table of
    characters does not have yet.  The library itself tells which; they are other signs.
    """

    def __init__(self, pre_tokenizer: dict):
        every = batched(map(chr, chain(range(0xD800), range(0xE000, 0x110000))), BLOCK)
        signs = chain.from_iterable(regex.findall(r"[\p{L}\p{N}]", "".join(some)) for some in every)
        recent = [c for c in signs if unicodedata.category(c) == "Cn"]
        # Without the vocabulary, which words do not depend on.
        model = {"type": "BPE", "vocab": {}, "merges": []}
        library = Tokenizer.from_str(json.dumps({"added_tokens": [], "pre_tokenizer": pre_tokenizer, "model": model}))
        cut = library.pre_tokenizer.pre_tokenize_str
        new = "".join(c for c in recent if len(cut(f"!{c}")) == 1)
        letter, digit = (rf"[\p{{{c}}}--[{new}]]" if new else rf"\p{{{c}}}" for c in "LN")
        other = rf"(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]{f'|[{new}]' if new else ''})"
        self.recent = regex.compile(f"[{new}]" if new else "(?!)")
        self.pattern = regex.compile(rf"(?V1){COMMON}|{letter}+|{digit}|{other}+")

    def words(self, text: str) -> list[str]:
        return (self.pattern if self.recent.search(text) else ANY).findall(text)


@functools.cache
def scripts(path: str) -> Scripts:
    return Scripts(vocabulary(path).pre_tokenizer)


class Encoder:
    """Texts to ids: lower-cased words of letters, single digits, runs of other signs."""

    SPACE = regex.compile(r"[\t\n\r ]")

    def __init__(self, vocabulary: Vocabulary, words: int = MEMO_WORDS):
        self.vocabulary = vocabulary
        self.memo = _Memo(self, words)
        self.short = Beginnings(vocabulary)
        special = "|".join(map(regex.escape, sorted(vocabulary.specials, key=len, reverse=True)))
        self.special = regex.compile(f"({special})") if special else None

    def word_ids(self, word: bytes) -> Iterator[bytes]:
        """The packed ids of one word; holds a bounded number of symbols at a time."""
        v, size = self.vocabulary, len(word)
        if size <= BUFFER:
            yield from map(v.by_id.__getitem__, self.short.ids(word))
            return
        coder = Transducer(v)
        for start in range(0, size, BUFFER):
            end = start + BUFFER >= size
            coder.feed(word[start : start + BUFFER].decode("latin-1").translate(v.letters), end)
            for token in coder.path(len(coder.read)) if end else coder.stable():
                yield v.by_id[token]

    def blocks(self, text: str) -> Iterator[str]:
        """Pieces of the text, cut where white space stands, so no word is cut."""
        start = 0
        while len(text) - start > BLOCK:
            cut = self.SPACE.search(text, start + BLOCK)
            if cut is None:
                break
            yield text[start : cut.end()]
            start = cut.end()
        yield text[start:]

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            # Each character is lowered by itself, without a special final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isascii() or max(text) <= "\u024f":
            return LATIN.findall(text)
        return scripts(self.vocabulary.path).words(text)

    def ids(self, text: str) -> Iterator[bytes]:
        """The ids as 32-bit integers, block by block."""
        for block in self.blocks(text):
            plain = [block] if self.special is None else self.special.split(block)
            for k, piece in enumerate(plain):
                if k % 2:
                    yield self.vocabulary.by_id[self.vocabulary.specials[piece]]
                elif piece:
                    yield b"".join(map(self.memo.__getitem__, self.words(piece)))


class Decoder:
    """Ids to text.  State is whether a token came before; unknown ids give nothing."""

    def __init__(self, vocabulary: Vocabulary):
        self.names = vocabulary.names
        self.started = False

    def feed(self, ids: np.ndarray) -> str:
        # The file names no decoder: tokens are joined by one space.
        known = ids[(ids >= 0) & (ids < len(self.names))] if len(ids) else ids
        names = list(map(self.names.__getitem__, known.tolist()))
        text = " ".join([n for n in names if n is not None] if None in names else names)
        if not names or not text:
            return ""
        lead, self.started = " " * self.started, True
        return lead + text


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """Read once per worker process."""
    return Vocabulary(path)


@functools.cache
def encoder(path: str, words: int = MEMO_WORDS) -> Encoder:
    return Encoder(vocabulary(path), words)


def encode_array(texts: pa.Array, path: str, words: int = MEMO_WORDS) -> pa.Array:
    """List of ids for each text."""
    coder, rows = encoder(path, words), []
    for _, part in pieces(texts):
        rows += [b"".join(coder.ids(text.decode())) for text in part]
    ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
    flat = np.frombuffer(b"".join(rows), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def decode_array(ids: pa.Array, path: str) -> pa.Array:
    words, out = vocabulary(path), []
    ends = np.asarray(ids.offsets)
    flat = ids.values.fill_null(-1).to_numpy()
    for valid, start, end in zip(ids.is_valid().to_pylist(), ends[:-1], ends[1:], strict=True):
        decoder = Decoder(words)
        blocks = (flat[k : min(k + BLOCK, end)] for k in range(start, end, BLOCK))
        out.append("".join(map(decoder.feed, blocks)) if valid else None)
    return pa.array(out, pa.string())


def encode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None, words: int = MEMO_WORDS
) -> DataFrame:
    """Add the ids of each whole text as an array of integers.

    ``path`` is a tokenizer file that every executor can open.  With ``decoded``, a column of
    that name takes what the ids decode to, in the same pass.  Null and empty texts give an
    empty array.  Every row is kept, repeated ones too; other columns are untouched, and
    columns of the names ``ids`` and ``decoded`` are replaced.  The text's special strings
    give their ids.  A worker remembers the ids of as many ``words``, some 200 bytes each.
    """
    added = {ids: ArrayType(IntegerType())} | ({decoded: StringType()} if decoded else {})

    def call(texts: pa.Array) -> list[pa.Array]:
        found = encode_array(texts, path, words)
        return [found, decode_array(found, path)] if decoded else [found]

    return add_columns(df, text, added, call)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of each array of ids.

    An empty array gives an empty text, a null array null; null and unknown ids inside give
    nothing.  Every row and column is kept; a column of the name ``text`` is replaced.
    """
    call = F.arrow_udf(lambda values: decode_array(values, path), StringType())
    return df.withColumn(text, call(F.col(f"`{ids}`").cast("array<int>")))
