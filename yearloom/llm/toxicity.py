"""Toxicity of texts by a small convolutional network, trained in numpy.

Words and their beginnings are hashed to buckets that have learned vectors, whose sum is
the word's vector; buckets that the training rows do not hold have the zero vector.  Filters of several widths slide over the words, the largest
response of each filter over the whole text is kept, and a logistic layer weighs them.  The
threshold of each language is calibrated on training rows set aside; a text's language is
told from its function words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.common import WORDS, pieces

BUCKETS = 1 << 20
BEGINNINGS = (4, 6)  # bytes of a word's beginnings
PARTS = 1 + len(BEGINNINGS)  # buckets of a word
SIZE = 8  # of a word's vector
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
SEGMENT = 1 << 16  # words that are looked at together
PIECE = 1 << 20  # bytes of text that are looked at together

TRAINING_ROWS = 8000  # the most labelled rows that a fit takes
EPOCHS = 14
BATCH = 32
RATE = 0.01
SEEN = 3  # training rows that must hold a bucket for it to get a vector
ASIDE = 5  # one in so many training rows only calibrates the thresholds
LEAST = 40  # rows aside, of each label at least a tenth, for a language's own threshold

# Function words that tell languages apart.
LANGUAGES = {
    "en": "the and of to in is that for was on are with as by at from be this have not they which",
    "de": "der die und das ist nicht ein eine den von mit sich des auf für im dem auch wird sind",
    "fr": "le les et des est dans une du pour que qui pas sur au avec ce il sont mais vous",
    "es": "el los y las del por una para con como más pero sus al lo se su es esta era",
}


def _bucket(word: bytes) -> int:
    return crc32(word) & (BUCKETS - 1)


def _language_table() -> np.ndarray:
    table = np.zeros(BUCKETS, np.int8)
    for k, words in enumerate(LANGUAGES.values(), 1):
        for word in words.split():
            table[_bucket(word.encode())] = k
    return table


def buckets(text: bytes) -> np.ndarray:
    """The buckets of each word: of the word itself, then of its beginnings."""
    words = WORDS(text.lower())
    parts = [list(map(crc32, words))]
    # A beginning starts from another checksum, so it is not the word of the same letters.
    parts += [[crc32(w[:n], n) for w in words] for n in BEGINNINGS]
    return (np.array(parts, np.int64).T & (BUCKETS - 1)).astype(np.int32)


def languages(texts: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Number of each text's language by its function words; 0 where there are none."""
    out = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        counts = np.bincount(table[text[:, 0]], minlength=len(LANGUAGES) + 1)[1:]
        out[i] = counts.argmax() + 1 if counts.any() else 0
    return out


@dataclass
class Network:
    rows: np.ndarray  # row of each bucket's vector, row 0 is the zero vector
    vectors: np.ndarray
    filters: list[np.ndarray]  # of each width: width x SIZE x FILTERS
    biases: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: np.ndarray  # log-odds, by number of the language

    def responses(self, flat: np.ndarray) -> np.ndarray:
        """Of each filter at each place; filters may reach beyond the end, onto zeros."""
        found = self.vectors[flat[:, 0]]
        for k in range(1, PARTS):
            found += self.vectors[flat[:, k]]
        n = len(flat)
        out = np.empty((n, len(self.biases)), np.float32)
        for k, (width, kernel) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            part = found @ kernel[0]
            for shift in range(1, width):
                part[: n - shift] += found[shift:] @ kernel[shift]
            out[:, k * FILTERS : (k + 1) * FILTERS] = part
        return out + self.biases

    def over(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows of all words, with zeros between segments, and the responses at each place;
        where segments start; the first segment of each text.

        A segment also holds the first words of the next one, which filters reach into; the
        responses there are the next segment's and don't count twice.
        """
        pad = max(WIDTHS)
        parts, starts, firsts, again, at = [], [], [], [], 0
        for text in texts:
            firsts.append(len(starts))
            for start in range(0, max(1, len(text)), SEGMENT):
                part = self.rows[text[start : start + SEGMENT + pad - 1]]
                starts.append(at)
                parts += [part, np.zeros((pad, PARTS), part.dtype)]
                if start + SEGMENT < len(text):
                    again.append(np.arange(at + SEGMENT, at + len(part) + pad))
                at += len(part) + pad
        flat = np.concatenate(parts)
        response = self.responses(flat)
        if again:
            response[np.concatenate(again)] = -np.inf
        return flat, response, np.array(starts), np.array(firsts)

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        _, response, starts, firsts = self.over(texts)
        most = np.maximum.reduceat(response, starts, axis=0)
        return np.maximum(np.maximum.reduceat(most, firsts, axis=0), 0)

    def odds(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.pooled(texts).astype(np.float64) @ self.weights + self.offset

    def scores(self, texts: list[np.ndarray], table: np.ndarray) -> np.ndarray:
        """From 0 to 1, 0.5 at the threshold of the text's language."""
        odds = self.odds(texts) - self.thresholds[languages(texts, table)]
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.rate, self.t = np.zeros(shape, np.float32), np.zeros(shape, np.float32), rate, 0

    def step(self, value: np.ndarray, slope: np.ndarray, at=slice(None)) -> None:
        self.t += 1
        m = self.m[at] = 0.9 * self.m[at] + 0.1 * slope
        v = self.v[at] = 0.999 * self.v[at] + 0.001 * slope**2
        scale = math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        value[at] -= self.rate * scale * m / (np.sqrt(v) + 1e-8)


def train(texts: list[np.ndarray], labels: np.ndarray) -> Network:
    """Fit on bucketed texts; the same rows in the same order give the same network."""
    random = np.random.default_rng(7)
    held = np.zeros(BUCKETS, np.int32)
    for text in texts:
        held[np.unique(text)] += 1
    kept = np.flatnonzero(held >= SEEN)
    rows = np.zeros(BUCKETS, np.int32)
    rows[kept] = np.arange(1, len(kept) + 1)
    vectors = (0.1 * random.standard_normal((len(kept) + 1, SIZE))).astype(np.float32)
    vectors[0] = 0
    filters = [
        (random.standard_normal((w, SIZE, FILTERS)) / math.sqrt(w * SIZE)).astype(np.float32)
        for w in WIDTHS
    ]
    many = FILTERS * len(WIDTHS)
    share = min(max(float(labels.mean()) if len(labels) else 0.0, 1e-3), 1 - 1e-3)
    net = Network(
        rows, vectors, filters, np.zeros(many, np.float32), np.full(many, 0.1, np.float32),
        math.log(share / (1 - share)), np.zeros(len(LANGUAGES) + 1),
    )
    if len(labels) == 0 or labels.min() == labels.max():
        net.weights[:] = 0
        return net
    mixed = random.permutation(len(texts))
    aside, learn = np.split(mixed, [len(texts) // ASIDE])
    heavy = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    offset = np.array([0.0], np.float32)
    steps = [_Adam(x.shape, RATE) for x in (vectors, *filters, net.biases, net.weights, offset)]
    for _ in range(EPOCHS):
        random.shuffle(learn)
        for start in range(0, len(learn), BATCH):
            own = learn[start : start + BATCH]
            flat, response, starts, firsts = net.over([texts[i] for i in own])
            ends = np.append(starts[firsts[1:]], len(flat))
            place = np.stack(
                [a + response[a:b].argmax(0) for a, b in zip(starts[firsts], ends, strict=True)]
            )
            top = np.take_along_axis(response, place, 0)
            pooled = np.maximum(top, 0)
            error = 1 / (1 + np.exp(-(pooled @ net.weights + offset[0]))) - labels[own]
            error = (error * heavy[own] / len(own)).astype(np.float32)
            back = np.where(top > 0, error[:, None] * net.weights, 0).astype(np.float32)
            slopes, pulls, words = [], [], []
            for k, (width, kernel) in enumerate(zip(WIDTHS, net.filters, strict=True)):
                spot = place[:, k * FILTERS : (k + 1) * FILTERS]
                pull = back[:, k * FILTERS : (k + 1) * FILTERS]
                change = np.zeros_like(kernel)
                for shift in range(width):
                    inside = spot + shift < len(flat)
                    word = flat[np.where(inside, spot + shift, 0)] * inside[..., None]
                    change[shift] = np.einsum("dfs,df->sf", net.vectors[word].sum(2), pull)
                    words.append(word.reshape(-1, PARTS))
                    pulls.append((pull[:, :, None] * kernel[shift].T[None]).reshape(-1, SIZE))
                slopes.append(change)
            words, pulls = np.concatenate(words), np.concatenate(pulls)
            touched, inverse = np.unique(words, return_inverse=True)
            inverse = inverse.reshape(words.shape)
            gathered = np.zeros((len(touched), SIZE), np.float32)
            for k in range(PARTS):
                np.add.at(gathered, inverse[:, k], pulls)
            gathered[touched == 0] = 0
            steps[0].step(net.vectors, gathered, touched)
            for step, value, change in zip(
                steps[1:],
                (*net.filters, net.biases, net.weights, offset),
                (*slopes, back.sum(0), pooled.T @ error, error.sum(keepdims=True)),
                strict=True,
            ):
                step.step(value, change)
    net.offset = float(offset[0])
    net.thresholds = _thresholds(net, [texts[i] for i in aside], labels[aside])
    return net


def _best(odds: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap between neighbouring odds that tells the labels apart best."""
    order = np.argsort(odds, kind="stable")
    odds, labels = odds[order], labels[order]
    # Right at a cut before each place: zeros below it and ones from it on, equally weighed.
    zeros = np.concatenate([[0], np.cumsum(labels == 0)]) / max(1, (labels == 0).sum())
    ones = 1 - np.concatenate([[0], np.cumsum(labels == 1)]) / max(1, (labels == 1).sum())
    right = (zeros + ones)[1:-1]
    right[odds[1:] == odds[:-1]] = -1
    tied = np.flatnonzero(right == right.max())
    cut = tied[np.argmax(odds[tied + 1] - odds[tied])]
    return float((odds[cut] + odds[cut + 1]) / 2)


def _thresholds(net: Network, texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    out = np.zeros(len(LANGUAGES) + 1)
    if len(labels) < 2 or labels.min() == labels.max():
        return out
    odds = np.array([net.odds([t])[0] for t in texts])
    spoken = languages(texts, _language_table())
    out[:] = _best(odds, labels)
    for k in range(len(out)):
        own = spoken == k
        if own.sum() >= LEAST and min(labels[own].sum(), (1 - labels[own]).sum()) >= LEAST / 10:
            out[k] = _best(odds[own], labels[own])
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most: int = TRAINING_ROWS,
) -> Network:
    """Learn from at most ``most`` labelled rows, those whose key has the smallest hashes.

    Rows whose label is neither 0 nor 1 are left out; of a repeated key the largest label
    counts, and of repeated documents each one.  With labels of one kind, or none, every score
    is the same.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("label"))
    spread = F.xxhash64(F.col(key).cast("string"))
    chosen = known.select(key, "label").orderBy(spread, key).limit(most)
    words = F.arrow_udf(_bucket_lists, "array<int>")(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    rows = (
        docs.select(key, F.col(f"`{text}`"))
        .join(F.broadcast(chosen), key)
        .select(F.xxhash64(F.col(key).cast("string")).alias("place"), key, "label", words.alias("words"))
        .orderBy("place", key, F.hash("words"))
        .limit(most)
    )
    found = rows.select("label", "words").toArrow()
    column = found.column("words").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    texts = [np.asarray(row.values).reshape(-1, PARTS) for row in column]
    return train(texts, np.array(found.column("label").to_pylist(), np.float32))


def _bucket_lists(texts: pa.Array) -> pa.Array:
    lists = [buckets(t) for _, part in pieces(texts, PIECE) for t in part]
    ends = np.concatenate([[0], np.cumsum([x.size for x in lists])]).astype(np.int32)
    flat = np.concatenate(lists).reshape(-1) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def score(df: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """Add how likely each whole text is toxic, 0.5 being its language's threshold.

    Null counts as empty.  Every row is kept; other columns are untouched and a column of
    the name ``out`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(net)

    def scores(texts: pa.Array) -> pa.Array:
        table, model = _language_table(), shared.value
        found = [
            model.scores([buckets(t) for t in part], table) for _, part in pieces(texts, PIECE)
        ]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return df.withColumn(out, F.arrow_udf(scores, "double")(F.col(f"`{text}`").cast("string")))
