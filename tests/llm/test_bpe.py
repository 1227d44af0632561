import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from yearloom.llm import bpe, catalog

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def ids(text):
    return np.frombuffer(b"".join(bpe.encoder(PATH).ids(text)), np.int32).tolist()


def test_random_texts_are_encoded_as_by_the_library(library):
    r = random.Random(3)
    alphabets = ["abcdefgh  \n'", "Don't we'll I'm 12,3!?", "éÉßİΣς ñ́", "日本語 русский 한글", "<|endoftext|>"]
    for _ in range(2000):
        text = "".join(r.choice(r.choice(alphabets)) for _ in range(r.randrange(40)))
        assert ids(text) == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("buffer", [1, 64])
def test_long_words_are_encoded_through_a_small_buffer(library, monkeypatch, buffer):
    monkeypatch.setattr(bpe, "BUFFER", buffer)
    r = random.Random(buffer)
    for _ in range(4):
        text = "".join(r.choice("abcdefghijthein") for _ in range(4000))
        assert ids(text) == library.encode(text, add_special_tokens=False).ids


def streamed(word):
    """Tokens of a word, how many of them came before its end, and the most symbols held."""
    v = bpe.vocabulary(PATH)
    coder, out, held = bpe.Transducer(v), [], 0
    symbols = word.decode("latin-1").translate(v.letters)
    for k, symbol in enumerate(symbols):
        coder.feed(symbol, k + 1 == len(symbols))
        held = max(held, len(coder.read))
        if k + 1 < len(symbols):
            out += coder.stable()
    return [*out, *coder.path(len(coder.read))], len(out), held


def test_tokens_are_emitted_before_the_end_of_words(folder):
    """On the given documents, symbol by symbol: nothing emitted ever changes."""
    import duckdb

    v, coder = bpe.vocabulary(PATH), bpe.encoder(PATH)
    texts = duckdb.sql(f"SELECT text FROM '{folder}/documents.parquet' WHERE text IS NOT NULL LIMIT 60").fetchall()
    words = sorted({w for (t,) in texts for w in coder.words(t)})
    early = several = 0
    for word in words:
        tokens, before, _ = streamed(word.encode())
        assert tokens == coder.short.ids(word.encode()) == [v.ids[t] for t in bpe.merged(v.symbols(word.encode()), v.ranks)]
        early += before
        several += len(tokens) - 1
    assert len(words) > 3000 and early > 0.3 * several  # of those that are not the last of their word


def test_memory_does_not_grow_with_the_word():
    r, v = random.Random(6), bpe.vocabulary(PATH)
    for letters in (b"abcdefghijthein", b"a", b"ab", b"the", b"=-_", b"ha"):
        short, long = (bytes(r.choice(letters) for _ in range(n)) for n in (600, 6000))
        for word in (short, long, letters * 300):
            tokens, early, held = streamed(word)
            assert tokens == [v.ids[t] for t in bpe.merged(v.symbols(word), v.ranks)]
            assert held <= v.lookahead + v.longest + 1
            assert early > 0.8 * (len(tokens) - v.lookahead)


def test_borders_of_small_lists():
    class Small(bpe.Vocabulary):
        def __init__(self, merges):
            self.ranks, self.suffix = {m: k for k, m in enumerate(merges)}, ""
            self.names = [*"abc", *(a + b for a, b in merges)]
            self.ids = {t: k for k, t in enumerate(self.names)}
            self.longest = max(map(len, self.ids))
            self._take_apart()

    r = random.Random(9)
    for _ in range(300):
        merges, parts = [], list("abc")
        for _ in range(r.randrange(1, 9)):
            pair = r.choice(parts), r.choice(parts)
            if "".join(pair) not in parts:
                merges.append(pair)
                parts.append("".join(pair))
        v = Small(merges)
        for _ in range(20):
            word = "".join(r.choice("abc") for _ in range(r.randrange(1, 14)))
            coder, out = bpe.Transducer(v), []
            for symbol in word:
                coder.feed(symbol)
                out += coder.stable()
            assert [v.names[t] for t in out + coder.path(len(coder.read))] == bpe.merged(list(word), v.ranks), (merges, word)


def test_special_strings_and_blocks(library, monkeypatch):
    text = "A<|endoftext|>b <|STARTOFTEXT|> " + "wörd's 12 " * 200 + "<|startoftext|>"
    expected = library.encode(text, add_special_tokens=False).ids
    for size in (1, 7, 1 << 16):
        monkeypatch.setattr(bpe, "BLOCK", size)
        assert ids(text) == expected


def test_lookahead_of_small_lists():
    # ab, then cab: whether c joins depends on whether b follows a.
    assert bpe.sufficient_lookahead([("a", "b"), ("c", "ab")]) == 2
    assert bpe.sufficient_lookahead([("a", "b"), ("c", "d")]) == 1
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([("ab", "c"), ("a", "b")])


def test_both_ways_to_merge_agree():
    v, r = bpe.vocabulary(PATH), random.Random(5)
    for _ in range(300):
        word = bytes(r.choice(b"thein gaslorst") for _ in range(r.randrange(1, 60)))
        ids = [*(v.inner[b] for b in word[:-1]), v.final[word[-1]]]
        assert bpe.merged_ids(ids, v.rules) == [v.ids[t] for t in bpe.merged(v.symbols(word), v.ranks)]


def test_decoding_block_by_block(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 3)
    rows = [[3306, 1002, 568, 343], [], None, [-1, 343, 10**9, None], [49407]]
    found = bpe.decode_array(pa.array(rows, pa.list_(pa.int32())), PATH).to_pylist()
    assert found == [library.decode(rows[0], skip_special_tokens=False), "", None, "x</w>", "<|endoftext|>"]


def test_messy_rows(messy, same_extras, library):
    result = bpe.decode(bpe.encode(messy, PATH), PATH)
    same_extras(result)
    once = bpe.encode(messy.withColumn("ids", messy["id"]), PATH, decoded="decoded")
    assert set(once.columns) == set(result.columns)
    both = [sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in df.collect()) for df in (once, result)]
    assert both[0] == both[1]
    for row in result.collect():
        expected = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == expected
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False)


def test_query_equals_the_library(spark, folder, library):
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = catalog.op1_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        text = library.decode(expected, skip_special_tokens=False)
        assert row["n_tokens"] == len(expected)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, expected)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(messy):
    result = bpe.decode(bpe.encode(messy.limit(0), PATH), PATH)
    assert result.count() == 0


def test_only_beginnings_that_a_token_follows_are_remembered():
    coder = bpe.Encoder(bpe.vocabulary(PATH), words=4)
    v, r = coder.vocabulary, random.Random(8)
    words = ["".join(r.choice(["the", "ing", "ou", "é", "x", "ver"]) for _ in range(6)) for _ in range(300)]
    for word in words:
        content = word.encode()
        assert coder.short.ids(content) == [v.ids[t] for t in bpe.merged(v.symbols(content), v.ranks)]
    assert len(coder.short.last) < len({w.encode()[:k] for w in words for k in range(1, len(w.encode()))}) / 2
    list(coder.ids(" ".join(words)))
    assert len(coder.memo) <= 2 and len(coder.memo.before) <= 2
