import uuid

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from yearloom.llm import catalog, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def cache(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def library(path):
    if path == WORDS:
        found = Tokenizer.from_file(path)
        return lambda text: len(found.encode(text, add_special_tokens=False).ids)
    found = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: len(found.encode(text))


@pytest.mark.parametrize("path", [WORDS, PIECES])
def test_messy_rows(messy, same_extras, cache, path):
    result = token_counts.count(messy, path, cache)
    same_extras(result)
    count = library(path)
    assert all(r["n_tokens"] == count(r["text"] or "") for r in result.collect())
    assert token_counts.count(messy.limit(0), path, cache).count() == 0


def test_only_misses_are_encoded_once(spark, cache, monkeypatch):
    docs = spark.createDataFrame([(1, "a b"), (2, " a  b\n"), (3, "c"), (4, "a b")], "doc_id bigint, text string")
    assert token_counts.count(docs, WORDS, cache).count() == 4
    stored = spark.read.parquet(cache)
    assert stored.count() == 2  # "a b" and "c"
    again = docs.unionByName(spark.createDataFrame([(5, "d e f")], "doc_id bigint, text string"))
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count(again, WORDS, cache).collect()} == {1: 2, 2: 2, 3: 1, 4: 2, 5: 3}
    assert spark.read.parquet(cache).count() == 3


def test_stored_counts_are_used_and_versions_kept_apart(spark, cache):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    token_counts.count(docs, WORDS, cache).collect()
    changed = spark.read.parquet(cache).selectExpr("digest", "version", "77L AS n_tokens").collect()
    other = cache + "-changed"
    spark.createDataFrame(changed, token_counts.CACHE).write.parquet(other)
    assert token_counts.count(docs, WORDS, other).first()["n_tokens"] == 77
    assert token_counts.count(docs, PIECES, other).first()["n_tokens"] == library(PIECES)("a b")


def test_query_as_by_the_library(spark, folder):
    count = library(WORDS)
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = catalog.op8_token_counts(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), count(text))
        assert row["over_limit"] == (row["n_tokens"] > 2048)
