import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import made_words
from yearloom.llm import catalog, toxicity


def made(words, n, seed=1):
    """Texts of which a fifth hold a few bad words, some of them as pairs only."""
    r, out = random.Random(seed), []
    for k in range(n):
        text, label = words(seed * 10_000 + k, r.randrange(5, 60)), int(k % 5 == 0)
        if label:
            for _ in range(3):
                text.insert(r.randrange(len(text)), r.choice(["vexbad", "vexworse", "dreadful"]))
        out.append((k, " ".join(text), label))
    return out


@pytest.fixture(scope="module")
def net():
    make = made_words
    rows = made(make, 600)
    return toxicity.train([toxicity.buckets(t.encode()) for _, t, _ in rows], np.array([y for *_, y in rows], np.float32)), make


def test_bad_words_are_learned(net):
    network, make = net
    rows, table = made(make, 200, seed=2), toxicity._language_table()
    scores = network.scores([toxicity.buckets(t.encode()) for _, t, _ in rows], table)
    assert np.mean((scores >= 0.5) == np.array([y for *_, y in rows])) >= 0.97


def test_whole_texts_are_scored(net, monkeypatch):
    """A bad passage at the end of a long text counts, and cuts lose no filter place."""
    network, make = net
    table = toxicity._language_table()
    text = toxicity.buckets((" ".join(make(5, 5000)) + " vexbad dreadful vexworse").encode())
    whole = network.pooled([text])
    monkeypatch.setattr(toxicity, "SEGMENT", 100)
    assert np.allclose(network.pooled([text]), whole, atol=1e-5)
    alone = [network.scores([t], table)[0] for t in (text, text[:0], text[:3])]
    assert np.allclose(network.scores([text, text[:0], text[:3]], table), alone, atol=1e-5)


def test_same_rows_give_the_same_network(words):
    rows = made(words, 80)
    texts, labels = [toxicity.buckets(t.encode()) for _, t, _ in rows], np.array([y for *_, y in rows], np.float32)
    a, b = toxicity.train(texts, labels), toxicity.train(texts, labels)
    assert (a.vectors == b.vectors).all() and (a.thresholds == b.thresholds).all()


def test_languages():
    table = toxicity._language_table()
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "el gato y los perros", "xyz", ""]
    assert toxicity.languages([toxicity.buckets(t.encode()) for t in texts], table).tolist() == [1, 2, 3, 4, 0, 0]


def test_threshold_lies_in_the_gap():
    assert toxicity._best(np.array([1.0, -2.0, 3.0, -1.0]), np.array([1, 0, 1, 0])) == 0.0


@pytest.mark.parametrize("labels", [[], [(1, 0), (5, 0)], [(5, 1)], [(1, None), (6, 2)], [(1, 0), (5, 1), (5, 0)]])
def test_messy_rows_and_few_labels(spark, messy, same_extras, labels):
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    network = toxicity.fit(messy, known)
    result = toxicity.score(messy, network)
    same_extras(result.drop("score"))
    assert all(0 <= r["score"] <= 1 for r in result.collect())
    assert toxicity.score(messy.limit(0), network).count() == 0


def test_held_out_accuracy(spark, folder):
    folder = folder.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = catalog.op4_toxicity(spark, folder)
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    for row in rows.collect():
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert row["predicted"] == (row["score"] >= 0.5)
    known = rows.where("held_out").join(labels, "doc_id").collect()
    assert len(known) > 40 and sum(r["predicted"] == r["toxic"] for r in known) >= 0.85 * len(known)
