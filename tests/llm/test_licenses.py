import random
import re

import pytest

from tests.llm.conftest import MESSY
from yearloom.llm import licenses


def scanned(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    return {r["doc_id"]: r for r in licenses.scan(df).collect()}


@pytest.mark.parametrize(
    ("text", "n_base", "first", "last", "base", "labels", "score"),
    [
        ("MIT License", 1, 0, 0, "mit", "mit", 1.0),
        ("a mit-license; the Apache\nLICENSE, mit license", 3, 1, 6, "apache,mit", "apache,mit", 1.0),
        ("GNU General Public License v3", 1, 1, 1, "gpl", "gpl", 1.0),
        ("GNU Lesser General Public License", 1, 2, 2, "gpl", "gpl,lgpl", 1.0),
        ("general public mit", 0, None, None, "", "", 0.0),
        ("mit licenses, mitlicense", 0, None, None, "", "", 0.0),
        ("Licensed under CC BY-NC 4.0.", 0, None, None, "", "cc", 1.0),
        ("licensed under the very apache licence version 2.0", 0, None, None, "", "", 0.0),
        ("Redistribution and use in source and binary form, with or without modification, are "
         "permitted provided that the following conditions are met", 0, None, None, "", "bsd", 18 / 20),
        ("mit license " * 3000, 3000, 0, 5998, "mit", "mit", 1.0),
    ],
)
def test_phrases_and_spans(spark, text, n_base, first, last, base, labels, score):
    row = scanned(spark, [text])[0]
    assert (row["n_base"], row["first_word"], row["last_word"]) == (n_base, first, last)
    assert (row["base_labels"], row["labels"]) == (base, labels)
    assert row["score"] == pytest.approx(score, abs=0.11 if 0 < score < 1 else 0)


def test_a_word_put_in_shifts_the_diagonal(spark):
    text = "permission to use copy modify and or kindly distribute this software for any purpose with or without fee"
    assert scanned(spark, [text])[0]["labels"] == "isc"


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("the mit the mit the mit", ""), ("license mit the under released", ""), ("under the under the under the mit", ""),
        ("released under under the the mit license", "mit"), ("gnu lesser very general public license", "gpl,lgpl"),
        ("mozilla public license the terms of subject to the", ""),
        ("released a b c under d e f the g h i mit license", "mit"),
    ],
)
def test_spans_are_verified(spark, text, labels):
    assert scanned(spark, [text])[0]["labels"] == labels


def brute(text):
    """By the statement: every span of every template, place by place."""
    words = re.findall(licenses.WORD, text.lower())
    labels, score = set(), 0.0
    for label, base, phrase in licenses.TEMPLATES:
        own = phrase.split()
        pairs = list(zip(own, own[1:], strict=False))
        matches = [(pos, at) for pos in range(len(words) - 1) for at, pair in enumerate(pairs) if pair == (words[pos], words[pos + 1])]
        for start in {pos - at for pos, at in matches}:
            last, count = -1, 0
            for at in range(len(pairs)):
                here = [pos for pos, a in matches if a == at and start <= pos - a <= start + (0 if base else licenses.DRIFT)]
                if here and min(here) > last:
                    last, count = min(here), count + 1
            if count == len(pairs) if base else count >= licenses.VOTES and count >= licenses.SHARE * len(pairs):
                labels.add(label)
                score = max(score, count / len(pairs))
    return ",".join(sorted(labels)), score


def test_random_words_as_by_brute_force(spark):
    """Words of a template, with some left out, put in, repeated and moved."""
    r, texts = random.Random(8), ["the mit the mit the mit"]
    for _ in range(400):
        words = []
        for _ in range(r.randrange(1, 4)):
            own = r.choice(licenses.TEMPLATES)[2].split()
            for _ in range(r.randrange(6)):
                at = r.randrange(len(own) + 1)
                own[at : at + r.randrange(2)] = r.choice([[], ["word"], own[:2], [r.choice(own)] if own else []])
            words += own
        texts.append(" ".join(words))
    found = scanned(spark, texts)
    for k, text in enumerate(texts):
        labels, score = brute(text)
        assert (found[k]["labels"], found[k]["score"]) == (labels, pytest.approx(score)), text
    assert len({row["labels"] for row in found.values()}) > 8


def test_no_python_in_the_plan(messy, plan):
    text = plan(licenses.scan(messy))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_messy_rows(messy):
    rows = licenses.scan(messy).collect()
    assert len(rows) == len(MESSY)
    counts = sorted((str(r["doc_id"]), r["n_words"]) for r in rows)
    words = {None: 0, "": 0, "  \n\t ": 0}
    expected = [(str(i), words[t]) for i, t in MESSY if t in words]
    assert all(e in counts for e in expected)
    assert ("6", 90_000) in counts and counts.count(("5", 5)) == 2
    assert all(r["n_base"] == 0 and r["labels"] == "" and r["score"] == 0 for r in rows)
    assert licenses.scan(messy.limit(0)).count() == 0
