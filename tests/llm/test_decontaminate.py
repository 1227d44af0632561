import re
import tracemalloc

import pytest

from tests.llm.conftest import MESSY
from yearloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def cut(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(lower)


def expected(text, items, window=10):
    words, hit, names = cut(text), set(), set()
    for name, item in items:
        own = cut(item)
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[k : k + size]:
                    hit.update(range(i, i + size))
                    names.add("" if name is None else str(name))
    return len(words), len(hit), sorted(names)


def found(docs, items, **named):
    rows = decontaminate.find(docs, items, **named).select(
        "text", "found.*", decontaminate.hit_words().alias("n_hit")
    )
    return rows.collect()


@pytest.fixture
def case(words):
    items = [(k, " ".join(words(k, 12 + k))) for k in range(8)]
    items += [(20, "two words"), (21, "single"), (22, None), (23, ""), (None, "no id here"), (3, "again number three")]
    texts = [" ".join(words(100 + k, 60)) for k in range(6)]
    texts[0] += " " + items[0][1].upper()
    texts[1] = items[1][1] + ", " + texts[1] + "! " + items[2][1][:70]
    texts[2] += " Two  WORDS; single; again-number-three " + " ".join(items[4][1].split()[1:11])
    texts[3] += " " + " ".join(items[4][1].split()[1:10])
    texts[4] += " " + items[5][1] + " " + items[5][1] + " no id here"
    texts[5] = texts[0]
    return texts + [t for _, t in MESSY[:4]], items


def test_words_hit_and_items_as_by_brute_force(spark, case, monkeypatch):
    texts, items = case
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 700)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = found(docs, spark.createDataFrame(items, ITEMS))
    assert sorted((r["n_words"], r["n_hit"], r["items"]) for r in rows) == sorted(expected(t, items) for t in texts)


def test_blocks_of_the_benchmark_change_nothing(spark, case, monkeypatch):
    texts, items = case
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    whole = sorted((r["text"] or "", r["n_hit"], r["items"], r["longest"]) for r in found(docs, spark.createDataFrame(items, ITEMS)))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    parts = sorted((r["text"] or "", r["n_hit"], r["items"], r["longest"]) for r in found(docs, spark.createDataFrame(items, ITEMS)))
    assert whole == parts


def test_longest_match_and_its_place(spark, words):
    item = words(1, 40)
    text = [*words(2, 5), *item[3:25], *words(3, 5), *item[:12]]
    docs = spark.createDataFrame([(" ".join(text),)], "text string")
    row = found(docs, spark.createDataFrame([(7, " ".join(item))], ITEMS))[0]
    assert (row["longest"], row["longest_at"], row["longest_item"]) == (22, 5, "7")
    assert [(h["first"], h["past"]) for h in row["hits"]] == [(5, 27), (32, 44)]


def test_messy_rows_and_removal(spark, messy, same_extras):
    items = spark.createDataFrame([(1, "one two"), (2, None)], ITEMS)
    same_extras(decontaminate.find(messy, items).drop("found"))
    left = decontaminate.remove(messy, items)
    assert left.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, _ in MESSY if i != 5)


def test_empty_tables(spark, messy):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.remove(messy, none).count() == len(MESSY)
    assert decontaminate.find(messy.limit(0), none).count() == 0


def test_a_passage_of_many_items_in_many_documents(words):
    """Documents, windows and items are never multiplied in one array."""
    passage = " ".join(words(1, 30))
    items = [(f"{k:04}", f"{passage} own{k}".encode()) for k in range(3000)]
    tests = decontaminate.Tests(items, 10)
    texts = [f"text{k} {passage} end{k}".encode() for k in range(300)]
    tracemalloc.start()
    rows = decontaminate._shard(tests, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rows) == 300 and peak < 50e6  # 300 documents x 21 windows x 3,000 items of 16 bytes are 302 MB
    sizes, at = [], 0
    for start, part in decontaminate._named(tests, rows, True):
        assert start == at and all(r["items"] == tests.names for r in part)
        sizes.append(len(part))
        at += len(part)
    assert at == 300 and max(sizes) * 3000 < decontaminate.MOST_ITEMS + 3000


def test_many_shared_items_by_spark(spark, words):
    passage = words(1, 14)
    items = [(k, " ".join([*passage, f"own{k}"][k % 3 :])) for k in range(40)] + [(99, " ".join(passage[:3]))]
    texts = [" ".join([f"text{k}", *passage[k % 4 :], f"own{k}"]) for k in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = found(docs, spark.createDataFrame(items, ITEMS))
    assert sorted((r["n_words"], r["n_hit"], r["items"]) for r in rows) == sorted(expected(t, items) for t in texts)
