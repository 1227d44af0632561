import random

import pytest

from tests.llm.conftest import MESSY
from yearloom.llm import catalog, line_dedup


def has(text):
    return [line for line in (text or "").split("\n") if line.split()]


def cut(df):
    return {r["doc_id"]: r["cut"] for r in line_dedup.cut(df).collect()}


def lines(words, seed, n, each=9):
    return [" ".join(words(1000 * seed + k, each)) for k in range(n)]


def boundaries(own):
    hashes, counts = line_dedup.line_hashes("\n".join(own).encode())
    starts, ends = line_dedup.chunks(hashes, counts)
    assert sum((ends - starts).tolist()) == len(hashes)
    assert all(e - s <= 2 for s, e in zip(starts, ends, strict=True))
    return set(starts.tolist())


@pytest.mark.parametrize("each", [3, 9])
def test_boundaries_do_not_depend_on_the_place(words, each):
    shared = lines(words, 1, 30, each)
    alone = {s for s in boundaries(shared) if s > 1}
    for before in range(5):
        whole = ["something else", "of two lines"][: before % 3] * before + shared
        n = len(whole) - 30
        assert {s - n for s in boundaries(whole) if s > n + 1} == alone
    assert len(boundaries(shared)) < 30 if each < line_dedup.LONG_LINE else len(boundaries(shared)) == 30


def test_long_passages_hold_an_anchor_wherever_they_stand(words):
    """Whatever is around them, every passage of over 50 words has an anchor in common with its copies."""
    r = random.Random(4)
    for seed in range(400):
        passage, total = [], 0
        while total <= 50:
            passage.append(" ".join(words(r.randrange(10**6), r.choice([1, 2, 3, 4, 4, 4, 5, 8]))))
            total += len(passage[-1].split())
        found = []
        for copy in range(2):
            before, after = (lines(words, r.randrange(10**6), r.randrange(4), r.choice([2, 4, 9])) for _ in range(2))
            hashes, counts = line_dedup.line_hashes("\n".join([*before, *passage, *after]).encode())
            low, high = len(before), len(before) + len(passage)
            found.append({(s - low, e - low) for s, e in line_dedup.runs(hashes, counts) if low <= s and e <= high})
        assert found[0] & found[1], passage


@pytest.mark.parametrize(("many", "each"), [(1, 60), (2, 30), (6, 15), (20, 8)])
def test_shared_passages_go_but_for_the_first(spark, words, many, each):
    """Of passages of over 50 words at most the lines at the ends stay."""
    passage = lines(words, 7, many, each)
    docs = []
    for k in range(12):
        own = lines(words, 50 + k, 8)
        at = k % 7
        docs.append((k, "\n".join(own[:at] + passage + own[at:])))
    found = cut(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert found[0]["gone"] == 0 and found[0]["text"] == docs[0][1]
    for k in range(1, 12):
        left = found[k]["text"].split("\n")
        assert set(lines(words, 50 + k, 8)) <= set(left)  # own lines stay
        assert sum(x in left for x in passage) <= (0 if each >= line_dedup.LONG_LINE else many // 2)


def test_short_repeated_lines_and_clean_documents_stay(spark, words):
    docs = [(k, "\n".join([*lines(words, k, 3), "A short common line.", *lines(words, 90 + k, 3)])) for k in range(9)]
    found = cut(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert all(found[k]["gone"] == 0 and found[k]["text"] == t for k, t in docs)


def test_repeats_within_a_document(spark, words):
    part = "\n".join(lines(words, 1, 2, 30))
    found = cut(spark.createDataFrame([(4, f"{part}\nown\n{part}")], "doc_id bigint, text string"))
    assert found[4]["text"] == f"{part}\nown" and found[4]["gone"] == 2


def test_equal_hashes_of_different_bytes_remove_nothing(spark, words, monkeypatch):
    monkeypatch.setattr(line_dedup, "_hash", lambda content: 5)
    docs = [(k, "\n".join(lines(words, k, 2, 30))) for k in range(3)]
    found = cut(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert all(row["gone"] == 0 for row in found.values())


def test_messy_rows(messy, same_extras):
    result = line_dedup.cut(messy)
    same_extras(result.drop("cut"))
    rows = {(r["doc_id"], r["text"]): r["cut"] for r in result.collect()}
    assert all(rows[i, t]["gone"] == 0 and rows[i, t]["text"] == (t or "") for i, t in MESSY if i != 7)
    assert rows[7, MESSY[7][1]]["text"] == ""  # a full copy of document 6
    kept = line_dedup.dedup(messy)
    assert kept.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in MESSY if i != 7)
    assert line_dedup.dedup(messy.limit(0)).count() == 0


def brute(rows):
    """Lines that go, by the statement: with strings, in one process, place by place."""
    texts = {i: has(text) for i, text in rows}
    size = lambda part: sum(len(x.split()) for x in part)
    enough = lambda part: line_dedup.is_passage(len(part), size(part))
    anchors = {}
    for i in sorted(texts):
        for start, end in line_dedup.runs(*line_dedup.line_hashes("\n".join(texts[i]).encode())):
            anchors.setdefault(tuple(texts[i][start:end]), []).append((i, start))
    going, staying = {i: {} for i in texts}, {i: set() for i in texts}
    found, pairs = {i: set() for i in texts}, set()
    for places in anchors.values():
        k, t = min(places)
        pairs |= {(i, k, s, t) for i, s in places if (i, s) != (k, t)}
    done = {}
    for i, k, s, t in sorted(pairs):
        if s < done.get((i, k), 0) or i == k and s <= t:
            continue
        own, kept, n, b = texts[i], texts[k], 0, 0
        room = s - t if i == k else len(own)
        while n < room and s + n < len(own) and t + n < len(kept) and own[s + n] == kept[t + n]:
            n += 1
        while b < room - n and s - b > 0 and t - b > 0 and own[s - b - 1] == kept[t - b - 1]:
            b += 1
        if enough(own[s - b : s + n]):
            done[i, k] = s + n
            found[i].add((k, t - b, s - b, n + b))
    for i, own in found.items():
        for k, t, s, n in sorted(own):
            for d in range(n):
                if s + d not in going[i]:
                    going[i][s + d] = (k, t, s, n)
                    staying[k].add(t + d)
    windows = {}
    for i, own in texts.items():
        for s in range(len(own)):
            e = next((e for e in range(s + 2, len(own) + 1) if size(own[s:e]) >= 20), None)
            if e is None:
                continue
            owed = {going[i].get(p) for p in range(s, e)}
            if any(p in going[i] and p not in staying[i] for p in range(s, e)) and (len(owed) > 1 or owed == {None}):
                windows.setdefault(tuple(own[s:e]), []).append((i, s, e))
    for places in windows.values():
        if len(places) > 1:
            i, s, e = min(places)
            staying[i] |= set(range(s, e))
    return {i: {p for p in going[i] if p not in staying[i]} for i in texts}


def check_whole_result(rows, found):
    """Nothing is lost, and what goes is what should."""
    left = {i: has(found[i]["text"]) for i, _ in rows}
    gone = brute(rows)
    for i, text in rows:
        assert left[i] == [line for p, line in enumerate(has(text)) if p not in gone[i]]
        assert found[i]["lines"] == (text or "").count("\n") + 1
    # Every passage that stands twice stands somewhere, as far as its windows of 20 words go.
    places, stand = {}, set()
    for texts, add in ((dict(rows), lambda w: places.update({w: places.get(w, 0) + 1})), (left, stand.add)):
        for text in texts.values():
            own = has(text) if not isinstance(text, list) else text
            for s in range(len(own)):
                e = next((e for e in range(s + 2, len(own) + 1) if sum(len(x.split()) for x in own[s:e]) >= 20), None)
                if e:
                    add(tuple(own[s:e]))
    assert {w for w, n in places.items() if n > 1} <= stand
    assert {line for _, text in rows for line in has(text)} == {line for own in left.values() for line in own}
    return sum(map(len, gone.values()))


def test_query_as_by_brute_force(spark, folder):
    """What goes is what the statement says, found by comparing the lines themselves."""
    for name in (folder, folder.replace("0.001", "0.01")):
        docs = spark.read.parquet(f"{name}/documents.parquet").select("doc_id", "text")
        rows = [tuple(r) for r in docs.orderBy("doc_id").collect()]
        found = cut(docs)
        assert len(found) == len(rows) and check_whole_result(rows, found) > 0
    result = catalog.op2_line_dedup(spark, folder)
    assert result.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_random_passages_as_by_brute_force(spark, words):
    """Texts put together from few lines: overlapping, nested, stitched and repeated passages."""
    r = random.Random(11)
    some = [" ".join(words(k, r.choice([2, 4, 6, 12, 12, 30]))) for k in range(60)]
    rows = []
    for i in range(160):
        own = []
        for _ in range(r.randrange(1, 7)):
            at = r.randrange(60)
            own += some[at : at + r.randrange(1, 9)] if r.random() < 0.7 else [" ".join(words(10**6 + 100 * i + len(own), 9))]
        rows.append((i, "\n".join(own)))
    found = cut(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert check_whole_result(rows, found) > 100


def test_what_one_document_keeps_it_does_not_lose(spark, words):
    a, b, c, p = lines(words, 5, 4, 12)
    docs = [(1, f"{b}\n{c}"), (2, f"{p}\n{a}"), (3, f"{p}\n{a}\n{b}\n{c}"), (4, f"{a}\n{b}")]
    found = cut(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert check_whole_result(docs, found) > 0
    assert [found[k]["text"] for k in (1, 2)] == [docs[0][1], docs[1][1]]
    assert f"{a}\n{b}" in found[3]["text"] and found[4]["text"] == ""


def test_passages_of_several_documents_are_not_stitched(spark, words):
    a, b, c, d = lines(words, 6, 4, 6)
    docs = [(1, f"{a}\n{b}"), (2, f"{c}\n{d}"), (5, f"{a}\n{b}\n{c}\n{d}")]
    found = cut(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert all(found[i]["text"] == text for i, text in docs)


SHAPES = [(2, 10), (3, 20), (3, 24), (4, 15), (5, 12), (6, 10), (12, 5), (2, 24)]


def test_passages_of_short_lines_go_as_a_whole(spark, words):
    docs, own, passages = [], {}, {}
    for s, (many, each) in enumerate(SHAPES):
        for k in range(10):
            passage = lines(words, 300 + 10 * s + k, many, each)
            for copy in range(2):
                i = 100 * s + 2 * k + copy
                own[i], passages[i] = lines(words, 2000 + i, 6), passage
                at = (i + k) % 7
                docs.append((i, "\n".join(own[i][:at] + passage + own[i][at:])))
    found = cut(spark.createDataFrame(docs, "doc_id bigint, text string"))
    for i, text in docs:
        assert found[i]["text"] == (text if i % 2 == 0 else "\n".join(own[i])), len(passages[i])


def test_passages_with_different_keepers_and_blank_lines(spark, words):
    a, b, c, d = lines(words, 1, 4, 8)
    own = lines(words, 2, 8)
    docs = [
        (1, "\n".join([own[0], a, b, own[1]])), (2, "\n".join([own[2], c, d, own[3]])),
        (3, "\n".join([own[4], a, b, c, d, own[5]])), (4, "\n".join([own[6], a, "", b, c, d, own[7]])),
    ]
    found = cut(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert [found[k]["gone"] for k in (1, 2, 4)] == [0, 0, 5]
    assert found[4]["text"] == f"{own[6]}\n{own[7]}" and found[3]["text"].startswith(own[4])


def test_query_removes_all_runs_of_lines(spark, folder):
    """Runs found by comparing lines with those of all earlier documents, without chunks."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    texts = [(i, (t or "").split("\n")) for i, t in docs.collect()]
    left, places, found = cut(docs), {}, 0
    for i, own in texts:
        gone = set()
        for p in range(len(own) - 1):
            for other, q in places.get((own[p], own[p + 1]), []):
                n = 0
                while p + n < len(own) and q + n < len(other) and own[p + n] == other[q + n]:
                    n += 1
                if sum(len(x.split()) for x in own[p : p + n]) >= 20:
                    gone |= set(range(p, p + n))
        assert left[i]["gone"] >= len(gone)
        found += len(gone)
        for p in range(len(own) - 1):
            places.setdefault((own[p], own[p + 1]), []).append((own, p))
    assert found > 0
    stay = {line for row in left.values() for line in row["text"].split("\n")}
    assert {line for _, own in texts for line in own} - stay <= {""}  # each line stays somewhere
