"""Decontamination against planted copies and a plain Smith-Waterman."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import decontaminate as d


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = d.MATCH if a[i - 1] == b[j - 1] else d.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + d.GAP, h[i, j - 1] + d.GAP)
    return h.max()


def test_alignment_equals_the_plain_one():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a = rng.integers(1, 6, rng.integers(1, 12)).astype(np.uint64)
        rows = rng.integers(1, 6, (5, rng.integers(1, 25))).astype(np.uint64)
        score, _ = d.align(a, rows)
        assert score.tolist() == [smith_waterman(a.tolist(), r.tolist()) for r in rows]


@pytest.fixture(scope="module")
def planted(spark, docs_of):
    rng = random.Random(9)
    prose = lambda n: " ".join(f"w{rng.randrange(2000)}" for _ in range(n))
    items = {i: prose(rng.randrange(20, 50)) for i in range(30)}
    texts, want = [], set()
    for i in range(400):
        text = prose(rng.randrange(5, 400))
        if i % 5 == 0:
            item = rng.randrange(20)
            copy = items[item].split()
            if i % 10 == 0:  # an edited copy: words changed, left out and put in
                for _ in range(len(copy) // 7):
                    copy[rng.randrange(len(copy))] = "changed"
                del copy[rng.randrange(len(copy))]
                copy.insert(rng.randrange(len(copy)), "extra")
            text = f"{text} {' '.join(copy).upper() if i % 3 else ', '.join(copy)} {prose(20)}"
            want.add((i, item))
        texts.append(text)
    for i in range(300):  # an item whose every n-gram is frequent
        texts.append(f"{prose(10)} {items[25]} {prose(10)}")
        want.add((400 + i, 25))
    texts += [None, "", "w1"]
    benchmark = [*items.items(), (30, None), (31, ""), (32, "w1 w2"), (33, items[25])]
    want |= {(a, 33) for a, b in want if b == 25}
    frame = spark.createDataFrame([(i, t, "x") for i, t in benchmark], "item_id long, text string, doc_id string")
    return docs_of(texts), frame, want, texts


def test_finds_copies_and_leaves_others(planted):
    docs, items, want, texts = planted
    rows = d.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    for r in rows[:50]:
        part = texts[r.doc_id].lower().encode()[r.first_byte : r.end_byte].decode()
        assert d.SHARE <= r.score <= 1 and 15 <= r.last_word - r.first_word <= 60 and not part.startswith(" ")
    exact = [r for r in rows if r.item_id == 25]
    assert {r.score for r in exact} == {1.0}
    words = texts[exact[0].doc_id].split()
    assert words[exact[0].first_word : exact[0].last_word] == words[10:-10]


def test_marker_agrees(planted):
    docs, items, want, _ = planted
    marked = docs.filter(d.marker(docs, items)(F.col("text"))).select("doc_id").collect()
    assert sorted(r.doc_id for r in marked) == sorted({a for a, _ in want})


def test_blocks_of_items(planted, monkeypatch):
    monkeypatch.setattr(d, "GRAMS_PER_BLOCK", 500)
    docs, items, want, _ = planted
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()} == want


@pytest.mark.parametrize("copies", [1, 400])
def test_parts_and_edits_of_a_popular_item_equal_all_pairs(spark, docs_of, copies):
    """Hits are among those of aligning every document with every item, and all that keep five words in a row, whether one document or hundreds hold the item."""
    rng = random.Random(21)
    prose = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    items = {i: prose(rng.choice([24, 40, 55])) for i in range(4)}
    docs = [prose(6) + items[0] + prose(6) for _ in range(copies)]
    for part in (0.3, 0.45, 0.5, 0.7):
        size = round(part * len(items[0]))
        for at in (0, (len(items[0]) - size) // 2, len(items[0]) - size):
            docs.append(prose(9) + items[0][at : at + size] + prose(9))
    for i in (0, 1, 2, 3):
        for every in (3, 4, 6, 9):  # one word in so many changed, or left out
            docs.append(prose(5) + [w if k % every else "changed" for k, w in enumerate(items[i], 1)] + prose(5))
            docs.append(prose(5) + [w for k, w in enumerate(items[i], 1) if k % every] + prose(5))
    docs += [prose(60) for _ in range(10)]
    number = {w: k + 1 for k, w in enumerate(sorted({w for t in [*docs, *items.values()] for w in t}))}
    code = lambda words: [number[w] for w in words]
    want, sure, run = set(), set(), d.SPREAD + d.GRAM - 1
    for d_id, words in enumerate(docs):
        for i, own in items.items():
            if smith_waterman(code(own), code(words)) >= d.SHARE * d.MATCH * len(own):
                want.add((d_id, i))
                # a copy that leaves five words of the item in a row has a seed for certain
                if {tuple(own[k : k + run]) for k in range(len(own) - run + 1)} & {tuple(words[k : k + run]) for k in range(len(words) - run + 1)}:
                    sure.add((d_id, i))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.contaminated(docs_of([" ".join(w) for w in docs]), frame).collect()}
    assert sure <= found <= want and len(sure) >= copies + 20


def test_odd_and_empty(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, None)], "item_id long, text string")
    rows = d.contaminated(odd_docs, items).collect()
    assert {r.item_id for r in rows} == {1} and len(rows) == sum("three four" in (r.text or "") for r in odd_docs.collect())
    assert d.contaminated(no_docs, items).count() == 0
    assert d.contaminated(odd_docs, items.limit(0)).count() == 0
    assert odd_docs.filter(d.marker(odd_docs, items.limit(0))(F.col("text"))).count() == 0
