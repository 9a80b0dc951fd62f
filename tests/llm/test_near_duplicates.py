"""Near-duplicate components against all pairs."""

import random

import pytest

from footfall.llm import components as cc
from footfall.llm import minhash
from footfall.llm.minhash import least_matches, near_duplicates


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    """(doc_id -> (n_shingles, component)) over all pairs of rows."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, sa in sets:
        for b, sb in sets:
            if sa and sb and 100 * len(sa & sb) >= percent * len(sa | sb):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    size = {}
    for i, s in sets:
        size[i] = max(size.get(i, 0), len(s))
    return {i: (size[i], find(i)) for i in size}


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def edited(text, share, rng):
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in text.split())


def test_odd_texts(odd_docs, no_docs):
    assert result(near_duplicates(odd_docs)) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("salt", [2048, 4])
def test_groups_of_copies(docs_of, monkeypatch, salt):
    """A large group of near copies whose members are often not similar to each other, exact copies, chains and strangers."""
    monkeypatch.setattr(minhash, "MEMBERS_PER_SALT", salt)
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    base, texts = prose(300), []
    texts += [edited(base, 0.012, rng) for _ in range(120)] + [base] * 30
    for _ in range(20):
        chain = prose(200)
        for _ in range(4):
            texts.append(chain)
            chain = edited(chain, 0.012, rng)
    texts += [prose(80) for _ in range(60)] + ["short text"] * 5 + ["SHORT text"] * 5
    rng.shuffle(texts)
    got = result(near_duplicates(docs_of(texts)))
    assert got == brute(list(enumerate(texts)))


def test_repeated_id_joins_its_texts(docs_of):
    texts = ["a b c d e f g", "a b c d e f g", "p q r s t u v", "p q r s t u v"]
    got = result(near_duplicates(docs_of(texts, [3, 5, 5, 9])))
    assert got == {3: (3, 3), 5: (3, 3), 9: (3, 3)}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(80)]
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bounds_of_the_posterior():
    least = least_matches(0.85, 1e-6)
    assert len(least) == minhash.HASHES // minhash.BATCH and least == sorted(least)
    assert all(0 < k < 0.85 * m for k, m in zip(least, range(24, 121, 24)))
    assert least_matches(0.85, 1e-3)[-1] > least[-1]
