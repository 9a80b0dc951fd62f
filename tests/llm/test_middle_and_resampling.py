"""Fill-in-the-middle and importance resampling against plain versions, and odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import fim, queries, resampling

SF = "/root/testdata/sf0.001"


def plain_fim(doc_id, text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if not text or re.search("<[PSM]>", text):
        return len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(st.sampled_from("a\n é日<PSM>"), max_size=60))
def test_cut_and_restore(doc_id, text):
    row = fim.transformed(doc_id, text)
    assert row == plain_fim(doc_id, text)
    assert fim.restored(row[4], row[1]) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 5), st.integers(1, 10_000)), max_size=400), st.sampled_from([1, 2, 16, 127]))
def test_index_gives_every_offset(sizes, error):
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    index = fim.RankIndex.fit(offsets, error)
    assert [index.offset(k) for k in range(len(offsets))] == offsets.tolist()
    assert all(abs(index.predicted(k) - o) <= error for k, o in enumerate(offsets.tolist()))


def test_index_of_even_lines_is_one_segment():
    index = fim.RankIndex.fit(np.arange(0, 800_000, 80))
    assert len(index.first) == 1 and not index.residuals.any()


def test_fill_in_middle_on_odd_input(odd_docs, no_docs, docs_of):
    long = docs_of(["line é\n" * 60_000 + "end", "\n" * 10_000, "a <M> b\nc"], [7, 8, 9])
    for docs in (odd_docs, long):
        rows = fim.restore(fim.fill_in_middle(docs)).collect()
        got = sorted(repr((r.doc_id, r.restored, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in rows)
        assert got == sorted(repr((r.doc_id, r.text or "", *plain_fim(r.doc_id, r.text or ""))) for r in docs.collect())
    assert fim.restore(fim.fill_in_middle(no_docs)).count() == 0
    assert {r.form for r in fim.fill_in_middle(long, rate=0).collect()} == {"plain"}


def test_fill_in_middle_query(spark):
    df = queries.RUNS["op12_fill_in_middle"](spark, SF)
    assert df.dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        *row, output = plain_fim(r.doc_id, r.text or "")
        want[r.doc_id] = (*row, sha(output), sha(r.text or ""))
    assert {r.doc_id: tuple(r)[1:] for r in df.collect()} == want


WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORDS.findall((text or "").encode().lower())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=1, max_size=300), max_size=8), max_size=4), st.integers(1, 3))
def test_gram_crcs_are_those_of_the_substrings(words, high):
    for n, (crcs, owner) in enumerate(resampling.gram_crcs(words, 1, high), 1):
        want = [(zlib.crc32(b" ".join(w[i : i + n])), k) for k, w in enumerate(words) for i in range(len(w) - n + 1)]
        assert list(zip(crcs.tolist(), owner.tolist())) == want


def plain_resample(docs, target, percent=10, low=1, high=1, buckets=10_000, least=20):
    def buckets_of(text):
        w = plain_words(text)
        return [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text))
    for text in target:
        t.update(buckets_of(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for i, text in docs:
        f = buckets_of(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(f), weight, score, len(plain_words(text)) >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0], -r[2], -r[1]))
    k = percent * len(order) // 100
    return sorted(repr((*r[:4], n if n <= k else None)) for n, r in enumerate(order, 1)) + sorted(repr((*r[:4], None)) for r in rows if not r[4])


@pytest.mark.parametrize("low,high,buckets,percent", [(1, 1, 10_000, 10), (1, 2, 70_000, 50), (2, 3, 7, 100), (1, 1, 10_000, 0)])
def test_resampling(spark, docs_of, odd_docs, low, high, buckets, percent):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["Alpha", "beta", "gamma-delta", "日本", "é", "x9"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = docs_of(texts + texts[:3], [*range(300), 0, 1, None]).unionByName(odd_docs)
    target = ["alpha beta", "é é 日本 x9", None, ""]
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, low, high, buckets)
    want = plain_resample([(r.doc_id, r.text) for r in docs.collect()], target, percent, low, high, buckets)
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(want)


def test_resampling_without_rows(no_docs, docs_of):
    assert resampling.resample(no_docs, no_docs).count() == 0
    rows = resampling.resample(docs_of(["one two " * 20, ""]), no_docs, 100).collect()
    assert sorted((r.n_features, r.rank) for r in rows) == [(0, None), (40, 1)]


def test_resampling_query(spark):
    df = queries.RUNS["op13_resampling"](spark, SF)
    assert df.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("text")).collect()]
    assert sorted(repr(tuple(r)) for r in df.collect()) == sorted(plain_resample(docs, target))
