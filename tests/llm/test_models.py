"""Quality, language and language model scoring: held-out results and odd inputs."""

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import language, quality, suffix_tree
from footfall.llm.common import fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")}


def test_quality_on_held_out(tables):
    docs, labels = tables["documents"], tables["labels"]
    model = quality.train(docs, labels, fold("doc_id", 5) != 0)
    scored = docs.filter(fold("doc_id", 5) == 0).join(labels, "doc_id").select("quality", quality.scorer(docs, model)(F.col("text")).alias("s")).toPandas()
    good, bad = scored[scored.quality == 1].s, scored[scored.quality == 0].s
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None]).mean() > 0.97
    assert (good >= 0.3).mean() > 0.97


def test_quality_on_odd_input(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(odd_docs, none, F.lit(True))
    scores = odd_docs.select(quality.scorer(odd_docs, model)(F.col("text")).alias("s")).collect()
    assert len(scores) == odd_docs.count() and {r.s for r in scores} == {0.5}
    one = spark.createDataFrame([(4, 1), (4, 1), (7, 1), (8, None), (99, 0)], "doc_id long, quality int")
    model = quality.train(odd_docs, one, F.lit(True))
    assert all(0.5 < r.s <= 1 for r in odd_docs.select(quality.scorer(odd_docs, model)(F.col("text")).alias("s")).collect())
    assert no_docs.select(quality.scorer(no_docs, model)(F.col("text"))).count() == 0


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = np.zeros((4000, len(quality.FEATURES)))
    x[:, :2] = rng.random((4000, 2))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality.AdditiveModel(x[:3000], y[:3000])
    assert (1, 0) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.85


def test_features_are_finite():
    for text in (None, "", "a", "x" * 9999, "\x00\n\n", "| | |", "é" * 50):
        assert np.isfinite(quality.features(text)).all()


def test_language_on_held_out(tables):
    docs = tables["documents"]
    dictionaries = language.train(docs, fold("doc_id", 4) != 2)
    assert set(dictionaries) == {"en", "de", "fr", "es"} and all(len(d) <= language.DICTIONARY for d in dictionaries.values())
    found = docs.filter(fold("doc_id", 4) == 2).select("lang", language.classifier(docs, dictionaries)(F.col("text")).alias("f")).select("lang", "f.*").toPandas()
    assert (found.iloc[:, 0] == found.iloc[:, 1]).mean() > 0.96
    assert found.rejected.mean() < 0.02 and found.score.between(0, 1).all()


FINNISH = """ja on ei se että hän oli mutta kun niin kuin minä sinä hyvää päivää talo auto kissa koira metsä järvi vesi kylmä lämmin suomi ihminen elämä
kirja koulu opettaja oppilas työ raha aika vuosi kuukausi viikko yö aamu ilta ruoka leipä maito kahvi järjestelmä yliopisto kaupunki ystävä rakkaus kesäloma
sanomalehti puhelin tietokone ikkuna pöytä tuoli lattia katto keittiö makuuhuone olohuone puutarha kukka lintu kala hevonen lehmä"""


def test_language_rejects_noise_and_unlearned_languages(tables):
    docs, rng = tables["documents"], random.Random(4)
    own = language.Classifier(language.train(docs, fold("doc_id", 4) != 2))
    letter = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz")
    for n in (400, 1500, 5000):
        noise = ["".join(letter() for _ in range(n)) for _ in range(30)]
        finnish = [" ".join(rng.choice(FINNISH.split()) for _ in range(n // 5)) for _ in range(30)]
        assert sum(own(t)[3] for t in noise) == 30
        assert sum(own(t)[3] for t in finnish) >= (27 if n > 1000 else 15)  # a few dozen words tell less
    rows = [(r.text, r.lang, own(r.text)) for r in docs.filter(fold("doc_id", 4) == 2).collect()]
    long = [r for r in rows if len(language.letters(r[0] or "")) >= language.LONG]
    assert sum(r[2][3] for r in long) <= 0.005 * len(long)
    # short clean texts are kept, and a text that repeats itself is told by what it repeats
    short = [r for r in rows if r[0] and any(map(str.isalpha, r[0])) and len(language.letters(r[0])) < language.LONG]
    assert short and sum(r[2][3] for r in short) <= 0.1 * len(short)
    clean = next(r for r in long if r[1] == "fr" and not r[2][3])
    line = " ".join(clean[0].split()[:40])
    assert own("\n".join([line] * 50))[0] == "fr" and not own("\n".join([line] * 50))[3]


def test_language_score_is_that_of_the_language_named(tables):
    own = language.Classifier(language.train(tables["documents"], fold("doc_id", 4) != 2))
    for text in ("Die Katze", "the dog and the cat", "a", "el perro"):
        lang, score, margin, _ = own(text)
        sizes = np.array(own.sizes(text), float)
        weights = np.exp(-language.SHARPNESS * (sizes - sizes.min()) / sizes.min())
        assert score == pytest.approx(weights[own.langs.index(lang)] / weights.sum())


def test_language_on_odd_input(docs_of, odd_docs, no_docs):
    two = docs_of(["the cat and the dog"] * 9 + ["der hund und die katze"] * 9 + [None, "x"], langs=["en"] * 9 + ["de"] * 9 + ["fr", None])
    dictionaries = language.train(two, F.lit(True))
    assert sorted(dictionaries) == ["de", "en"]
    find = language.classifier(odd_docs, dictionaries)
    rows = odd_docs.select("text", find(F.col("text")).alias("f")).select("text", "f.*").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang in ("de", "en")) if letters else (r.lang, r.score, r.rejected) == ("und", 0.0, True)
    tie = language.Classifier(dictionaries)("zzzz")
    assert tie[0] == "de" and tie[3]
    assert language.Classifier(dictionaries)("Die Katze")[0] == "de"
    assert language.Classifier({})("word") == ("und", 0.0, 0.0, True)
    assert language.Classifier({"en": b"the cat"})("word")[:2] == ("en", 1.0)
    assert language.train(no_docs, F.lit(True)) == {}


def base_scores(rows, held):
    counts, ends = Counter(), 0
    words = lambda t: (t or "").encode().lower().split()
    for (i, t), h in zip(rows, held):
        if not h:
            counts.update(words(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + bool(ends)
    of = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    return n, [(str(i), h, len(words(t)) + 1, sum(counts[w] > 0 for w in words(t)) + bool(ends), sum(of(counts[w]) for w in words(t)) + of(ends)) for (i, t), h in zip(rows, held)]


def check_scores(docs, held_of):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n, want = base_scores(rows, [held_of(i) for i, _ in rows])
    got = suffix_tree.score(docs, fold("doc_id", 5) == 1).collect()
    assert {r.train_tokens for r in got} <= {n}
    key = lambda r: (r[0], r[2], round(r[4], 6))
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9) and np.isfinite(g[5]) and g[5] <= 1e-9
    return got


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def test_suffix_tree_base_scores(odd_docs, no_docs):
    check_scores(odd_docs, held)
    assert suffix_tree.score(no_docs, fold("doc_id", 5) == 1).count() == 0


def test_nothing_to_learn_from(docs_of):
    ids = [i for i in range(40) if held(i)][:3]
    got = check_scores(docs_of(["a b", "", None], ids), held)
    assert all(r[4] == 0 for r in got) and sorted(round(r[5] / np.log10(0.5)) for r in got) == [1, 1, 3]


def test_suffix_tree_beats_the_base(tables):
    got = pd.DataFrame(check_scores(tables["documents"], held), columns=["id", "held", "n", "known", "base", "score"])
    out = got[got.held]
    assert out.score.sum() > 0.85 * out.base.sum()


def tree_of(spark, docs, monkeypatch):
    kept = {}
    grow = suffix_tree.grow
    monkeypatch.setattr(suffix_tree, "grow", lambda *a: kept.setdefault("tree", grow(*a)))
    suffix_tree.score(docs, fold("doc_id", 5) == 1)
    return kept["tree"]


def test_contexts_are_retained_where_they_tell_something(spark, docs_of, monkeypatch):
    rng = random.Random(7)
    follow = {f"a{i}": f"b{i}" for i in range(20)}
    texts = []
    for _ in range(300):
        words = []
        for _ in range(20):
            w = rng.choice(list(follow))
            words += [w, follow[w], rng.choice(["x", "y", "z"])]
        texts.append(" ".join(words))
    tree = tree_of(spark, docs_of(texts), monkeypatch)
    assert len(tree.levels[0][0]) >= 20
    # every state's distribution sums to one: hot symbols, the end, and the unknown word
    names, left, entries, kept = tree.levels[0]
    symbols = np.flatnonzero(tree.root).astype(np.uint16)
    unknown = 1 - (10 ** tree.root[symbols]).sum()
    for at, name in enumerate(names):
        full = [np.full(len(symbols), name, np.uint64)]
        assert (10 ** tree.log10(full, symbols, 1)).sum() + unknown * 10 ** left[at] == pytest.approx(1, abs=1e-6)
    # after a context the word that follows is likely
    assert (kept > -0.2).sum() >= 20


def test_contexts_by_definition():
    stream = np.array([suffix_tree.END, 3, 4, 0, 5, suffix_tree.END, 6, suffix_tree.END], np.uint16)
    for depth in (1, 2, 3):
        for i, key in enumerate(suffix_tree.contexts(stream, depth).tolist(), 1):
            before = [int(stream[i - d]) if i >= d else 0 for d in range(1, depth + 1)]
            whole = 0 not in before and suffix_tree.END not in before[:-1]
            assert key == (sum(s << (16 * d) for d, s in enumerate(before)) if whole else 0)


def test_what_is_learnt_does_not_shrink_in_a_larger_corpus(spark, docs_of, monkeypatch):
    """A context seen a few times, over words that are rare, is kept whatever else the corpus holds."""
    rng = random.Random(4)
    pairs = [f"rare{i} word{i} then{i} last{i}" for i in range(30)]
    other = [" ".join(f"w{rng.randrange(70_000)}" for _ in range(1000)) for _ in range(400)]
    texts = [f"{p} {rng.random()}" for p in pairs for _ in range(12)]
    small, large = (tree_of(spark, docs_of(t, range(len(t))), monkeypatch) for t in (texts, texts + other))
    key = suffix_tree.word_hashes([f"rare{i}".encode() for i in range(30)])[0]
    for tree in (small, large):
        assert np.isin(key, tree.levels[0][0]).all()


def test_scores_of_a_plain_tree(docs_of):
    """Scores equal those of the same model in plain Python."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(("a b c d", "a b x", "k l", "m", f"q{rng.randrange(40)}", "c d e f")) for _ in range(30)) for _ in range(150)] + ["", None, "a b"]
    rows = list(enumerate(texts))
    runs, words = [Counter() for _ in range(5)], lambda t: ["$", *(t or "").split(), "$"]
    for i, t in rows:
        w = words(t)
        if not held(i):
            for k in range(1, 5):
                runs[k].update(tuple(w[j - k + 1 : j + 1]) for j in range(max(1, k - 1), len(w)))
    total = sum(runs[1].values())
    n1, n2 = (sum(n == v and g != ("$",) for g, n in runs[1].items()) for v in (1, 2))
    off = (n1 + 1) / (n1 + 2 * n2 + 2)
    kept, left = {}, {}

    def lp(g):
        if g in kept:
            return kept[g]
        if len(g) == 1:
            return np.log10((runs[1][g] - off) / total) if g in runs[1] else np.log10(off * len(runs[1]) / total)
        return lp(g[1:]) + left.get(g[:-1], 0)

    for k in (2, 3, 4):
        new, own, parent = {}, Counter(), Counter()
        for g, n in runs[k].items():
            m, p = runs[k - 1][g[:-1]], 10 ** lp(g[1:])
            if n > 1 and n > m * p and n * np.log2(n / (m * p)) - (n - m * p) / np.log(2) >= 20:
                new[g] = np.log10((n - 0.5) / m)
                own[g[:-1]] += (n - 0.5) / m
                parent[g[:-1]] += p
        left |= {c: np.log10(max(1 - own[c], 1e-9) / max(1 - parent[c], 1e-9)) for c in own}
        kept |= new
    assert kept and max(map(len, kept)) >= 3
    want = {i: sum(lp(tuple(w[max(0, j - 3) : j + 1])) for j in range(1, len(w))) for i, t in rows for w in [words(t)]}
    for r in suffix_tree.score(docs_of(texts), fold("doc_id", 5) == 1).collect():
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-6)


def test_quality_takes_one_row_of_each_id(spark, docs_of, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality, "AdditiveModel", lambda x, y: seen.setdefault("shape", (x.shape[0], len(y))))
    docs = docs_of(["one text here"] * 300 + ["other words", "one more"], [1] * 300 + [2, 1])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    quality.train(docs, labels, F.lit(True))
    assert seen["shape"] == (2, 2)


@pytest.mark.parametrize("per_range,per_block", [(50, 1), (1 << 20, 1), (50, 1 << 30)])
def test_runs_are_counted_alike_in_blocks_and_rows(docs_of, monkeypatch, per_range, per_block):
    monkeypatch.setattr(suffix_tree, "KEYS_PER_RANGE", per_range)
    monkeypatch.setattr(suffix_tree, "KEYS_PER_BLOCK", per_block)
    monkeypatch.setattr(suffix_tree, "KEYS_PER_TASK", 300)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randrange(30))) for _ in range(100)] + [None, "", "z"]
    docs = docs_of(texts).select("doc_id", F.col("text").cast("binary").alias("text"))
    for order in (1, 2, 3):
        for often in (1, 2, 5):
            rows = suffix_tree.count_runs(docs, order, None, 900, often).collect()
            plain = Counter()
            for t in texts:
                symbols = ["^", *(t or "").split(), "$"]
                plain.update(tuple(symbols[i : i + order]) for i in range(0 if order > 1 else 1, len(symbols) - order + 1))
            assert sorted(r.n for r in rows) == sorted(n for n in plain.values() if n >= often)
            assert len({r.key for r in rows}) == len(rows)


def test_scores_do_not_depend_on_ranges(docs_of, monkeypatch):
    rng = random.Random(12)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(80))) for _ in range(150)] * 2 + [None, "", "unseen words only"]
    docs = docs_of(texts)
    score = lambda: sorted((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in suffix_tree.score(docs, fold("doc_id", 5) == 1).collect())
    monkeypatch.setattr(suffix_tree, "HOT", 20)
    whole = score()
    monkeypatch.setattr(suffix_tree, "KEYS_PER_RANGE", 40)
    monkeypatch.setattr(suffix_tree, "PAIRS_PER_RANGE", 30)
    assert score() == whole and len(whole) == len(texts)


def test_memory_of_a_pass_is_bounded(docs_of, monkeypatch):
    """Texts are worked on by bytes, not by rows alone, and what is sent on is in blocks of few rows."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(9000)}" for _ in range(9000)).encode() for _ in range(24)]
    seen, streams = [], suffix_tree.streams
    monkeypatch.setattr(suffix_tree, "streams", lambda raw: seen.append(sum(map(len, raw))) or streams(raw))
    chunks = list(suffix_tree.scan(2, None, words=True)([pa.record_batch([pa.array(texts)], names=["text"])]))
    assert sum(seen) == sum(map(len, texts)) and max(seen) <= suffix_tree.PIECE_BYTES
    by = {kind: sum(int(c[2].sum()) for c in chunks if c[0] == kind) for kind in (suffix_tree.WORDS, suffix_tree.COUNTS)}
    assert by == {suffix_tree.WORDS: 24 * 9001, suffix_tree.COUNTS: 24 * 9001}
    for kind, *columns in chunks:
        blocks = suffix_tree.blocks_of(kind, 0, columns)
        assert max(b[2] for b in blocks) <= suffix_tree.ROWS_PER_BLOCK and sum(b[2] for b in blocks) == len(columns[0])
        opened = list(suffix_tree.opened(suffix_tree.block_table(blocks), (np.uint64, np.int64, np.uint8)))
        for i, want in enumerate(columns):
            assert np.array_equal(np.concatenate([c[i] for _, c in opened]), want)


@pytest.mark.parametrize("bits", [0, 5])
def test_filters_by_range_know_their_keys(bits):
    keys = np.sort(np.random.default_rng(2).integers(0, 1 << 64, 20_000, dtype=np.uint64))
    rows = [suffix_tree.Slices.of(suffix_tree.KNOWN, name, keys[a:b], bits) for name, a, b in suffix_tree.ranges_of(keys, bits)]
    known = suffix_tree.Slices(bits, suffix_tree.block_table(rows))
    assert known(keys).all() and known(keys + np.uint64(1)).mean() < 0.01
    places = suffix_tree.places_by_first_bits(keys[::2])(keys)
    assert (places[::2] == np.arange(10_000)).all() and (places[1::2] == -1).all()


def test_the_tree_stays_readable_after_scoring(spark, docs_of, monkeypatch):
    tree = tree_of(spark, docs_of(["a b c d"] * 40 + ["x y z"] * 40), monkeypatch)
    assert all(contexts.count() and passed.count() for contexts, passed in tree.tables[:1]) and tree.words.count() == 8
