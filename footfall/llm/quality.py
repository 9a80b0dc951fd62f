"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a few numbers, each is binned, and every feature has a look-up table over its
bins; chosen pairs of features have tables over pairs of coarser bins. A score is the logistic
of the sum of the look-ups. Training boosts shallow trees in turns: feature after feature, round after
round, a tree of few leaves on that feature alone is fitted to what is left and added to its
table; then the pairs that gain most, in the same way.

* Null and empty texts have a row of zeros for features and are scored like others.
* Labels other than 0 count as 1, null labels not at all. Of several labels of one id the
  smallest counts. Without labels every score is 0.5; with one class alone the score is near it.
* Rows without an id, and rows that repeat an id, are scored each on its own. An empty table
  gives an empty result.
* Training uses at most ``SAMPLE`` labelled rows, chosen by hash; scoring reads whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 12_000
BINS, COARSE = 64, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 8
RATE, LEAVES, LEAST, RIDGE = 0.15, 4, 20, 1.0
FEATURES = [
    "log_chars", "log_words", "word_length", "upper", "digit", "mark", "symbol", "white", "other", "distinct_words", "top_word",
    "repeated_lines", "words_with_symbol", "words_all_upper", "sentence_ends", "line_length", "bars", "compressed",
]

_upper, _digit, _white, _stop, _bar, _mark, _symbol = (np.zeros(256, bool) for _ in range(7))
_upper[65:91] = _digit[48:58] = True
_white[[9, 10, 11, 12, 13, 32]] = _bar[124] = True
_stop[[33, 46, 63]] = _mark[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = True
_symbol[[i for i in range(33, 127) if not chr(i).isalnum()]] = True
_symbol &= ~_mark
_has_symbol = re.compile(rb"[#$%&*+/<=>@\\^_`{|}~!]{2,}\S*\s|[#$%&*]\s").findall


def features(text: str | None) -> np.ndarray:
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, w = len(raw), len(words)
    share = lambda which: counts[which].sum() / n
    seen = Counter(words)
    lines = [line for line in raw.split(b"\n") if line]
    out[:] = (
        np.log(n), np.log(w), (n - counts[_white].sum()) / w, share(_upper), share(_digit), share(_mark), share(_symbol), share(_white),
        counts[128:].sum() / n, len(seen) / w, max(seen.values()) / w, 1 - len(set(lines)) / max(1, len(lines)),
        len(_has_symbol(raw + b" ")) / w, sum(map(bytes.isupper, words)) / w, counts[_stop].sum() / w, n / max(1, len(lines)),
        counts[_bar].sum() / w, len(zlib.compress(raw, 1)) / n,
    )
    return out


def _tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A value for each bin from a tree of at most ``LEAVES`` leaves that splits the ordered bins."""
    g, h, n = (np.append(0, np.cumsum(x)) for x in (gradient, weight, rows))
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)
    leaves = [(0, len(gradient))]
    for _ in range(LEAVES - 1):
        best = (1e-9, None, None)
        for leaf in leaves:
            a, b = leaf
            at = np.arange(a + 1, b)
            at = at[(n[at] - n[a] >= LEAST) & (n[b] - n[at] >= LEAST)]
            if len(at):
                gain = worth(a, at) + worth(at, b) - worth(a, b)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], leaf, int(at[i]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gradient))
    for a, b in leaves:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return out


class AdditiveModel:
    """Look-up tables by feature and by pair of features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        quantiles = lambda bins: [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else c for c in x.T]
        self.edges, self.coarse = quantiles(BINS), quantiles(COARSE)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if not len(y):
            self.start = 0.0
            return
        rate = (y.sum() + 1) / (len(y) + 2)
        self.start = float(np.log(rate / (1 - rate)))
        bins = self._bins(x, self.edges)
        total = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                total = self._step(bins[f], table, y, total)
        cells = self._bins(x, self.coarse)
        widths = [len(e) + 1 for e in self.coarse]
        self.pairs = self._best_pairs(cells, widths, y, total)
        self.pair_tables = [np.zeros(widths[a] * widths[b]) for a, b in self.pairs]
        joint = [cells[a] * widths[b] + cells[b] for a, b in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (a, b), at, table in zip(self.pairs, joint, self.pair_tables):
                total = self._pair_step(at, widths[a], widths[b], table, y, total)

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, "right") for e, c in zip(edges, x.T)]

    @staticmethod
    def _sums(at: np.ndarray, size: int, y: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size), np.bincount(at, minlength=size)

    def _step(self, at: np.ndarray, table: np.ndarray, y: np.ndarray, total: np.ndarray) -> np.ndarray:
        step = RATE * _tree(*self._sums(at, len(table), y, total))
        table += step
        return total + step[at]

    def _pair_step(self, at, rows: int, columns: int, table: np.ndarray, y: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Splits the rows first, then the columns within each part."""
        g, h, n = (s.reshape(rows, columns) for s in self._sums(at, len(table), y, total))
        by_row = _tree(g.sum(1), h.sum(1), n.sum(1))
        step = np.zeros((rows, columns))
        for value in np.unique(by_row):
            part = by_row == value
            step[part] = _tree(g[part].sum(0), h[part].sum(0), n[part].sum(0))
        step = RATE * step.ravel()
        table += step
        return total + step[at]

    def _best_pairs(self, cells, widths, y, total) -> list[tuple[int, int]]:
        gains = []
        for a in range(len(cells)):
            for b in range(a):
                g, h, _ = self._sums(cells[a] * widths[b] + cells[b], widths[a] * widths[b], y, total)
                gains.append(((g**2 / (h + RIDGE)).sum(), a, b))
        return [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for at, table in zip(self._bins(x, self.edges), self.tables):
            total += table[at]
        cells = self._bins(x, self.coarse)
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[cells[a] * (len(self.coarse[b]) + 1) + cells[b]]
        return 1 / (1 + np.exp(-total))


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> AdditiveModel:
    """The model of the labelled rows that ``learn`` (over ``doc_id``) names."""
    marks = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("y"))
    marks = marks.filter(F.coalesce(learn, F.lit(False)) & F.col("y").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    @F.pandas_udf("array<double>")
    def feature_row(text: pd.Series) -> pd.Series:
        return pd.Series(list(matrix(text)), dtype=object)

    # at most SAMPLE pairs of numbers are sent to the tasks, and as many rows of numbers come back
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", F.xxhash64("text").alias("h"), feature_row("text").alias("x"))
    # of rows that repeat an id, one
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("h", "y", "x")).alias("r")).select("doc_id", "r.y", "r.x").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.array(rows.x.tolist()).reshape(-1, len(FEATURES))
    return AdditiveModel(x, (rows.y.to_numpy() != 0).astype(float))


def scorer(docs: DataFrame, model: AdditiveModel) -> Callable[[Column], Column]:
    """A function from a text column to its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(matrix(texts)))

    return score
