"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are word n-grams of the test items. A first pass counts in how many documents each
occurs. Every stretch of ``SPREAD`` neighbouring n-grams of an item keeps its rarest one, so a copy of any
part of an item of that many words and two is looked for, however many documents hold the item. A second pass joins the passages of
each document to the items by these seeds (a hash table that every task holds) and aligns the
words around the seeds with the whole item. A hit is an alignment that reaches a share of the
item's own score, so edited and paraphrased copies are found as well as exact ones.

Words are runs of letters and digits in lower case; marks and white space part them.

* Items shorter than the n-gram cannot be told from chance and are never reported. Null and
  empty texts have no hits. Rows without an id, and rows that repeat an id, are looked at each
  on its own. Items of equal text give a hit each. Empty tables give an empty result.
* Texts of any length are searched whole; only the words around seeds are aligned.
* Test items are held in blocks of bounded size; more items mean more passes over the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import PIECE_BYTES, pieces_of
from footfall.llm.textops import NOT_WORD, gram_hashes, word_hashes

GRAM = 3
#: Of so many neighbouring n-grams the rarest is a seed.
SPREAD = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: The least alignment score as a share of the item's score with itself.
SHARE = 0.4
GRAMS_PER_BLOCK = 1_000_000
FILTER_BITS = 22
HITS = "doc_id long, item_id long, score double, first_word int, last_word int, first_byte int, end_byte int"


def lower(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode() for t in texts]


class Items:
    """One block of test items: their words, and the seeds with the items and places they stand for."""

    def __init__(self, ids: list[int], texts: list[str]):
        words, first, _, _ = word_hashes(lower(texts), NOT_WORD)
        self.words = [words[a:b] for a, b in zip(first.tolist(), first[1:].tolist())]
        self.ids = ids
        grams = [gram_hashes(w, GRAM) for w in self.words]
        self.gram = np.concatenate([*grams, np.zeros(0, np.uint64)])
        self.item = np.repeat(np.arange(len(ids)), [len(g) for g in grams])
        self.place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, int)])
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.item, self.place = self.gram[order], self.item[order], self.place[order]
        self._index()

    def _index(self) -> None:
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.gram >> np.uint64(64 - FILTER_BITS)] = True

    def keep(self, rows: np.ndarray) -> None:
        self.gram, self.item, self.place = self.gram[rows], self.item[rows], self.place[rows]
        self._index()

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The positions in ``grams`` that are seeds, and where each one's entries begin and end."""
        at = np.flatnonzero(self.filter[grams >> np.uint64(64 - FILTER_BITS)])
        lo = np.searchsorted(self.gram, grams[at])
        hi = np.searchsorted(self.gram, grams[at], "right")
        return at[hi > lo], lo[hi > lo], hi[hi > lo]


def align(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of ``item`` with each row of ``passages``: its score and the column after its end.

    A row of the Smith-Waterman matrix at a time, for all passages; the gaps along a row follow
    from a running maximum.
    """
    n = passages.shape[1]
    slope = -GAP * np.arange(n + 1)
    row = np.zeros((len(passages), n + 1), np.int64)
    best, end = np.zeros(len(passages), np.int64), np.zeros(len(passages), np.int64)
    for word in item:
        to = np.zeros_like(row)
        to[:, 1:] = np.maximum(row[:, :-1] + np.where(passages == word, MATCH, MISMATCH), row[:, 1:] + GAP)
        np.maximum(to, 0, out=to)
        row = np.maximum.accumulate(to + slope, axis=1) - slope
        top = row.argmax(1)
        value = row[np.arange(len(row)), top]
        better = value > best
        best, end = np.where(better, value, best), np.where(better, top, end)
    return best, end


def passages(places: np.ndarray, item_places: np.ndarray, size: int, words: int) -> list[tuple[int, int]]:
    """The word ranges that may hold a copy of an item of ``size`` words, from its seeds' places in text and item."""
    out: list[tuple[int, int]] = []
    slack = size // 2
    for at, inner in sorted(zip(places.tolist(), item_places.tolist())):
        lo, hi = max(0, at - inner - slack), min(words, at - inner + size + slack)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def windows(lo: int, hi: int, size: int) -> Iterator[tuple[int, int]]:
    """A long range in overlapping parts, so that an alignment is whole in one of them."""
    step = 4 * size
    for begin in range(lo, max(lo + 1, hi - 2 * size), step):
        yield begin, min(hi, begin + step + 2 * size)


def hits_of(items: Items, texts: list[bytes]) -> Iterator[tuple[int, int, float, int, int, int, int]]:
    words, first, start, end = word_hashes(texts, NOT_WORD)
    grams = gram_hashes(words, GRAM)
    at, lo, hi = items.find(grams)
    doc = np.searchsorted(first, at, "right") - 1
    inside = at + GRAM <= first[doc + 1]
    at, lo, hi, doc = at[inside], lo[inside], hi[inside], doc[inside]
    entry = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
    at, doc = np.repeat(at, hi - lo), np.repeat(doc, hi - lo)
    item, place = items.item[entry], items.place[entry]
    order = np.lexsort((at, doc, item))
    at, doc, item, place = at[order], doc[order], item[order], place[order]
    cuts = np.flatnonzero(np.diff(item, prepend=-1) | np.diff(doc, prepend=-1))
    by_item: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
        d, i = int(doc[a]), int(item[a])
        size, base = len(items.words[i]), int(first[d])
        for x, y in passages(at[a:b] - base, place[a:b], size, int(first[d + 1]) - base):
            by_item.setdefault(i, []).extend((d, base + p, base + q) for p, q in windows(x, y, size))
    for i, found in by_item.items():
        own = items.words[i]
        best: dict[int, tuple[int, int, int]] = {}
        for k in range(0, len(found), 512):
            part = found[k : k + 512]
            width = max(q - p for _, p, q in part)
            block = np.zeros((len(part), width), np.uint64)  # no word hashes to 0 but by a chance of 2**-64
            for r, (_, p, q) in enumerate(part):
                block[r, : q - p] = words[p:q]
            score, stop = align(own, block)
            for (d, p, q), s, e in zip(part, score.tolist(), stop.tolist()):
                if s >= SHARE * MATCH * len(own) and s > best.get(d, (0, 0, 0))[0]:
                    best[d] = (s, p, e)
        for d, (s, p, e) in best.items():
            back = words[p : p + e][::-1]
            _, length = align(own[::-1], back[None, :])
            x, y = p + e - int(length[0]), p + e
            yield d, i, s / (MATCH * len(own)), x - int(first[d]), y - int(first[d]), int(start[x]), int(end[y - 1])


def seeds_kept(items: Items, frequency: dict[int, int]) -> np.ndarray:
    """Which entries stay: the rarest of every ``SPREAD`` neighbours in its item (the first of those that tie), all of shorter items."""
    df = np.array([frequency.get(int(g), 0) for g in items.gram.view(np.int64)], np.int64)
    keep = np.zeros(len(df), bool)
    order = np.lexsort((items.place, items.item))
    item, df = items.item[order], df[order]
    if len(order) < SPREAD:
        keep[:] = True
        return keep
    windows = np.lib.stride_tricks.sliding_window_view(df, SPREAD)
    whole = item[: len(windows)] == item[SPREAD - 1 :]
    first = np.flatnonzero(whole)
    keep[order[first + windows[first].argmin(1)]] = True
    short = np.bincount(items.item, minlength=len(items.ids)) < SPREAD
    return keep | short[items.item]


def _seed(docs: DataFrame, items: Items) -> Items:
    """Leaves ``items`` with the seeds that the frequencies in ``docs`` choose."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value.gram), np.int64)
        for batch in chain.from_iterable(pieces_of(b, 256, PIECE_BYTES) for b in batches):
            words, first, _, _ = word_hashes(lower(batch.column(1).to_pylist()), NOT_WORD)
            at, lo, _ = shared.value.find(gram_hashes(words, GRAM))
            doc = np.searchsorted(first, at, "right") - 1
            pairs = np.unique(doc[at + GRAM <= first[doc + 1]] * len(total) + lo[at + GRAM <= first[doc + 1]])
            total += np.bincount(pairs % max(1, len(total)), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(shared.value.gram[some].view(np.int64)), pa.array(total[some])], names=["gram", "n"])

    seen = docs.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    frequency = dict(zip(seen.column("gram").to_pylist(), seen.column("n").to_pylist()))
    items.keep(seeds_kept(items, frequency))
    return items


def _search(docs: DataFrame, items: Items) -> DataFrame:
    seeded = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces_of(b, 256, PIECE_BYTES) for b in batches):
            rows = list(hits_of(seeded.value, lower(batch.column(1).to_pylist())))
            columns = list(zip(*rows)) or [()] * 7
            ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            yield pa.record_batch([
                ids, pa.array([seeded.value.ids[i] for i in columns[1]], pa.int64()), pa.array(columns[2], pa.float64()),
                *(pa.array(c, pa.int32()) for c in columns[3:]),
            ], names=[c.split()[0] for c in HITS.split(", ")])

    return docs.mapInArrow(search, HITS)


def item_blocks(benchmark: DataFrame, item_col: str, item_text: str) -> Iterator[Items]:
    """The test items in blocks of bounded size."""
    items = benchmark.select(benchmark[item_col].cast("long").alias("item_id"), benchmark[item_text].cast("string").alias("text"))
    items = items.filter(F.coalesce(F.length("text"), F.lit(0)) > 0)
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // (4 * GRAMS_PER_BLOCK))
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        held = Items([r.item_id for r in part], [r.text for r in part])
        if len(held.gram):
            yield held


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each document and test item it holds: score (1: whole copy) and where, in words and bytes.

    Bytes are those of the lower-cased text.
    """
    texts = id_and_text(docs, id_col, text_col)
    found = texts.sparkSession.createDataFrame([], HITS)
    for held in item_blocks(benchmark, item_col, item_text):
        found = found.union(_search(texts, _seed(texts, held)))
    return found


def marker(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> Callable[[Column], Column]:
    """A function from a text column to whether the text holds a test item; seeds are chosen by ``docs``."""
    texts = id_and_text(docs, id_col, text_col)
    tests = []
    for held in item_blocks(benchmark, item_col, item_text):
        tests.append(_holds(docs, _seed(texts, held)))
    return lambda text: reduce(Column.__or__, (test(text) for test in tests), F.lit(False))


def _holds(docs: DataFrame, items: Items) -> Callable[[Column], Column]:
    seeded = docs.sparkSession.sparkContext.broadcast(items)

    @F.pandas_udf("boolean")
    def holds(text: pd.Series) -> pd.Series:
        out = np.zeros(len(text), bool)
        for lo in range(0, len(text), 256):
            out[[lo + hit[0] for hit in hits_of(seeded.value, lower(text.iloc[lo : lo + 256].tolist()))]] = True
        return pd.Series(out)

    return holds
