"""Per-document sums of a value that belongs to each distinct word.

``word_counts`` counts words over all documents. ``frequencies`` counts them per document: the
most frequent words (a bounded table that every task holds) are summed at once, so that no hot
word is shuffled; every other word becomes a row (document, word, frequency). ``sum_words``
joins these rows to the words' values. Texts are handled as UTF-8 bytes, words as binary.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import ROWS_PER_BATCH, pieces_of, written

#: Words that every task may hold, and the bytes of the longest of them: 17 MB at most.
HOT_WORDS, HOT_BYTES = 262_144, 64
FLUSH = 400_000
FREQUENCY = "row long, doc_id long, n_bytes long, n_words long, x double, k long, extra double, word binary, f long"
STEPS = 16  # steps of the frequency histogram for each doubling

Cut = Callable[[bytes], list[bytes]]


def _counted(seen: Counter) -> Iterator[pa.RecordBatch]:
    words, counts = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
    for i in range(0, len(words), ROWS_PER_BATCH):
        yield pa.record_batch(
            [pa.array(words[i : i + ROWS_PER_BATCH], pa.binary()), pa.array(counts[i : i + ROWS_PER_BATCH])],
            names=["word", "n"],
        )


def word_counts(docs: DataFrame, cut: Cut) -> DataFrame:
    """(word, n) over all rows of ``docs`` (doc_id, text); counted in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(cut(text))
                if len(seen) > FLUSH:
                    yield from _counted(seen)
                    seen = Counter()
        yield from _counted(seen)

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hot_words(valued: DataFrame, limit: int = HOT_WORDS) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """The most frequent words of ``valued`` (word, n, x, k): word -> place (0 is the most frequent), and x and k by place.

    A histogram of the frequencies gives the lowest frequency that ``limit`` admits, so what
    reaches the driver is at most ``limit`` words of at most ``HOT_BYTES`` bytes.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * STEPS).cast("int")
    short = valued.filter(F.length("word") <= HOT_BYTES).withColumn("step", step)
    steps = sorted(((r.step, r.words) for r in short.groupBy("step").agg(F.count("*").alias("words")).collect()), reverse=True)
    lowest, total = math.inf, 0
    for s, words in steps:
        total += words
        if total > limit:
            break
        lowest = s
    if lowest == math.inf:
        return {}, np.zeros(1), np.zeros(1, np.int64)
    rows = short.filter(F.col("step") >= lowest).select("word", "n", "x", "k").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    places = {w: i for i, w in enumerate(rows.column("word").to_pylist())}
    return places, np.append(rows.column("x").to_numpy(), 0.0), np.append(rows.column("k").to_numpy(), 0)


def frequencies(
    docs: DataFrame,
    cut: Cut,
    hot: tuple[dict[bytes, int], np.ndarray, np.ndarray],
    extra: Callable[[dict[bytes, int]], Callable[[list[list[bytes]]], np.ndarray]] | None = None,
) -> DataFrame:
    """One head row per row of ``docs`` with the sums over its hot words, and a row for each other distinct word.

    ``extra`` makes of the hot words' places, once a task, a function that gives one more number for each text's words. The result is
    a written table, so that the rows' numbers stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, xs, ks = shared.value
        none, place = len(xs) - 1, places.get
        more = extra(places) if extra else None
        row = TaskContext.get().partitionId() << 33
        for batch in chain.from_iterable(pieces_of(b, 512) for b in batches):
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            cuts = [cut(t) for t in texts]
            counts = [Counter(c) for c in cuts]
            sizes = np.fromiter(map(len, counts), np.int64, len(counts))
            words = list(chain.from_iterable(counts))
            f = np.fromiter(chain.from_iterable(c.values() for c in counts), np.int64, len(words))
            at = np.fromiter((place(w, none) for w in words), np.int64, len(words))
            owner = np.repeat(np.arange(len(texts)), sizes)
            total = lambda v: np.bincount(owner, v, len(texts))
            rows = np.arange(row, row + len(texts))
            yield pa.record_batch([
                pa.array(rows), batch.column(0), pa.array(np.fromiter(map(len, texts), np.int64, len(texts))),
                pa.array(total(f).astype(np.int64)), pa.array(total(xs[at] * f)), pa.array(total(ks[at] * f).astype(np.int64)),
                pa.array(more(cuts) if more else np.zeros(len(texts))),
                pa.nulls(len(texts), pa.binary()), pa.nulls(len(texts), pa.int64()),
            ], names=NAMES)
            cold = np.flatnonzero(at == none)
            for i in range(0, len(cold), ROWS_PER_BATCH):
                part = cold[i : i + ROWS_PER_BATCH]
                n = len(part)
                yield pa.record_batch([
                    pa.array(rows[owner[part]]), *(pa.nulls(n, pa.int64()) for _ in range(3)), pa.nulls(n, pa.float64()),
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()),
                    pa.array([words[j] for j in part.tolist()], pa.binary()), pa.array(f[part]),
                ], names=NAMES)
            row += len(texts)

    return written(docs.select("doc_id", "text").mapInArrow(split, FREQUENCY), "word-frequencies")


def cold_rows(split: DataFrame) -> DataFrame:
    """(row, word, f) of the words that are not hot, dealt out by word: uses that take all columns share the exchange."""
    return split.filter("word is not null and row is not null").select("row", "word", "f").repartition("word")


NAMES = [c.split()[0] for c in FREQUENCY.split(", ")]


def sum_words(split: DataFrame, valued: DataFrame, x_else: float = 0.0, y_else: float = 0.0) -> DataFrame:
    """(doc_id, n_bytes, n_words, x, k, extra): per row of the documents, sums of frequency times value.

    A word that ``valued`` lacks counts ``x_else`` and 0. The other words' ``y`` of ``valued``,
    where it has one (``y_else`` if it lacks the word), is added to ``extra``.
    """
    cold = cold_rows(split)
    y = F.col("y") if "y" in valued.columns else F.lit(0.0)
    sums = (
        cold.join(valued.select("word", F.col("x").alias("wx"), y.alias("wy"), F.col("k").alias("wk")), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("f") * F.coalesce("wx", F.lit(x_else))).alias("cx"),
            F.sum(F.col("f") * F.coalesce("wy", F.lit(y_else))).alias("cy"),
            F.sum(F.col("f") * F.coalesce("wk", F.lit(0))).alias("ck"),
        )
    )
    heads = split.filter(F.col("word").isNull()).drop("word", "f")
    return heads.join(sums, "row", "left").select(
        "doc_id", "n_bytes", "n_words",
        (F.col("x") + F.coalesce("cx", F.lit(0.0))).alias("x"),
        (F.col("k") + F.coalesce("ck", F.lit(0))).alias("k"),
        (F.col("extra") + F.coalesce("cy", F.lit(0.0))).alias("extra"),
    )
