"""Exact top-k inner-product search by distributed histogram selection.

Queries are taken in blocks of bounded size, and each block meets all vectors. For a block,
every task scores its vectors and counts the scores of each query in bins; the summed counts
show the bin that holds the k-th best score, which the next pass cuts finer, until the bin is
one value wide. A last pass keeps the scores above the k-th value, and of those equal to it
those with the smallest ids. A task counts only the bins from its own k-th best score up: the
k-th best of all is never below that, so the counts that decide are whole.

Integer components are ``floor(scale * x)`` of each component x as a double.

* A vector that is null, or holds a null or a component that is not finite, takes no part.
* Shorter vectors count as if filled with zeros. An empty vector scores 0 with all others.
* A candidate with the query's own id is not taken; other rows that repeat an id are rows of
  their own. Of queries that repeat an id the one with the smallest vector counts. Rows without an id take no part.
* A query with fewer candidates than k gets all of them. Ties go to the smaller id.
* Scores beyond 64 bits are held at the largest or smallest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import written

QUERIES_PER_BLOCK = 2048
BINS = 1024
VECTORS_PER_STEP = 1024
LONG = np.iinfo(np.int64)


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): whole components as doubles, for the rows that take part."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    whole = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~odd)
    # floor() of a double is a long; beyond that range a double has no fraction left
    floor = lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
    return whole.select("vec_id", F.transform("v", lambda x: floor(x * float(scale))).alias("v"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), sizes)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = columns < width  # the query has zeros beyond its width
    out[rows[inside], columns[inside]] = flat[inside]
    return out


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where they fit, else in Python's integers."""
    bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, queries.shape[1])
    if bound < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = np.dot(whole(queries), whole(vectors).T)
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


class Block:
    """The queries of one block, sent to every task."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors

    def scores(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(vector ids, scores by query and vector, which of them count)."""
        for batch in batches:
            for lo in range(0, batch.num_rows, VECTORS_PER_STEP):
                part = batch.slice(lo, VECTORS_PER_STEP)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                yield ids, products(self.vectors, matrix(part.column(1), self.vectors.shape[1])), ids[None, :] != self.ids[:, None]


def _passes(vectors: DataFrame, block: Block, k: int) -> DataFrame:
    spark, n = vectors.sparkSession, len(block.ids)
    shared = spark.sparkContext.broadcast(block)

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, count = np.full(n, LONG.max), np.full(n, LONG.min), np.zeros(n, np.int64)
        for _, scores, mine in shared.value.scores(batches):
            low = np.minimum(low, np.where(mine, scores, LONG.max).min(1))
            high = np.maximum(high, np.where(mine, scores, LONG.min).max(1))
            count += mine.sum(1)
        yield pa.record_batch([pa.array(np.arange(n)), pa.array(low), pa.array(high), pa.array(count)], names=["q", "low", "high", "n"])

    ends = (
        vectors.mapInArrow(extent, "q long, low long, high long, n long")
        .groupBy("q").agg(F.min("low"), F.max("high"), F.sum("n")).toPandas().sort_values("q").to_numpy()
    )
    # Python integers: the span of two longs may not fit in one
    low, high, found = ([int(x) for x in ends[:, i]] for i in (1, 2, 3))
    need = [min(k, f) for f in found]
    state = [(lo, hi + 1, w) if w else (0, 1, 0) for lo, hi, w in zip(low, high, need)]  # bounds, still needed in them

    while any(hi - lo > 1 for lo, hi, w in state):
        widths = [max(1, -(-(hi - lo) // BINS)) for lo, hi, _ in state]
        lows, tops, steps = (np.array(x, object) for x in ([s[0] for s in state], [s[1] - 1 for s in state], widths))
        lows, tops, steps = lows.astype(np.int64), tops.astype(np.int64), np.array([min(w, LONG.max) for w in widths], np.int64)
        wants = np.array([w for _, _, w in state])

        def count(batches, lows=lows, tops=tops, steps=steps, wants=wants) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((n, BINS), np.int64)
            for _, scores, mine in shared.value.scores(batches):
                inside = mine & (scores >= lows[:, None]) & (scores <= tops[:, None])
                q, v = np.nonzero(inside)
                place = (scores[q, v].astype(np.uint64) - lows[q].astype(np.uint64)) // steps[q].astype(np.uint64)
                counts += np.bincount(q * BINS + place.astype(np.int64), minlength=n * BINS).reshape(n, BINS)
            above = counts[:, ::-1].cumsum(1)[:, ::-1] - counts
            q, b = np.nonzero((counts > 0) & (above < wants[:, None]))
            yield pa.record_batch([pa.array(q), pa.array(b), pa.array(counts[q, b])], names=["q", "b", "n"])

        rows = vectors.mapInArrow(count, "q long, b long, n long").groupBy("q", "b").agg(F.sum("n").alias("n")).toPandas()
        bins: dict[int, dict[int, int]] = {}
        for q, b, c in rows.itertuples(index=False):
            bins.setdefault(int(q), {})[int(b)] = int(c)
        for q, (lo, hi, want) in enumerate(state):
            if hi - lo > 1 and want:
                for b in sorted(bins[q], reverse=True):
                    if bins[q][b] >= want:
                        begin = lo + b * widths[q]
                        state[q] = (begin, min(hi, begin + widths[q]), want)
                        break
                    want -= bins[q][b]

    kth = np.array([lo for lo, _, _ in state], np.int64)
    ties = np.array([w for _, _, w in state])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        equal: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        for ids, scores, mine in shared.value.scores(batches):
            q, v = np.nonzero(mine & (scores > kth[:, None]) & (ties[:, None] > 0))
            yield pa.record_batch([pa.array(shared.value.ids[q]), pa.array(ids[v]), pa.array(scores[q, v])], names=NAMES)
            same = mine & (scores == kth[:, None]) & (ties[:, None] > 0)
            for i in np.flatnonzero(same.any(1)).tolist():
                equal[i] = np.sort(np.append(equal[i], ids[same[i]]))[: ties[i]]
        sizes = [len(x) for x in equal]
        q = np.repeat(np.arange(n), sizes)
        yield pa.record_batch([pa.array(shared.value.ids[q]), pa.array(np.concatenate([*equal, np.zeros(0, np.int64)])), pa.array(kth[q])], names=NAMES)

    return vectors.mapInArrow(keep, "query_id long, vec_id long, score long")


NAMES = ["query_id", "vec_id", "score"]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows that ``is_query`` (over ``vec_id``) names, against all rows."""
    whole = integer_vectors(vectors, scale, id_col, vector_col)
    queries = written(whole.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = -(-queries.count() // QUERIES_PER_BLOCK)
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks))))
    found = None
    for b in range(blocks):
        rows = numbered.filter(F.col("block") == b).orderBy("vec_id").toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        lists = rows.column("v").chunk(0)
        width = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
        block = Block(rows.column("vec_id").to_numpy(), matrix(lists, max(1, width)))
        kept = _passes(whole, block, k)
        found = kept if found is None else found.union(kept)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
