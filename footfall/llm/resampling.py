"""Importance resampling of documents towards a target, by hashed word n-grams.

A document's words are joined by one blank each. The joined text is scanned once with a running
CRC-32, kept at the ends of all words. The CRC of any substring, so of any n-gram, follows from
the CRCs of two prefixes: the earlier one is shifted over the length of the substring (a linear
map over GF(2)) and cancelled from the later one. An n-gram's bucket is its CRC modulo ``buckets``.

Bucket counts of all documents and of the target give each bucket's gain, the scaled log ratio
of its smoothed shares. A document's weight is the mean gain of its features; with a Gumbel
number made of its id it becomes its score, and the documents of the highest scores are drawn:
a sample without replacement in proportion to the importance weights.

* Null texts have no words, and a document without features has weight 0. Documents of fewer than
  ``least`` words are scored, but not drawn.
* A null id is hashed as the empty text and comes after all others in ties. Rows that repeat an id
  are documents of their own; those that tie in score and id are ordered by weight and features, and are alike if these tie too.
* Texts of any length are scanned whole. Empty tables count nothing: gains are then those of the
  smoothing alone, and an empty table of documents gives an empty result. Extra columns stay behind.
* What reaches the driver is bounded: one count a bucket, and one a distinct score. Scores are whole
  numbers; weights lie within the largest gain and Gumbel numbers between -3,100 and 22,900.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import id_text, pieces_of, written

BUCKETS = 10_000
LEAST_WORDS = 20
SEED = 2024
ROWS = 512
#: Letters in lower case; digits, letters and all bytes of longer characters stay; the rest parts words.
_KEPT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
_POLYNOMIAL = 0xEDB88320  # fixed value: the reflected polynomial of CRC-32


@lru_cache(1)
def _byte_steps() -> np.ndarray:
    """What eight zero bits make of each register that holds one byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> np.uint32(1)) ^ (np.uint32(_POLYNOMIAL) * (steps & np.uint32(1)))
    return steps


def _apply(shift: np.ndarray, registers: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit registers, given by its values on the four bytes' places (4 x 256)."""
    out = shift[0][registers & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= shift[k][(registers >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@lru_cache(64)
def _shift(power: int) -> np.ndarray:
    """The map that moves a register over 2**power zero bytes."""
    places = np.arange(256, dtype=np.uint32)[None] << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    if power == 0:
        return (places >> np.uint32(8)) ^ _byte_steps()[places & np.uint32(255)]
    half = _shift(power - 1)
    return _apply(half, _apply(half, places))


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC moved over as many zero bytes as its length says: by squares, a bit of the length at a time."""
    out = crcs.copy()
    for power in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero((lengths >> power) & 1)
        out[at] = _apply(_shift(power), out[at])
    return out


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split()


def prefix_crcs(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For the words of all texts in a row: the running CRC of the joined text before each word and after it."""
    crc32 = zlib.crc32
    after = np.fromiter(
        chain.from_iterable(accumulate(w[1:], lambda crc, word: crc32(word, crc32(b" ", crc)), initial=crc32(w[0])) for w in words if w),
        np.uint32, sum(map(len, words)),
    )
    before = np.zeros_like(after)
    flipped = ~after[:-1]  # the register itself: CRC-32 starts from and ends with the complement
    before[1:] = ~((flipped >> np.uint32(8)) ^ _byte_steps()[(flipped ^ np.uint32(32)) & np.uint32(255)])
    first = np.cumsum([0, *map(len, words)])[:-1]
    before[first[[bool(w) for w in words]]] = 0
    return before, after


def gram_crcs(words: list[list[bytes]], low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from ``low`` to ``high`` words: the CRCs of all n-grams, and the text that each is of."""
    before, after = prefix_crcs(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    lengths = np.fromiter(map(len, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    ends = np.cumsum(lengths + 1) - 1
    owner = np.repeat(np.arange(len(words)), sizes)
    last = np.repeat(np.cumsum(sizes), sizes)
    out = []
    for n in range(low, high + 1):
        at = np.flatnonzero(np.arange(len(owner)) + n <= last)
        to = at + n - 1
        out.append((after[to] ^ shifted(before[at], ends[to] - (ends[at] - lengths[at])), owner[at]))
    return out


def hashed(docs: DataFrame, low: int, high: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_words, n_features, features): the buckets as little-endian unsigned 16- or 32-bit values."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces_of(b, ROWS) for b in batches):
            words = [words_of(t or b"") for t in batch.column(1).to_pylist()]
            parts = [[] for _ in words]
            for crcs, owner in gram_crcs(words, low, high):
                cells, cuts = (crcs % np.uint32(buckets)).astype(kind), np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
                for part, a, b in zip(parts, cuts, cuts[1:]):
                    part.append(cells[a:b].tobytes())
            features = [b"".join(p) for p in parts]
            yield pa.record_batch([
                batch.column(0), pa.array(list(map(len, words)), pa.int64()),
                pa.array([len(f) // np.dtype(kind).itemsize for f in features], pa.int64()), pa.array(features, pa.binary()),
            ], names=["doc_id", "n_words", "n_features", "features"])

    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(scan, "doc_id long, n_words long, n_features long, features binary")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall in each bucket, counted in every task and then summed."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in chain.from_iterable(pieces_of(b, ROWS) for b in batches):
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    # at most one row a bucket
    for row in features.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    total_s, total_t, buckets = int(source.sum()), int(target.sum()), len(source)
    top, below = (target + 1) * (total_s + buckets), (source + 1) * (total_t + buckets)
    return np.array([math.floor(1000 * math.log(a / b)) for a, b in zip(top.tolist(), below.tolist())], np.int64)


def scored(features: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    shared = features.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            sums = [int(table[np.frombuffer(raw, kind)].sum()) for raw in batch.column(3).to_pylist()]
            weight = [s // n if n else 0 for s, n in zip(sums, batch.column(2).to_pylist())]
            yield pa.record_batch([*batch.columns[:3], pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    rows = features.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    gumbel = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", (F.col("weight") + gumbel).cast("long"))


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``rank``, from 1: the ``k`` highest scores, ties to the smaller id; null for all others.

    The lowest score drawn comes from the counts of all scores. The rows from it on are dealt out by
    range and sorted; each part's rows are numbered inside it, and part sizes give the parts' places.
    """
    counts = sorted(((r.score, r.n) for r in rows.filter("may_be_drawn").groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    lowest = next((s for (s, _), above in zip(counts, accumulate(n for _, n in counts)) if above >= k), counts[-1][0] if counts else 0)
    inside = F.col("may_be_drawn") & (F.col("score") >= lowest) & F.lit(k > 0)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    dealt = rows.filter(inside).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = written(dealt, "resampled")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r.part, r.n) for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row a part
    starts = [(p, s) for (p, _), s in zip(sizes, accumulate((n for _, n in sizes), initial=0))]
    starts = dealt.sparkSession.createDataFrame(starts, "part long, before long")
    rank = F.col("before") + place + 1
    drawn = dealt.join(F.broadcast(starts), part == F.col("part")).withColumn("rank", F.when(rank <= k, rank)).select(*rows.columns, "rank")
    return rows.filter(~inside).withColumn("rank", F.lit(None).cast("long")).unionByName(drawn)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, low: int = 1, high: int = 1, buckets: int = BUCKETS, least: int = LEAST_WORDS,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null for documents that are not drawn."""
    features = written(hashed(docs, low, high, buckets, id_col, text_col), "resampling-features")
    aim = hashed(target.select(F.lit(0).alias("doc_id"), target[target_text].alias("text")), low, high, buckets, "doc_id", "text")
    gain = gains(bucket_counts(features, buckets), bucket_counts(aim, buckets))
    rows = written(scored(features, gain, seed).withColumn("may_be_drawn", F.col("n_words") >= least), "resampling-scores")
    n = rows.filter("may_be_drawn").count()
    return ranked(rows, percent * n // 100).select("doc_id", "n_features", "weight", "score", "rank")
