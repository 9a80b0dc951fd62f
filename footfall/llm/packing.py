"""Packing by concatenate and cut.

All documents' ids form one long run, in the order of the tokenised table's parts. A first
pass writes that table and each part's token total; prefix sums over the totals give every
part's place in the run. A second pass cuts the run into windows of one length: a document that
crosses a window's end becomes several pieces, and those that continue are the boundary records.
Only the last window has padding.

* Null and empty texts are the end id alone. Rows without an id, and rows that repeat an id,
  are documents of their own. An empty table gives an empty result.
* A text of any length is cut into as many pieces as it needs.
* The part numbers are stored with the rows, so a task that runs again changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import PIECE_BYTES, pieces_of, written

LENGTH = 2048
ROWS = 256


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (part, start, doc_id, n, ids): ids as little-endian unsigned 16-bit values, end id included."""
    end = np.array([end_id], "<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from footfall.llm.tokenizing import encoder

        own, start = encoder(tokenizer), 0
        part = TaskContext.get().partitionId()
        for batch in chain.from_iterable(pieces_of(b, ROWS, PIECE_BYTES) for b in batches):
            ids = [x + end for x in own.encode([t or "" for t in batch.column(1).to_pylist()])]
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
            starts = start + np.cumsum(n) - n
            start += int(n.sum())
            yield pa.record_batch(
                [pa.array(np.full(len(n), part, np.int32)), pa.array(starts), batch.column(0), pa.array(n), pa.array(ids, pa.binary())],
                names=["part", "start", "doc_id", "n", "ids"],
            )

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return written(texts.mapInArrow(encode, "part int, start long, doc_id long, n long, ids binary"), "packed-ids")


def part_starts(ids: DataFrame) -> dict[int, int]:
    """Each part's place in the run. One number for each task that wrote the table reaches the driver."""
    totals = sorted((r.part, r.n) for r in ids.groupBy("part").agg(F.sum("n").alias("n")).collect())
    return {p: s for (p, _), s in zip(totals, accumulate((n for _, n in totals), initial=0))}


def cut(ids: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): ids as little-endian unsigned 32-bit values."""
    at = part_starts(ids)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces_of(b, ROWS) for b in batches):
            part, start, doc_id, n, raw = (batch.column(i) for i in range(5))
            first = np.array([at[p] for p in part.to_pylist()], np.int64) + start.to_numpy(zero_copy_only=False)
            n = n.to_numpy(zero_copy_only=False)
            window = first // length
            count = (first + n - 1) // length - window + 1
            owner = np.repeat(np.arange(len(n)), count)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(0, (window[owner] + nth) * length - first[owner])
            end = np.minimum(n[owner], (window[owner] + nth + 1) * length - first[owner])
            wide = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in raw.to_pylist()]
            yield pa.record_batch([
                doc_id.take(pa.array(owner)), pa.array(begin), pa.array(end - begin), pa.array(n[owner]),
                pa.array(window[owner] + nth), pa.array((first[owner] + begin) % length),
                pa.array([wide[o][4 * b : 4 * e] for o, b, e in zip(owner.tolist(), begin.tolist(), end.tolist())], pa.binary()),
            ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return ids.select("part", "start", "doc_id", "n", "ids").mapInArrow(pieces, schema)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents of ``docs`` (doc_id, text); see ``cut`` for the columns."""
    return cut(encoded(docs, tokenizer, end_id), length)


def boundary_records(pieces: DataFrame) -> DataFrame:
    """The pieces that continue a document from the sequence before."""
    return pieces.filter(F.col("start") > 0)


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, used): the ids of each sequence as 32-bit values, padded to ``length``.

    A sequence has at most ``length`` pieces, so no group is large.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    joined = F.aggregate(parts, F.expr("cast('' as binary)"), lambda a, b: F.concat(a, b))
    pad = F.lit(bytearray(int(pad_id).to_bytes(4, "little")) * length)
    whole = pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("used"))
    return whole.select("sequence_id", F.substring(F.concat("ids", pad), 1, 4 * length).alias("ids"), "used")
