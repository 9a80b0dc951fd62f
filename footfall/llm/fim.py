"""Fill-in-the-middle: every document cut at two of its unit boundaries, found by a learned rank index.

A document's units are its lines. A rank index maps a boundary's rank (0 before the first unit, n
after the last) to its offset in the text: straight segments that miss no offset by more than
``ERROR``, and for each boundary the residual that the segment leaves. A cut is predicted by the
segment of its rank and put right by the stored residual, so it is exact. Two ranks drawn from a
hash of the document's id cut it into prefix, middle and suffix, which are written in the order
prefix, suffix, middle (psm) or suffix, prefix, middle (spm), each behind its mark.

* Offsets count code points. Null texts are empty; an empty text has no unit and stays plain.
* A text that holds one of the marks, or that the rate leaves out, stays plain: it could not be
  taken apart again otherwise, as the marks found first would not be those put in.
* A null id is hashed as the empty text; rows that repeat an id are cut alike, each in its own text.
* Texts of any length are cut whole. An empty table gives an empty result. Extra columns stay behind.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.common import pieces_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Residuals fit a signed byte.
ERROR = 127
SEED, RATE, SPM_RATE = 7, 100, 50
ROWS = 256


@dataclass
class RankIndex:
    """Offsets by rank: segment k covers the ranks from ``first[k]`` on, from ``base[k]`` at ``slope[k]`` a rank."""

    first: list[int]
    base: list[int]
    slope: list[float]
    residuals: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """Segments as long as the cone of slopes that keep every offset within ``error`` stays open."""
        first, base, slope = [], [], []
        start, n = 0, len(offsets)
        while start < n:
            low, high, end, step = -np.inf, np.inf, start + 1, 64
            while end < n:  # a stretch at a time: running bounds tell where the cone closes
                ranks = np.arange(end, min(n, end + step))
                rise, run = offsets[ranks] - offsets[start], ranks - start
                lows = np.maximum.accumulate(np.maximum((rise - (error - 1)) / run, low))
                highs = np.minimum.accumulate(np.minimum((rise + (error - 1)) / run, high))
                closed = np.flatnonzero(lows > highs)
                good = closed[0] if len(closed) else len(ranks)
                if good:
                    low, high, end = lows[good - 1], highs[good - 1], end + int(good)
                if len(closed):
                    break
                step *= 2
            first.append(start)
            base.append(int(offsets[start]))
            slope.append(float(low + high) / 2 if end > start + 1 else 0.0)
            start = end
        index = cls(first, base, slope, np.zeros(n, np.int8))
        spread = np.diff([*first, n])
        ranks = np.arange(n)
        guess = np.repeat(base, spread) + np.rint(np.repeat(slope, spread) * (ranks - np.repeat(first, spread))).astype(np.int64)
        index.residuals = (offsets - guess).astype(np.int8)
        return index

    def predicted(self, rank: int) -> int:
        k = bisect_right(self.first, rank) - 1
        return self.base[k] + int(np.rint(self.slope[k] * (rank - self.first[k])))

    def offset(self, rank: int) -> int:
        return self.predicted(rank) + int(self.residuals[rank])


def boundaries(text: str) -> np.ndarray:
    """Offsets of all unit boundaries: 0, and the end of every line; n units have n + 1 boundaries."""
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8)
    else:
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(points == 10) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    return np.concatenate([[0], ends]).astype(np.int64)


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


def transformed(doc_id: int | None, text: str, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of one document."""
    index = RankIndex.fit(boundaries(text))
    n = len(index.residuals) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = index.offset(low), index.offset(high)
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
    return n, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"


def restored(output: str, form: str) -> str:
    """The text that ``transformed`` had, from its output and form alone."""
    if form == "plain":
        return output
    outer, inner = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, _, rest = output[len(outer) :].partition(inner)
    two, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``; one pass, no shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces_of(b, ROWS) for b in batches):
            ids = batch.column(0).to_pylist()
            rows = [transformed(i, t or "", seed, rate, spm_rate) for i, t in zip(ids, batch.column(1).to_pylist())]
            n, form, prefix, middle, output = zip(*rows)
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return texts.mapInArrow(cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` (output, form, more columns) with the texts rebuilt, as column ``restored``."""
    schema = rows.select("*").schema.add("restored", "string")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces_of(b, ROWS) for b in batches):
            outputs, forms = batch.column(batch.schema.get_field_index("output")), batch.column(batch.schema.get_field_index("form"))
            texts = pa.array([restored(o, f) for o, f in zip(outputs.to_pylist(), forms.to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "restored"])

    return rows.mapInArrow(rebuild, schema)
