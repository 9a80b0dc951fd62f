"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import ship, written  # noqa: F401  (the operators cut lineage with ``written``)

ROWS_PER_BATCH = 50_000
#: Text that is worked on at once: arrays over its bytes take some hundred times as much memory.
PIECE_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % folds


def pieces_of(batch: pa.RecordBatch, rows: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Short runs of a batch's rows, so that what Python makes of them stays small: of ``rows`` at most, and of one row or ``most`` bytes of text."""
    until = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns if most else []:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            until += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    until, start = np.cumsum(until), 0
    while start < batch.num_rows:
        end = start + rows
        if most:
            fits = most + (until[start - 1] if start else 0)
            end = min(end, max(start + 1, int(np.searchsorted(until, fits, "right"))))
        yield batch.slice(start, end - start)
        start = end


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text as UTF-8 bytes); whatever else the frame holds stays behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("binary").alias("text"))
