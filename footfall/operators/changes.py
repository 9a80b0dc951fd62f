"""Change detection: a key event counts only when its value differs from the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.text import hash_text
from footfall.operators.ordered import neighbours
from footfall.rules import KEY


def changed_keys(key_events: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """Key events whose value hash differs from the previous event of the same key.

    Not a de-duplication: A, B, A gives three rows.
    """
    as_object = F.col("value_is_object") if "value_is_object" in key_events.columns else None
    hashed = key_events.withColumn("_hash", hash_text(F.col("value"), as_object))
    seen = neighbours(
        hashed, ["key"], ["seq"], F.col("seq"), prev={"_before": "_hash"}, slice_rows=slice_rows
    )
    return seen.where(F.col("_before").isNull() | (F.col("_before") != F.col("_hash"))).select(
        *key_events.columns
    )


def suppress_unchanged(events: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """Channel events as they are, key events only where the value changed."""
    keys = events.where(F.col("source_type") == KEY)
    return changed_keys(keys, slice_rows).unionByName(events.where(F.col("source_type") != KEY))
