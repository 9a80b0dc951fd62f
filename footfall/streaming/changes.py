"""Change detection on a stream: the last value hash per key as a table of versions.

A micro-batch reads the hashes as they were before it, compares each of its events with the
one before, and writes the hashes of its own keys as a new version. So a batch that runs again
finds what it found the first time, and a write is as large as the batch, not as the state.
Every ``COMPACT`` batches a version holds the whole state, and older ones are no longer read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.text import hash_text
from footfall.operators.ordered import neighbours
from footfall.rules import KEY
from footfall.session import remove_path

COMPACT = 50
# Versions that stay behind the newest whole state, so that a stream can be set back as far.
KEPT = 2 * COMPACT
HASHES = "key string, value_hash string, version bigint"


def _version(folder: str, batch_id: int) -> str:
    return os.path.join(folder, f"version={batch_id}")


def hashes_before(spark: SparkSession, folder: str, batch_id: int, seed: DataFrame | None = None) -> DataFrame:
    """(key, value_hash): the last hash of every key before a batch; ``seed`` holds those from before the stream."""
    first = max(0, (batch_id - 1) // COMPACT * COMPACT)
    paths = [_version(folder, i) for i in range(first, batch_id)]
    known = spark.createDataFrame([], HASHES)
    if seed is not None and first == 0:
        known = seed.select("key", "value_hash", F.lit(-1).cast("bigint").alias("version"))
    if not paths:
        return known.drop("version")
    read = known.unionByName(spark.read.schema(HASHES).parquet(*paths)) if first == 0 and seed is not None else spark.read.schema(HASHES).parquet(*paths)
    return read.groupBy("key").agg(F.max_by("value_hash", "version").alias("value_hash"))


def last_hashes(key_events: DataFrame) -> DataFrame:
    """(key, value_hash) of the newest value of every key: what a stream that goes on from here is seeded with."""
    as_object = F.col("value_is_object") if "value_is_object" in key_events.columns else None
    hashed = key_events.select("key", "seq", hash_text(F.col("value"), as_object).alias("value_hash"))
    return hashed.groupBy("key").agg(F.max_by("value_hash", "seq").alias("value_hash"))


def changed_keys_and_state(
    key_events: DataFrame, folder: str, batch_id: int, slice_rows: int | None = None, seed: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The key events of a micro-batch whose value differs from the one before, and the batch's version of the hashes."""
    spark = key_events.sparkSession
    as_object = F.col("value_is_object") if "value_is_object" in key_events.columns else None
    hashed = key_events.withColumn("value_hash", hash_text(F.col("value"), as_object))
    before = hashes_before(spark, folder, batch_id, seed)
    seen = neighbours(
        hashed, ["key"], ["seq"], F.col("seq"), prev={"_before": "value_hash", "_seq_before": "seq"}, slice_rows=slice_rows
    )
    # only a key's first event needs the old hash; the others meet nothing, and are spread by their number
    first = F.col("_seq_before").isNull()
    seen = seen.withColumns({"_first": first, "_probe": F.when(first, F.col("key")).otherwise(F.col("seq").cast("string"))})
    old = before.select(F.col("key").alias("_probe"), F.col("value_hash").alias("_known"), F.lit(True).alias("_first"))
    known = seen.join(old, ["_probe", "_first"], "left")
    last = F.when(F.col("_first"), F.col("_known")).otherwise(F.col("_before"))
    newest = hashed.groupBy("key").agg(F.max_by("value_hash", "seq").alias("value_hash"))
    if batch_id and batch_id % COMPACT == 0:
        newest = before.join(newest, "key", "left_anti").unionByName(newest)
    newest = newest.withColumn("version", F.lit(batch_id).cast("bigint"))
    return known.where(last.isNull() | (last != F.col("value_hash"))).select(*key_events.columns), newest


def put_version(newest: DataFrame, folder: str, batch_id: int) -> None:
    """Writes a batch's version of the hashes; where that is a whole state, what no batch can go back to is deleted."""
    newest.write.mode("overwrite").parquet(_version(folder, batch_id))
    if batch_id % COMPACT == 0:
        for old in range(max(0, batch_id - KEPT - COMPACT), batch_id - KEPT):
            remove_path(newest.sparkSession, _version(folder, old))


def changes_and_state(
    events: DataFrame, folder: str, batch_id: int, slice_rows: int | None = None, seed: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Channel events as they are and key events only where the value changed, and the hashes for ``put_version``."""
    keys, newest = changed_keys_and_state(events.where(F.col("source_type") == KEY), folder, batch_id, slice_rows, seed)
    return keys.unionByName(events.where(F.col("source_type") != KEY)), newest


def start_changes(events: DataFrame, out: str, state: str, checkpoint: str, columns: list[str] | None = None) -> StreamingQuery:
    """Writes the changed events of a stream below ``out`` and ends when all that is there has been read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, newest = changes_and_state(batch, state, batch_id)
        put_version(newest, state, batch_id)
        rows = rows.select(*(columns or events.columns))
        rows.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
