"""Windowed assembly on a stream, and a small writer for stream results."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from footfall.operators.ordered import PLAIN, choose_slicing, even_slices, settled
from footfall.operators.profile import windowed_assembly
from footfall.session import folders, get_text, put_text


def assemble_stream(
    events: DataFrame, rules: dict[str, str], width: str = "5 seconds", lateness: str = "10 minutes"
) -> DataFrame:
    """Closed windows per device; a window closes once the watermark passes its end."""
    return windowed_assembly(events, rules, width, watermark=lateness)


#: Sessions that fall into one task are merged there before they are shuffled.
LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def assemble_sessions(
    events: DataFrame, column: str, gap: str = "5 seconds", lateness: str | None = None, slice_rows: int | None = None
) -> DataFrame:
    """Rows of a device until it is silent for ``gap``: count, mean and span.

    On a stream Spark merges the sessions of each task before the shuffle (``LOCAL_MERGE`` is set on the session).
    In large batch input a device of any size is cut into slices of time of equal row counts:
    sessions are built inside (device, slice), and of each slice only the first and the last, which may go on in a
    neighbour, meet in one window per device.
    """
    if lateness:
        events = events.withWatermark("event_timestamp", lateness)
    sums = [F.count("*").alias("source_rows"), F.sum(column).alias("_sum"), F.count(column).alias("_filled")]
    names = [F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "device_id"]
    window = F.session_window("event_timestamp", gap)
    result = ["session_start", "session_end", "device_id", F.try_divide("_sum", "_filled").alias(column), "source_rows"]
    if events.isStreaming:
        events.sparkSession.conf.set(LOCAL_MERGE, "true")
    if events.isStreaming or (slice_rows := choose_slicing(events, slice_rows)) == PLAIN:
        return events.groupBy(window, "device_id").agg(*sums).select(*names, "source_rows", "_sum", "_filled").select(*result)

    number = even_slices(events, "event_timestamp", slice_rows)
    parts = events.withColumn("_slice", number("event_timestamp")).groupBy(window, "device_id", "_slice").agg(*sums)
    parts = settled(parts.select(*names, "_slice", "source_rows", "_sum", "_filled"), slice_rows, "session-parts")
    inside = W.partitionBy("device_id", "_slice").orderBy("session_start")
    edge = F.lag(F.lit(True)).over(inside).isNull() | F.lead(F.lit(True)).over(inside).isNull()
    parts = parts.withColumn("_edge", edge)
    along = W.partitionBy("device_id").orderBy("session_start")
    # at most two rows for each device and slice
    edges = parts.where("_edge").withColumn("_fresh", F.coalesce(F.col("session_start") > F.lag("session_end").over(along), F.lit(True)))
    edges = edges.withColumn("_session", F.sum(F.col("_fresh").cast("long")).over(along))
    merged = edges.groupBy("device_id", "_session").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *[F.sum(c).alias(c) for c in ("source_rows", "_sum", "_filled")],
    )
    return merged.drop("_session").unionByName(parts.where("not _edge").drop("_slice", "_edge")).select(*result)


@dataclass
class LateSplit:
    """Parts a stream into rows in time and rows too late for their window, so that none vanishes.

    A row is late when its window ends at or before the watermark: the newest event time of all earlier
    micro-batches less the lateness, in milliseconds as Spark has it. The newest time after each batch is kept below
    ``home/marks``, so a batch that runs again parts its rows as before and replaces them. The rows in time
    (``in_time``) feed the windows with the same lateness, which then drop none; the late ones stay in a table of their own.
    """

    spark: SparkSession
    home: str
    width: str = "5 seconds"
    lateness_seconds: int = 600

    def _mark(self, batch_id: int) -> str:
        return os.path.join(self.home, "marks", str(batch_id))

    def watermark(self, batch_id: int) -> int | None:
        """Milliseconds before which windows are closed when a batch begins; None before the first event."""
        newest = get_text(self.spark, self._mark(batch_id - 1)) if batch_id else None
        return int(newest) - 1000 * self.lateness_seconds if newest else None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        mark, seen = self.watermark(batch_id), Observation()
        closed = F.unix_micros(F.window("event_timestamp", self.width)["end"]) <= F.lit(None if mark is None else 1000 * mark).cast("bigint")
        rows = batch.observe(seen, F.unix_millis(F.max("event_timestamp")).alias("newest"))
        rows = rows.withColumns({"late": F.coalesce(closed, F.lit(False)), "batch_id": F.lit(batch_id).cast("bigint")})
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("late", "batch_id")
        writer.parquet(os.path.join(self.home, "rows"))
        before = get_text(self.spark, self._mark(batch_id - 1)) if batch_id else None
        known = [int(t) for t in (before, seen.get["newest"]) if t not in (None, "")]
        put_text(self.spark, self._mark(batch_id), str(max(known)) if known else "")

    def start(self, events: DataFrame, checkpoint: str) -> StreamingQuery:
        """Parts what is there of a stream and ends."""
        writer = events.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()

    def _rows(self, late: bool) -> str:
        return os.path.join(self.home, "rows", f"late={str(late).lower()}")

    def in_time(self, schema: StructType) -> DataFrame:
        """The rows in time as a stream; batches of the split are not parted again, as it has no limit on files."""
        return self.spark.readStream.schema(schema).parquet(os.path.join(self._rows(False), "batch_id=*"))

    def late(self, schema: StructType) -> DataFrame:
        """The late rows so far."""
        paths = folders(self.spark, os.path.join(self._rows(True), "batch_id=*"))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Runs an append-mode stream over what is there now and returns the written table."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
