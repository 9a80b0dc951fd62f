"""The live pipeline: feed to three partitioned tables, micro-batch by micro-batch."""

from __future__ import annotations

import json
import os
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.assignment import (
    assignment_intervals,
    assignment_log,
    open_assignments,
)
from footfall.operators.ordered import PLAIN, SLICE_ROWS
from footfall.operators.projection import as_declared, enriched_events, required, sensor_table, state_rows
from footfall.operators.routing import route
from footfall.rules import BLUEIOT, EMPATICA, RULES, STATE, TABLE_NAMES, TABLES, table_schema
from footfall.session import folders, get_text, put_text, remove_path, written
from footfall.sinks.writers import partition_value, write_dealt, write_partitioned
from footfall.streaming.changes import KEPT, changes_and_state, put_version

OPEN_SCHEMA = "seq bigint, ticket_id string, device_id string"


@dataclass
class Bridge:
    """One pass of the pipeline over a micro-batch, repeatable by batch id.

    State is kept by batch below ``state_dir``: the open assignments, at most one row per
    device, and the last value hash per key. A batch reads the versions before its own, so
    running it again, or setting the stream back by up to ``KEPT`` batches, gives the same
    rows, and its output replaces what an earlier attempt left: at-least-once delivery with
    exactly-once effect. Batches that ``compact_output`` has merged write nothing any more. Counters of
    each batch are put below ``state_dir/stats``.

    A pipeline that goes on from an earlier one is seeded with that one's open assignments
    (``seed``: seq, ticket_id, device_id) and last hashes (``seed_hashes``: key, value_hash).
    """

    spark: SparkSession
    out_dir: str
    state_dir: str
    rules: tuple = RULES
    seed: DataFrame | None = None
    seed_hashes: DataFrame | None = None
    dry_run: bool = False
    stats: list[dict] = field(default_factory=list)

    def _version(self, batch_id: int) -> str:
        return os.path.join(self.state_dir, "open_assignments", f"version={batch_id}")

    def _mark(self, table: str) -> str:
        return os.path.join(self.state_dir, "merged", table)

    def merged_below(self, table: str) -> int:
        """The batch below which a table's rows stand in its merged files; 0 before the first merge."""
        return int(get_text(self.spark, self._mark(table)) or 0)

    def _open_before(self, batch_id: int) -> DataFrame:
        if batch_id > 0:
            return self.spark.read.schema(OPEN_SCHEMA).parquet(self._version(batch_id - 1))
        if self.seed is not None:
            return self.seed.select("seq", "ticket_id", "device_id")
        return self.spark.createDataFrame([], OPEN_SCHEMA)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Routes, drops unchanged values, assigns, enriches and writes one micro-batch.

        Four jobs: what came is counted, hashes and assignments get their versions, and all tables' rows
        go into one write, which counts them on the way.
        """
        all_routed = route(batch, self.rules, keep_unmatched=True).persist()
        held = [all_routed]
        try:
            # before routing and suppression: what came, and what no rule takes
            found = all_routed.agg(F.count("*").alias("received"), F.count_if(F.col("target_table").isNull()).alias("unrouted")).first()
            # A batch of fewer rows than a slice holds no heavy key, so there is nothing to look for.
            slices = PLAIN if found["received"] <= SLICE_ROWS else SLICE_ROWS
            routed = all_routed.where("target_table is not null")
            hashes = os.path.join(self.state_dir, "hashes")
            # The versions are written while the plan of the rows is made, and before the rows.
            with ThreadPoolExecutor(2) as pool:
                changes, newest = changes_and_state(routed, hashes, batch_id, slices, self.seed_hashes)
                changed = changes.persist()
                held.append(changed)
                versions = [pool.submit(inheritable_thread_target(self.spark)(put_version), newest, hashes, batch_id)]
                # The batch's own events come after everything that is already open.
                log = self._open_before(batch_id).unionByName(assignment_log(changed))
                intervals = assignment_intervals(log, slices).persist()
                held.append(intervals)
                still_open = open_assignments(intervals).select(F.col("start_seq").alias("seq"), "ticket_id", "device_id")
                target = self._version(batch_id)
                versions.append(pool.submit(inheritable_thread_target(self.spark)(lambda: still_open.write.mode("overwrite").parquet(target))))
                rows = self._rows(changed, intervals, slices)
                for version in versions:
                    version.result()
                counts = self._write(rows, batch_id)
            self._report(batch_id, found["received"], found["unrouted"], counts)
            remove_path(self.spark, self._version(batch_id - KEPT))
        finally:
            for used in held:
                used.unpersist()

    def _rows(self, changed: DataFrame, intervals: DataFrame, slices: int) -> DataFrame:
        """All changed events as rows of their tables, in one frame; ``_kept`` is false for those that fit none."""
        sensors = enriched_events(changed, intervals, slices)
        rows = {t: sensor_table(sensors, t) for t in (EMPATICA, BLUEIOT)} | {STATE: state_rows(changed)}
        parts = []
        for table, df in rows.items():
            day = partition_value(TABLES[table]).cast("string").alias("event_date")
            fits = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required(table)])
            parts.append(df.select(*as_declared(df, table)).select(F.lit(table).alias("target_table"), day, fits.alias("_kept"), "*"))
        no_device = changed.where((F.col("target_table") != STATE) & F.col("device_id").isNull())
        parts.append(no_device.select("target_table", F.lit(False).alias("_kept")))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _write(self, rows: DataFrame, batch_id: int) -> dict:
        """Writes the kept rows of all tables but those whose batch is merged already; returns how many each table got."""
        seen = Observation()
        kept = [F.count_if(F.col("_kept") & (F.col("target_table") == t)).alias(t) for t in TABLE_NAMES]
        rows = rows.observe(seen, F.count_if(~F.col("_kept")).alias("skipped"), *kept).where("_kept").drop("_kept")
        done = [t for t in TABLE_NAMES if batch_id < self.merged_below(t)]
        if self.dry_run:
            rows.write.format("noop").mode("overwrite").save()
        else:
            write_dealt(rows.where(~F.col("target_table").isin(done)) if done else rows, self.out_dir, batch_id)
        return seen.get

    def _report(self, batch_id: int, received: int, unrouted: int, counts: dict) -> None:
        """What came, what each table got, and what was skipped as it names no device or lacks a required value."""
        found = {"batch_id": batch_id, "received": received, "unrouted": unrouted, **counts}
        found["unchanged"] = received - unrouted - sum(counts.values())
        self.stats.append(found)
        del self.stats[:-KEPT]  # the whole history is in the folder
        put_text(self.spark, os.path.join(self.state_dir, "stats", f"batch-{batch_id}.json"), json.dumps(found))


def start_bridge(
    raw: DataFrame,
    bridge: Bridge,
    checkpoint: str,
    interval: str | None = "1 second",
    name: str = "footfall_bridge",
) -> StreamingQuery:
    """Starts the pipeline on a raw stream; ``interval=None`` takes what is there and ends.

    How much one batch takes in is set on the source (``maxFilesPerTrigger``, ``maxBytesPerTrigger``).
    """
    writer = (
        raw.writeStream.queryName(name)
        .foreachBatch(bridge.process)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def table_columns(table: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(table).fields]
    day = "string" if TABLES[table].partition_type == "HOUR" else "date"
    return ", ".join([*fields, f"event_date {day}", "batch_id bigint"])


def table_path(bridge: Bridge, table: str) -> str:
    return os.path.join(bridge.out_dir, f"target_table={table}")


def read_output(bridge: Bridge, table: str) -> DataFrame:
    """What the pipeline has written to a table so far; merged rows count as those of the last batch that was merged."""
    below = bridge.merged_below(table)
    rows = bridge.spark.read.schema(table_columns(table)).parquet(table_path(bridge, table))
    valid = rows.where((F.col("batch_id") >= below) | (F.col("batch_id") == -below))
    return valid.withColumn("batch_id", F.when(F.col("batch_id") < 0, -F.col("batch_id") - 1).otherwise(F.col("batch_id")))


def read_stats(bridge: Bridge) -> DataFrame:
    """The counters of every batch: received, unrouted, unchanged, skipped for want of a device, rows by table."""
    names = ["batch_id", "received", "unrouted", "skipped", *TABLE_NAMES, "unchanged"]
    schema = ", ".join(f"{n} bigint" for n in names)
    return bridge.spark.read.schema(schema).json(os.path.join(bridge.state_dir, "stats"))


def compact_output(bridge: Bridge, table: str, below: int) -> DataFrame:
    """Rewrites what the batches before ``below`` wrote as a few large files.

    Run it beside the stream for batches that are done. The merged rows go below a name that no batch has
    (``batch_id=-below``). They count, and the batches' own rows no longer do, from the moment the table's mark
    is put in place; the old files go after that. So a reader through ``read_output`` sees each row once at any
    time, a merge that was cut short can be done again, and a batch that runs again after it writes nothing.
    """
    if below <= bridge.merged_below(table):
        return read_output(bridge, table)
    old = read_output(bridge, table).where(F.col("batch_id") < below)
    write_partitioned(written(old.drop("event_date", "batch_id"), f"compact-{table}"), table, table_path(bridge, table), -below)
    put_text(bridge.spark, bridge._mark(table), str(below))
    for path in folders(bridge.spark, os.path.join(table_path(bridge, table), "event_date=*", "batch_id=*")):
        number = int(re.search(r"batch_id=(-?\d+)/?$", path)[1])
        if number < below and number != -below:
            remove_path(bridge.spark, path)
    return read_output(bridge, table)
