"""Which visitor held which wearable, and when.

Assigning device d to ticket t at ``seq`` moves d away from its old ticket and releases
t's old device; a release by ticket frees its device. The same pair may be assigned
again. In closed form the interval that an assignment opens ends at the earlier of the
device's next assignment and the ticket's next event of any kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.patterns import glob_match, segment
from footfall.operators.ordered import carry_forward, choose_slicing, neighbours, settled

KEY_GLOB = "Visitors:*:EmpaticaDeviceID"


def assignment_log(raw: DataFrame, deletes_release: bool = False) -> DataFrame:
    """``seq, ticket_id, device_id`` from the feed; a null device is a release.

    Empty or null assignments and the status ``Inactive`` release. With
    ``deletes_release`` a feed column ``op`` equal to ``del`` does too.
    """
    key, value = F.col("key"), F.trim(F.col("value"))
    of_visitor = segment(key, 0) == "Visitors"
    assigns = key.endswith(":EmpaticaDeviceID") & of_visitor & segment(key, 2).isNotNull()
    status = key.endswith(":Status") & of_visitor & (segment(key, 2) == "Status")
    device = F.when(assigns, F.nullif(value, F.lit("")))
    if deletes_release:
        device = F.when(F.coalesce(F.col("op") != "del", F.lit(True)), device)
    return raw.where(assigns | (status & (value == "Inactive"))).select(
        "seq", F.trim(segment(key, 1)).alias("ticket_id"), device.alias("device_id")
    )


def snapshot_log(snapshot: DataFrame, seq: int = -1) -> DataFrame:
    """Seed rows from a key snapshot (``seq, key, value``): last value per key wins.

    Each row keeps a distinct ``seq`` below ``seq`` in snapshot order, so that a later key
    takes a device over from an earlier one.
    """
    latest = (
        snapshot.where(glob_match(F.col("key"), KEY_GLOB))
        .groupBy("key")
        .agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("_at"))
        .where(F.trim("value") != "")
    )
    newest = latest.agg(F.max("_at")).scalar()
    return latest.select(
        (F.lit(seq) - (newest - F.col("_at"))).cast("bigint").alias("seq"),
        F.trim(segment(F.col("key"), 1)).alias("ticket_id"),
        F.trim("value").alias("device_id"),
    )


def assignment_intervals(log: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """``device_assignments``: device, ticket, ``start_seq`` and ``end_seq`` (null = open)."""
    seq = F.col("seq")
    slice_rows = choose_slicing(log, slice_rows)
    log = settled(log, slice_rows, "assignment-log")
    by_ticket = neighbours(
        log, ["ticket_id"], ["seq"], seq, next={"_ticket_next": "seq"}, slice_rows=slice_rows
    )
    by_ticket = settled(by_ticket, slice_rows, "assignment-log")
    by_device = neighbours(
        by_ticket.where(F.col("device_id").isNotNull()),
        ["device_id"],
        ["seq"],
        seq,
        next={"_device_next": "seq"},
        slice_rows=slice_rows,
    )
    return by_device.select(
        "device_id",
        "ticket_id",
        F.col("seq").alias("start_seq"),
        F.least("_ticket_next", "_device_next").alias("end_seq"),
    )


def open_assignments(intervals: DataFrame) -> DataFrame:
    """The pairs in force after the last event."""
    return intervals.where(F.col("end_seq").isNull())


def ticket_at(sensor: DataFrame, intervals: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """Adds the ``ticket_id`` that held the row's device at its ``seq`` (null when none).

    Interval ends are merged into the sensor rows and the last one is carried forward: one
    shuffle, linear in both, hot devices sliced.
    """
    # At one seq a close comes before an open, and both before a sensor row. The mark is a
    # struct, so that a close (ticket null) is still a value to carry.
    def end(seq: str, kind: int, ticket) -> Column:
        return F.struct(
            F.col(seq).alias("seq"), F.lit(kind).alias("kind"), F.struct(ticket.alias("ticket")).alias("mark")
        )

    ends = F.array(
        end("start_seq", 1, F.col("ticket_id")), end("end_seq", 0, F.lit(None).cast("string"))
    )
    marks = intervals.select("device_id", F.explode(ends).alias("_end")).select(
        "device_id",
        F.col("_end.seq").alias("seq"),
        F.col("_end.kind").alias("_kind"),
        F.col("_end.mark").alias("_mark"),
    )
    rows = sensor.withColumn("_kind", F.lit(2))
    merged = rows.unionByName(marks.where(F.col("seq").isNotNull()), allowMissingColumns=True)
    carried = carry_forward(
        merged, ["device_id"], ["seq", "_kind"], F.col("seq"), "_mark", "_held", slice_rows
    )
    return carried.where(F.col("_kind") == 2).select(
        *sensor.columns, F.col("_held.ticket").alias("ticket_id")
    )


def device_at(tickets: DataFrame, intervals: DataFrame) -> DataFrame:
    """Reverse look-up: adds the ``device_id`` that the row's ticket held at its ``seq``."""
    swapped = intervals.select(
        F.col("ticket_id").alias("device_id"), F.col("device_id").alias("ticket_id"),
        "start_seq", "end_seq",
    )
    asked = tickets.withColumnRenamed("ticket_id", "device_id")
    found = ticket_at(asked, swapped)
    names = [F.col("device_id").alias("ticket_id") if c == "ticket_id" else F.col(c)
             for c in tickets.columns]
    return found.select(*names, F.col("ticket_id").alias("device_id"))
