"""The query library over ``visitor_events``.

Every function takes the wide table and returns a lazy frame. ``device_id`` (or
``ticket_id``) narrows a query to one visitor; left out, it runs for all of them. Times
relative to now take ``as_of``, the moment to count back from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.ordered import choose_slicing, first_n, latest_rows, neighbours, settled

TS = "event_timestamp"
WIDE = [
    TS, "device_id", "ticket_id", "position_x", "position_y", "zone", "heart_rate",
    "skin_conductivity", "skin_temperature", "accelerometer_x", "accelerometer_y",
    "accelerometer_z",
]
NARROW = WIDE[:9]


def _of_device(df: DataFrame, device_id: str | None) -> DataFrame:
    return df if device_id is None else df.where(F.col("device_id") == device_id)


def _order(df: DataFrame) -> list[str]:
    """Time, then the arrival number; without one, all other columns that have an order."""
    arrival = [c for c in ("event_id", "seq") if c in df.columns]
    return [TS, *(arrival or sorted(c for c, kind in df.dtypes if c != TS and "map<" not in kind))]


def _around(df: DataFrame, prev=None, next=None, slice_rows=None) -> DataFrame:
    """Columns of the device's previous and next event."""
    return neighbours(
        df, ["device_id"], _order(df), F.unix_micros(TS), prev=prev, next=next,
        slice_rows=slice_rows,
    )


def _since(as_of, **ago) -> Column:
    """``TS`` no earlier than an interval before ``as_of`` (a literal or a column)."""
    at = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return F.col(TS) >= at - F.make_interval(**{k: F.lit(v) for k, v in ago.items()})


def newest(df: DataFrame) -> Column:
    """The newest event time of a table, as an ``as_of`` that needs no clock."""
    return df.agg(F.max(TS)).scalar()


def device_events(df, device_id=None) -> DataFrame:
    """Q1: all events, newest first."""
    return _of_device(df, device_id).select(*WIDE).orderBy(F.desc(TS))


def recent_events(df, as_of, hours=24, device_id=None, columns=WIDE) -> DataFrame:
    """Events of the last ``hours`` before ``as_of``, newest first."""
    hits = _of_device(df, device_id).where(_since(as_of, hours=hours))
    return hits.select(*columns).orderBy(F.desc(TS))


def events_between(df, start, end, device_id=None) -> DataFrame:
    """Q3: events from ``start`` to ``end``, both included, newest first."""
    hits = _of_device(df, device_id).where(F.col(TS).between(start, end))
    return hits.select(*WIDE).orderBy(F.desc(TS))


def _biometric_aggregates() -> list[Column]:
    return [
        F.count("*").alias("total_events"),
        F.min(TS).alias("first_event"),
        F.max(TS).alias("last_event"),
        F.avg("heart_rate").alias("avg_heart_rate"),
        F.min("heart_rate").alias("min_heart_rate"),
        F.max("heart_rate").alias("max_heart_rate"),
        F.avg("skin_conductivity").alias("avg_skin_conductivity"),
        F.avg("skin_temperature").alias("avg_skin_temperature"),
    ]


def biometric_summary(df, device_id=None) -> DataFrame:
    """Biometric figures per device and ticket, over events with a heart rate."""
    hits = _of_device(df, device_id).where(F.col("heart_rate").isNotNull())
    return hits.groupBy("device_id", "ticket_id").agg(*_biometric_aggregates())


def visitor_summary(df, device_id=None) -> DataFrame:
    """The same over all events, with the number of zones."""
    return (
        _of_device(df, device_id)
        .groupBy("device_id", "ticket_id")
        .agg(*_biometric_aggregates(), F.countDistinct("zone").alias("zones_visited"))
    )


def movement(df, device_id=None, slice_rows=None) -> DataFrame:
    """Q5 / F1: positions with the previous one and the whole seconds since."""
    placed = _of_device(df, device_id).where(
        F.col("position_x").isNotNull() & F.col("position_y").isNotNull()
    )
    before = {"prev_x": "position_x", "prev_y": "position_y", "prev_zone": "zone", "_prev_ts": TS}
    return (
        _around(placed, prev=before, slice_rows=slice_rows)
        .select(
            TS, "device_id", "ticket_id", "position_x", "position_y", "zone",
            "prev_x", "prev_y", "prev_zone",
            F.timestamp_diff("SECOND", F.col("_prev_ts"), F.col(TS)).alias(
                "seconds_since_last_event"
            ),
        )
        .orderBy(F.desc(TS))
    )


def zone_visits(df, device_id=None) -> DataFrame:
    """Visits per zone, most visited first."""
    return (
        _of_device(df, device_id)
        .where(F.col("zone").isNotNull())
        .groupBy("device_id", "zone")
        .agg(
            F.count("*").alias("visit_count"),
            F.min(TS).alias("first_visit"),
            F.max(TS).alias("last_visit"),
            F.avg("heart_rate").alias("avg_heart_rate_in_zone"),
        )
        .orderBy(F.desc("visit_count"))
    )


def activity_level(df, device_id=None) -> DataFrame:
    """Acceleration magnitude, newest first."""
    axes = ["accelerometer_x", "accelerometer_y", "accelerometer_z"]
    squares = [F.pow(F.col(a), F.lit(2.0)) for a in axes]
    return (
        _of_device(df, device_id)
        .where(F.col(axes[0]).isNotNull())
        .select(
            TS, "device_id", "ticket_id", *axes,
            F.sqrt(squares[0] + squares[1] + squares[2]).alias("activity_magnitude"),
            "heart_rate", "zone",
        )
        .orderBy(F.desc(TS))
    )


def events_of_devices(df, devices: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Events of several devices, by device and newest first; a frame of ``device_id`` may name very many."""
    if isinstance(devices, DataFrame):
        hits = df.join(devices, "device_id", "left_semi")
    else:
        hits = df if devices is None else df.where(F.col("device_id").isin(list(devices)))
    return hits.select(*NARROW).orderBy("device_id", F.desc(TS))


def ticket_events(df, ticket_id=None) -> DataFrame:
    """Q9: events of a ticket, newest first."""
    hits = df if ticket_id is None else df.where(F.col("ticket_id") == ticket_id)
    return hits.select(*NARROW).orderBy(F.desc(TS))


def health_alerts(
    df, device_id=None, high_rate=120, low_rate=50, high_temperature=38, low_temperature=35
) -> DataFrame:
    """Readings outside the limits with the first limit they break."""
    rate, temperature = F.col("heart_rate"), F.col("skin_temperature")
    limits = [
        (rate > high_rate, "High Heart Rate"),
        (rate < low_rate, "Low Heart Rate"),
        (temperature > high_temperature, "High Temperature"),
        (temperature < low_temperature, "Low Temperature"),
    ]
    status, broken = F, F.lit(False)
    for test, name in limits:
        status = status.when(test, name)
        broken = broken | test
    return (
        _of_device(df, device_id)
        .where(broken)
        .select(
            TS, "device_id", "ticket_id", "zone", "heart_rate", "skin_conductivity",
            "skin_temperature", status.otherwise("Normal").alias("health_status"),
        )
        .orderBy(F.desc(TS))
    )


def latest_events(df) -> DataFrame:
    """Q11 / D3: the newest event of each device; ties in time are all kept."""
    return latest_rows(df, ["device_id"], TS).orderBy(F.desc(TS))


def zone_path(df, device_id=None, slice_rows=None) -> DataFrame:
    """Q12 / F2: zone changes with the zone before and after, oldest first."""
    seen = _of_device(df, device_id).where(F.col("zone").isNotNull())
    path = _around(
        seen, prev={"previous_zone": "zone"}, next={"next_zone": "zone"}, slice_rows=slice_rows
    )
    return (
        path.where(_zone_changed())
        .select(
            "device_id", "ticket_id", TS, "previous_zone",
            F.col("zone").alias("current_zone"), "next_zone",
        )
        .orderBy(TS)
    )


def _zone_changed() -> Column:
    return F.col("zone") != F.coalesce("previous_zone", F.lit(""))


def hourly_summary(df, device_id=None) -> DataFrame:
    """Activity per day and hour, newest first."""
    return (
        _of_device(df, device_id)
        .groupBy(F.to_date(TS).alias("event_date"), F.hour(TS).alias("hour"), "device_id")
        .agg(
            F.count("*").alias("events_count"),
            F.countDistinct("zone").alias("zones_visited"),
            F.avg("heart_rate").alias("avg_heart_rate"),
            F.avg("skin_temperature").alias("avg_temperature"),
            F.min("position_x").alias("min_x"),
            F.max("position_x").alias("max_x"),
            F.min("position_y").alias("min_y"),
            F.max("position_y").alias("max_y"),
        )
        .orderBy(F.desc("event_date"), F.desc("hour"))
    )


def visitors_in_zone(df, as_of, zone=None, minutes=5) -> DataFrame:
    """Q14 / E5: who was seen in a zone in the last minutes before ``as_of``."""
    at = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    hits = df.where(_since(as_of, mins=minutes) & (F.col(TS) <= at) & F.col("zone").isNotNull())
    if zone is not None:
        hits = hits.where(F.col("zone") == zone)
    return (
        hits.groupBy("device_id", "ticket_id", "zone")
        .agg(F.max(TS).alias("last_seen"))
        .orderBy(F.desc("last_seen"))
    )


def distance_travelled(df, device_id=None, slice_rows=None) -> DataFrame:
    """Steps, path length, start, end and minutes per device.

    Counts steps, so the first position of a device is not counted and the start is the
    time of its second position.
    """
    placed = _of_device(df, device_id).where(
        F.col("position_x").isNotNull() & F.col("position_y").isNotNull()
    )
    steps = _around(
        placed, prev={"prev_x": "position_x", "prev_y": "position_y"}, slice_rows=slice_rows
    ).where(F.col("prev_x").isNotNull() & F.col("prev_y").isNotNull())
    dx, dy = F.col("position_x") - F.col("prev_x"), F.col("position_y") - F.col("prev_y")
    length = F.sqrt(F.pow(dx, F.lit(2.0)) + F.pow(dy, F.lit(2.0)))
    return steps.groupBy("device_id").agg(
        F.count("*").alias("position_updates"),
        F.sum(length).alias("total_distance_traveled"),
        F.min(TS).alias("start_time"),
        F.max(TS).alias("end_time"),
        F.timestamp_diff("MINUTE", F.min(TS), F.max(TS)).alias("duration_minutes"),
    )


def latest_n(df, n=100, device_id=None) -> DataFrame:
    """The newest ``n`` events of a device, or of each device."""
    if device_id is not None:
        return _of_device(df, device_id).select(*WIDE).orderBy(F.desc(TS)).limit(n)
    newest_first = [F.desc(c) for c in _order(df)]
    return first_n(df, ["device_id"], newest_first, n).select(*WIDE).orderBy("device_id", F.desc(TS))


def zone_history(df, device_id=None, slice_rows=None) -> DataFrame:
    """Zone changes with the whole minutes spent in the zone before."""
    seen = _of_device(df, device_id).where(F.col("zone").isNotNull())
    changes = _around(seen, prev={"previous_zone": "zone"}, slice_rows=slice_rows).where(
        _zone_changed()
    )
    slice_rows = choose_slicing(seen, slice_rows)
    changes = settled(changes, slice_rows, "zone-changes")
    return (
        _around(changes, prev={"_since": TS}, slice_rows=slice_rows)
        .select(
            "device_id", TS, "previous_zone", F.col("zone").alias("current_zone"),
            F.timestamp_diff("MINUTE", F.col("_since"), F.col(TS)).alias(
                "minutes_in_previous_zone"
            ),
        )
        .orderBy(F.desc(TS))
    )


def latest_status(df, as_of, hours=1) -> DataFrame:
    """The newest event of each device seen in the last hours."""
    latest = latest_rows(df.where(_since(as_of, hours=hours)), ["device_id"], TS)
    return latest.select(
        "device_id", "ticket_id", F.col(TS).alias("last_seen"), F.col("zone").alias("current_zone"),
        "heart_rate", "skin_temperature", "position_x", "position_y",
    ).orderBy(F.desc("last_seen"))
