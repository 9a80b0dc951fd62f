"""The driver's ``events`` table seen as visitor telemetry."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Reading with a schema spares the footer job and reads ``ts`` as a UTC instant, so
# time filters reach the Parquet scan.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(os.path.join(sf_dir, "events.parquet"))


def events_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


def _with_k(events: DataFrame) -> DataFrame:
    """Adds ``k``. As a generated column it is parsed once per row; a plain one would be
    copied into every filter and projection that uses it."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select("*", F.explode(F.array(k)).alias("k"))


def _device() -> Column:
    user = F.col("user_id").cast("string")
    return F.concat(F.lit("E3"), F.when(F.length(user) < 6, F.lpad(user, 6, "0")).otherwise(user))


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def visitor_events(events: DataFrame) -> DataFrame:
    """The wide table the query library reads; ``event_id`` breaks ties in time."""
    k, kind = F.col("k"), F.col("event_type")

    def unless(name: str, value: Column) -> Column:
        return F.when(kind != name, value)

    return _with_k(events).select(
        "event_id",
        F.col("ts").alias("event_timestamp"),
        _device().alias("device_id"),
        _text("T", F.col("user_id") + 7 * (k % 3)).alias("ticket_id"),
        unless("error", F.col("value")).alias("position_x"),
        unless("error", k.cast("double")).alias("position_y"),
        unless("signup", _text("Zone_", k % 8)).alias("zone"),
        unless("purchase", (40 + k).cast("double")).alias("heart_rate"),
        (k.cast("double") / F.lit(10.0)).alias("skin_conductivity"),
        (F.lit(30.0) + (F.col("event_id") % 100).cast("double") / F.lit(10.0)).alias(
            "skin_temperature"
        ),
        unless("view", (k % 5).cast("double")).alias("accelerometer_x"),
        unless("view", (k % 7).cast("double")).alias("accelerometer_y"),
        unless("view", (k % 11).cast("double")).alias("accelerometer_z"),
    )


def raw_events(events: DataFrame, uuid_tickets: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The key/channel feed; ``uuid_tickets`` gives tickets the UUID shape, ``keep`` columns of ``events`` stay."""
    k, kind, eid = F.col("k"), F.col("event_type"), F.col("event_id")
    ticket = _text("T", (F.col("user_id") * 7 + k) % 40)
    if uuid_tickets:
        digest = F.md5(ticket)
        cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
        ticket = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts])
    device = _device()

    def pick(click, view, signup, error, purchase) -> Column:
        return (
            F.when(kind == "click", click)
            .when(kind == "view", view)
            .when(kind == "signup", signup)
            .when(kind == "error", error)
            .when(kind == "purchase", purchase)
        )

    bio = F.when(k == 99, "{bad").otherwise(
        _text('{"Heart_Rate_Value":', k, ',"Steps":', eid % 50, "}")
    )
    position = _text('{"BlueIoT_Position":[', k, ",", eid % 100, '],"Room_ID":', k % 8, "}")
    key = pick(
        _text("Wearables:WatchDevices:", device, ":BioSensors"),
        _text("Wearables:WatchDevices:", device, ":BlueIoTSensors"),
        _text("Visitors:", ticket, ":EmpaticaDeviceID"),
        _text("Visitors:", ticket, ":Status"),
        _text("Rooms:", F.col("user_id") % 8, ":Lighting:Brightness"),
    )
    value = pick(
        bio,
        position,
        F.when(k % 10 == 0, "").otherwise(device),
        F.when(k % 4 == 0, "Inactive").otherwise("Active"),
        _text(k % 3),
    )
    # Generated too: the texts are built once, however many rules look at them.
    message = F.explode(F.array(F.struct(key.alias("key"), value.alias("value"))))
    return (
        _with_k(events)
        .select("*", message.alias("_m"))
        .select(
            eid.alias("seq"),
            F.col("ts").alias("event_timestamp"),
            F.when(kind.isin("click", "view"), "channel").otherwise("key").alias("source_type"),
            "_m.key",
            "_m.value",
            *keep,
            F.when(kind == "error", F.lit(-1).cast("bigint")).when(kind == "purchase", k).alias("ttl"),
        )
    )
