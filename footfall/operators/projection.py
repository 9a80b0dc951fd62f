"""Routed events to typed rows of the target tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.patterns import segment
from footfall.functions.text import canonical_text, coerce
from footfall.operators.assignment import ticket_at
from footfall.rules import BLUEIOT, EMPATICA, STATE, TABLES, table_schema

POSITION_FIELD = "BlueIoT_Position"


def payload_ok(parsed: Column, text: Column) -> Column:
    """Objects, lists and texts can be looked into; bad JSON and bare scalars cannot."""
    return parsed.isNotNull() & F.substring(F.ltrim(text), 1, 1).isin("{", "[", '"')


def payload_columns(parsed: Column, table: str, tables=TABLES) -> list[Column]:
    """Payload fields as table columns; absent or unfit ones are null, others are dropped."""
    types = {f.name: f.dataType.simpleString() for f in table_schema(table, tables).fields}
    out = []
    for source, target in tables[table].field_mappings.items():
        if source == POSITION_FIELD:
            for i, axis in enumerate(("position_x", "position_y")):
                out.append(F.try_variant_get(parsed, f"$.{source}[{i}]", "double").alias(axis))
        else:
            number = F.try_variant_get(parsed, f"$.{source}", "double")
            out.append(coerce(number, types[target]).alias(target))
    return out


def sensor_events(routed: DataFrame) -> DataFrame:
    """Events of all sensor tables that name their device; the others are dropped."""
    return routed.where(
        F.col("target_table").isin(EMPATICA, BLUEIOT) & F.col("device_id").isNotNull()
    ).select("seq", "event_timestamp", "target_table", "device_id", "value")


def enriched_events(
    routed: DataFrame,
    intervals: DataFrame,
    slice_rows: int | None = None,
) -> DataFrame:
    """Sensor events with the ticket that held the device at that moment.

    One look-up for all sensor tables: where a query uses several of them, Spark finds the
    same exchange in each and runs it once.
    """
    return ticket_at(sensor_events(routed), intervals, slice_rows)


def sensor_table(sensors: DataFrame, table: str) -> DataFrame:
    """Rows of one sensor table, with ``seq`` and ``payload_ok``.

    An event with a bad payload keeps its device id only; no ticket is given to it.
    """
    parsed = F.col("_payload")
    rows = sensors.where(F.col("target_table") == table).withColumn(
        "_payload", F.try_parse_json("value")
    )
    ok = payload_ok(parsed, F.col("value"))
    ticket = [F.when(ok, F.col("ticket_id")).alias("ticket_id")] if "ticket_id" in sensors.columns else []
    return rows.select(
        "seq", "event_timestamp", "device_id", ok.alias("payload_ok"),
        *payload_columns(parsed, table), *ticket,
    )


def sensor_rows(routed: DataFrame, table: str) -> DataFrame:
    """Rows of a sensor table before the ticket is known."""
    return sensor_table(sensor_events(routed), table)


def enriched_rows(routed: DataFrame, table: str, intervals: DataFrame, **how) -> DataFrame:
    """Rows of a sensor table with their ticket."""
    return sensor_table(enriched_events(routed, intervals, **how), table)


def empatica_rows(routed, intervals, **how) -> DataFrame:
    return enriched_rows(routed, EMPATICA, intervals, **how)


def blueiot_rows(routed, intervals, **how) -> DataFrame:
    return enriched_rows(routed, BLUEIOT, intervals, **how)


def ticket_of_key(key: Column) -> Column:
    """Second segment of a key below ``Visitors:``."""
    return F.when(key.startswith("Visitors:"), segment(key, 1))


def usable_ttl(ttl: Column, source_type: Column) -> Column:
    """Seconds to live of a key event; -1 (no expiry) and channel events give null."""
    return F.when(source_type == "key", F.nullif(ttl, F.lit(-1).cast("bigint")))


def state_rows(routed: DataFrame) -> DataFrame:
    """Rows of the state table, with ``seq``."""
    return routed.where(F.col("target_table") == STATE).select(
        "seq",
        "event_timestamp",
        F.col("source_type").alias("event_source_type"),
        ticket_of_key(F.col("key")).alias("ticket_id"),
        F.col("key").alias("state_key"),
        canonical_text(F.col("value"), F.col("value_is_object")).alias("state_value"),
        usable_ttl(F.col("ttl"), F.col("source_type")).alias("ttl_seconds"),
    )


def as_declared(rows: DataFrame, table: str) -> list[Column]:
    """Exactly the declared columns of a table, in order, from rows that may lack some."""
    have = set(rows.columns)
    return [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table_schema(table).fields
    ]


def required(table: str) -> list[str]:
    return [f.name for f in table_schema(table).fields if not f.nullable]


def conform(rows: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns, in order; rows without a required value are dropped."""
    return rows.select(*as_declared(rows, table)).dropna(subset=required(table))


def nested_record(text: Column, schema) -> Column:
    """A nested record from JSON text; unknown members are dropped, absent ones null."""
    return F.from_json(text, schema)


def assembly_counts(routed: DataFrame) -> DataFrame:
    """Events per target table (null: no rule takes them): kept, skipped, and the skip rate.

    An event is skipped when no rule takes it, or when it goes to a sensor table and names no
    device. Give it a feed routed with ``keep_unmatched``.
    """
    keeps = F.coalesce((F.col("target_table") == STATE) | (F.col("target_table").isNotNull() & F.col("device_id").isNotNull()), F.lit(False))
    skipped = F.count_if(~keeps)
    return routed.groupBy("target_table").agg(
        F.count("*").alias("events"),
        F.count_if(keeps).alias("processed"),
        skipped.alias("skipped"),
        (skipped * F.lit(100.0) / F.count("*")).alias("skip_rate"),
    )
