"""Feed decoding: notifications, binary payloads, hashes and optional JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def invalidated_keys(notifications: DataFrame) -> DataFrame:
    """One row per key of ``invalidate`` notifications (``command``, ``keys``).

    A null key list (flush) yields nothing; keys that are not UTF-8 or empty are skipped.
    """
    key = F.try_validate_utf8(F.col("_key").cast("string"))
    others = [c for c in notifications.columns if c not in ("command", "keys")]
    return (
        notifications.where(F.col("command") == "invalidate")
        .select(*others, F.explode("keys").alias("_key"))
        .select(*others, key.alias("key"))
        .where(F.col("key") != "")
    )


def parse_notification(messages: DataFrame) -> DataFrame:
    """Key, operation and kind of ``pattern, channel, data`` messages.

    Key-space messages carry the key in the channel, key-event messages in the data;
    other messages are dropped.
    """
    pattern, channel, data = F.col("pattern"), F.col("channel"), F.col("data")
    tail = F.when(channel.contains(":"), F.regexp_extract(channel, "(?s)^[^:]*:(.*)$", 1)).otherwise(
        channel
    )
    keyspace, keyevent = pattern.contains("__keyspace@"), pattern.contains("__keyevent@")
    return messages.where(keyspace | keyevent).select(
        "*",
        F.when(keyspace, "keyspace").otherwise("keyevent").alias("kind"),
        F.when(keyspace, tail).otherwise(data).alias("key"),
        F.when(keyspace, data).otherwise(tail).alias("operation"),
    )


def pick_value(string_value: Column, hash_value: Column) -> Column:
    """The string value, else a non-empty hash as JSON text, else null."""
    return F.coalesce(string_value, F.when(F.size(hash_value) > 0, F.to_json(hash_value)))


def decode_bytes(data: Column, decoder: Callable[[Column], Column] | None = None) -> Column:
    """Text of a binary value, tier by tier.

    An optional structured decoder (a ``pandas_udf``), UTF-8, the JSON left after
    dropping bad bytes, Latin-1, hex.
    """
    raw = data.cast("string")
    cleaned = F.replace(F.make_valid_utf8(raw), F.lit("�"), F.lit(""))
    tiers = [
        F.try_validate_utf8(raw),
        F.when(F.try_parse_json(cleaned).isNotNull(), cleaned),
        F.decode(data, "ISO-8859-1"),
        F.lower(F.hex(data)),
    ]
    return F.coalesce(*([decoder(data)] if decoder else []), *tiers)


def decode_hash(value: Column, decoder: Callable[[Column], Column] | None = None) -> Column:
    """A map with binary keys and values as a map of texts."""
    keys = F.transform_keys(value, lambda k, v: decode_bytes(k, decoder))
    return F.transform_values(keys, lambda k, v: decode_bytes(v, decoder))


def parse_if_object(value: Column, value_is_object: Column) -> Column:
    """The payload as a variant when the rule says so and it parses, else null."""
    return F.when(value_is_object, F.try_parse_json(value))
