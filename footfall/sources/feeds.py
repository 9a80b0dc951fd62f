"""Readers: raw feed (batch and stream), tables, replay logs, lists."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.rules import CHANNEL, KEY, RAW_SCHEMA, table_schema

REPLAY_SCHEMA = "timestamp bigint, type string, key string, value binary, ttl bigint"


# Files that a micro-batch takes in unless told otherwise: after a stop, a backlog is worked off in steps.
MAX_FILES = 64


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(RAW_SCHEMA).load(path)


def stream_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files: int | None = MAX_FILES,
    max_bytes: str | None = None,
) -> DataFrame:
    """The raw feed as a stream; the limits bound what one micro-batch takes in (``max_bytes`` instead of ``max_files`` where given)."""
    reader = spark.readStream.format(fmt).schema(RAW_SCHEMA)
    if max_files and not max_bytes:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def channel_events(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("source_type") == CHANNEL)


def key_events(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("source_type") == KEY)


def read_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A target table with its declared schema and, where present, its partition columns."""
    df = spark.read.parquet(path)
    declared = [f.name for f in table_schema(table).fields]
    return df.select(*declared, *[c for c in df.columns if c not in declared])


def read_replay(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A replay log; ``fmt='avro'`` works where the Avro package is present."""
    return spark.read.format(fmt).schema(REPLAY_SCHEMA).load(path)


def replay_head(log: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` records by time, with the start of their value as text."""
    text = F.col("value").cast("string")
    return (
        log.orderBy("timestamp", "key", text)
        .limit(n)
        .select(
            F.timestamp_millis("timestamp").alias("event_timestamp"),
            "type",
            "key",
            F.when(F.length(text) > 50, F.concat(F.substring(text, 1, 50), F.lit("...")))
            .otherwise(text)
            .alias("value_preview"),
        )
    )


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """One entry per line (``entry``); blank lines and ``#`` comments are skipped."""
    entry = F.trim("value")
    return (
        spark.read.text(path)
        .select(entry.alias("entry"))
        .where((F.col("entry") != "") & ~F.col("entry").startswith("#"))
    )


def with_source_time(raw: DataFrame, arrival: datetime | None = None) -> DataFrame:
    """Stamps events that carry no time with the arrival time."""
    now = F.current_timestamp() if arrival is None else F.lit(arrival)
    return raw.withColumn("event_timestamp", F.coalesce("event_timestamp", now))
