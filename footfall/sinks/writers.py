"""Writers: Parquet, JSON Lines, replay logs, partitioned tables, exports, dry runs."""

from __future__ import annotations

import os
from functools import reduce
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from footfall.operators.export import (
    FORMATS,
    RangeSpec,
    TicketSpec,
    partition_start,
    rows_of_tickets,
    state_context,
    state_in_lifetimes,
    ticket_rows,
    ticket_timeframes,
    time_range,
)
from footfall.operators.replay import as_log, combined_replay, in_replay_order, to_replay
from footfall.rules import STATE, TABLES, Table, table_schema
from footfall.session import remove_path, stored_bytes

CODECS = ("snappy", "gzip", "zstd", "none")
#: A compressed text file is read by one task, so that a big ticket is cut into several.
ROWS_PER_TEXT_FILE = 1_000_000

def write_parquet(
    df: DataFrame, path: str, codec: str = "snappy", row_group_rows: int = 100_000
) -> None:
    """Parquet with a codec and at most ``row_group_rows`` rows per row group."""
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    (
        df.write.mode("overwrite")
        .option("compression", codec)
        .option("parquet.block.row.count.limit", row_group_rows)
        .parquet(path)
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, ISO times in milliseconds, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_replay(records: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A replay log in time order: a range sort, so file order is time order.

    ``fmt='avro'`` writes Avro where the Avro package is on the class path.
    """
    as_log(in_replay_order(records)).write.mode("overwrite").format(fmt).save(path)


def write_schema(df: DataFrame, path: str) -> None:
    """The frame's schema as a one-line JSON side file."""
    line = df.sparkSession.range(1).select(F.lit(df.schema.json()).alias("value"))
    line.coalesce(1).write.mode("overwrite").text(path)


def write_metadata(spark: SparkSession, spec: TicketSpec, files: dict[str, str], path: str) -> None:
    """What was exported, when, and where to, as one JSON line."""

    def moment(value: datetime | None) -> Column:
        return F.lit(value.isoformat() if value else None).cast("string")

    pairs = [F.struct(F.lit(t).alias("table"), F.lit(p).alias("path")) for t, p in files.items()]
    row = spark.range(1).select(
        F.lit(spec.ticket_id).alias("ticket_id"),
        F.lit(datetime.now(timezone.utc).isoformat()).alias("export_timestamp"),
        F.array(*[F.lit(t) for t in spec.tables]).alias("tables"),
        F.lit(spec.format).alias("format"),
        F.struct(moment(spec.start).alias("start"), moment(spec.end).alias("end")).alias("time_range"),
        (F.map_from_entries(F.array(*pairs)) if pairs else F.create_map().cast("map<string,string>"))
        .alias("files"),
    )
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def partition_value(table: Table) -> Column:
    """The partition a row belongs to."""
    return partition_start(F.col(table.partition_field), table.partition_type)


def with_bloom_filters(writer: DataFrameWriter, table: Table) -> DataFrameWriter:
    """Bloom filters on the look-up columns: files are sorted by their first clustering column, so for the
    others the smallest and largest values of a row group prune little. They are as large as the values they hold ask for."""
    names = {c.name for c in table.columns}
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in ("device_id", "state_key"):
        if column in names:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def write_partitioned(
    rows: DataFrame,
    table: str,
    path: str,
    batch_id: int | None = None,
    tables: dict[str, Table] = TABLES,
) -> None:
    """Writes rows below ``event_date=…``, clustered inside the files.

    Rows are spread by range over (day, clustering, time), which splits a day or device of
    any size over tasks, keeps files few, and makes min/max statistics selective. With
    ``batch_id`` the rows go below ``batch_id=…`` too and replace what an earlier attempt of
    the same batch wrote, so a retry leaves no duplicates.
    """
    spec = tables[table]
    rows = rows.withColumn("event_date", partition_value(spec))
    parts, layout = ["event_date"], ["event_date", *spec.clustering, spec.partition_field]
    rows = rows.repartitionByRange(*layout).sortWithinPartitions(*layout)
    writer = rows.write
    if batch_id is None:
        writer = writer.mode("append")
    else:
        parts.append("batch_id")
        writer = (
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
        )
    with_bloom_filters(writer, spec).partitionBy(*parts).parquet(path)


def write_dealt(rows: DataFrame, path: str, batch_id: int, tables: dict[str, Table] = TABLES) -> None:
    """Writes the rows of several tables at once, below ``target_table=…/event_date=…/batch_id=…``.

    ``rows`` has ``target_table``, ``event_date`` and the columns of all tables. They are dealt by (table,
    partition) in one exchange, in which adaptive execution splits what is large and joins what is small, and replace
    what an earlier attempt of the same batch wrote. Files are small until they are merged, and have no bloom filters.
    """
    clustering = dict.fromkeys(c for spec in tables.values() for c in (*spec.clustering, spec.partition_field))
    parts = ["target_table", "event_date"]
    dealt = rows.hint("rebalance", *parts).sortWithinPartitions(*parts, *[c for c in clustering if c in rows.columns])
    writer = dealt.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "batch_id").parquet(path)


def create_table(spark: SparkSession, table: str, path: str, name: str | None = None) -> bool:
    """Creates a partitioned catalog table over ``path`` when absent; says whether it did."""
    name = name or table
    if spark.catalog.tableExists(name):
        return False
    spec = TABLES[table]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(table).fields
    )
    day_type = "string" if spec.partition_type == "HOUR" else "date"
    spark.sql(
        f"CREATE TABLE {name} ({columns}, event_date {day_type}) USING parquet "
        f"PARTITIONED BY (event_date) LOCATION '{path}' "
        f"TBLPROPERTIES ('clustering' = '{','.join(spec.clustering)}')"
    )
    return True


def verify_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, bool]:
    """For each table (table to catalog name): exists, is partitioned, declares clustering."""
    report = {}
    for table, name in names.items():
        if not spark.catalog.tableExists(name):
            report[table] = False
            continue
        partitioned = any(c.isPartition for c in spark.catalog.listColumns(name))
        declared = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'clustering'")
        report[table] = partitioned and not declared.isEmpty()
    return report


def table_info(spark: SparkSession, name: str) -> dict:
    """Rows, bytes, number of columns and partition columns of a catalog table.

    Bytes come from the file listing. Rows are counted without reading a column, which takes the row
    counts of the files' footers; no statistics are computed.
    """
    columns = spark.catalog.listColumns(name)
    location = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    return {
        "rows": spark.table(name).count(),
        "bytes": stored_bytes(spark, location),
        "columns": len(columns),
        "partitioning": [c.name for c in columns if c.isPartition],
    }


def dry_run(df: DataFrame) -> dict:
    """Runs a frame to the end, writes nothing, and returns how many rows it gave."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get


def write_tables(
    frames: dict[str, DataFrame], folder: str, fmt: str, combined_name: str
) -> dict[str, str]:
    """One output per non-empty table, or one combined log for the replay format."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if fmt == "replay":
        path = os.path.join(folder, f"{combined_name}.replay")
        log = combined_replay(frames)
        if not _wrote(log, lambda df: write_replay(df, path), path):
            return {}
        write_schema(as_log(log), f"{path}.schema")
        return {"combined": path}
    write = write_parquet if fmt == "parquet" else write_jsonl
    files = {table: os.path.join(folder, f"{table}.{fmt}") for table in frames}
    return {t: files[t] for t, df in frames.items() if _wrote(df, lambda df, t=t: write(df, files[t]), files[t])}


def _wrote(df: DataFrame, write, path: str) -> bool:
    """Writes a frame and counts its rows on the way; an output without rows is taken away again."""
    seen = Observation()
    write(df.observe(seen, F.count("*").alias("rows")))
    if seen.get["rows"]:
        return True
    remove_path(df.sparkSession, path)
    return False


def export_range(tables: dict[str, DataFrame], spec: RangeSpec, out_dir: str) -> dict[str, str]:
    """Exports ``[start, end)`` of the chosen tables below ``out_dir``."""
    frames = {
        t: time_range(tables[t], t, spec.start, spec.end, spec.include_ticket_id) for t in spec.tables
    }
    return write_tables(frames, os.path.join(out_dir, spec.name), spec.format, spec.name)


def export_ticket(tables: dict[str, DataFrame], spec: TicketSpec, out_dir: str) -> dict[str, str]:
    """Exports a ticket: its sensor rows and every state event in its lifetime."""
    found = ticket_timeframes(tables, spec.ticket_id).first()
    if found is None:
        raise ValueError(f"ticket {spec.ticket_id} is in no table")
    frames = {}
    for t in spec.tables:
        if t == STATE:
            frames[t] = state_context(
                tables[t], found["first_seen"], found["last_seen"], spec.start, spec.end,
                spec.inclusive_end,
            )
        else:
            frames[t] = ticket_rows(tables[t], t, spec.ticket_id, spec.start, spec.end)
    folder = os.path.join(out_dir, spec.name)
    files = write_tables(frames, folder, spec.format, f"{spec.ticket_id}_combined")
    write_metadata(next(iter(tables.values())).sparkSession, spec, files, os.path.join(folder, "metadata"))
    return files


def export_tickets(
    tables: dict[str, DataFrame],
    tickets: DataFrame,
    out_dir: str,
    fmt: str = "parquet",
    inclusive_end: bool = False,
) -> None:
    """Exports many tickets in one job per table: as ``export_ticket`` does each, one folder per ticket.

    A ticket gets its sensor rows and every state event, of any ticket, in its lifetime; the
    folders are named ``for_ticket=…``. ``metadata`` has one row per ticket and table: rows
    and times. Rows are spread by range over (ticket, time), so a big ticket spans several
    tasks and a small one lands in one file. JSON lines are compressed by gzip: a state event is
    written once for each ticket that it concerns, and its copies' text would outweigh all other work.
    """
    if fmt not in ("parquet", "jsonl"):
        raise ValueError("many tickets are exported as parquet or jsonl")
    wanted = tickets.select(F.col("entry").alias("ticket_id")).distinct()
    lifetimes = ticket_timeframes(tables).join(wanted, "ticket_id", "left_semi")
    counts = []
    for table, df in tables.items():
        if table == STATE:
            rows = state_in_lifetimes(df, lifetimes, inclusive_end=inclusive_end)
        else:
            rows = rows_of_tickets(df, tickets).withColumn("for_ticket", F.col("ticket_id"))
        path = os.path.join(out_dir, table)
        writer = (
            rows.repartitionByRange("for_ticket", "event_timestamp")
            .sortWithinPartitions("for_ticket", "event_timestamp")
            .write.mode("overwrite")
            .partitionBy("for_ticket")
        )
        if fmt == "parquet":
            writer.parquet(path)
        else:
            writer = writer.option("ignoreNullFields", "false").option("maxRecordsPerFile", ROWS_PER_TEXT_FILE)
            writer.option("compression", "gzip").json(path)
        seen = read_exported(rows, path, fmt).groupBy("for_ticket").agg(
            F.count("*").alias("rows"), F.min("event_timestamp").alias("earliest"), F.max("event_timestamp").alias("latest")
        )
        counts.append(seen.select(F.lit(table).alias("table_name"), "*", F.lit(fmt).alias("format"), F.lit(path).alias("path")))
    reduce(DataFrame.unionByName, counts).write.mode("overwrite").parquet(os.path.join(out_dir, "metadata"))


def read_exported(rows: DataFrame, path: str, fmt: str) -> DataFrame:
    """What ``export_tickets`` wrote for a table whose rows look like ``rows``."""
    reader = rows.sparkSession.read.schema(rows.schema)
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


def write_single_replay(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One table as a replay log."""
    write_replay(to_replay(df), path, fmt)
