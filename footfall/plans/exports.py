"""Registered queries of exports, sinks and replay: B, D5, E7 to E11, E22, F9, I11 to I21."""

from __future__ import annotations

import datetime
import os
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.pseudonym import pseudonymise
from footfall.operators import export as ex
from footfall.operators import replay, routing
from footfall.operators.projection import conform
from footfall.plans.library import busiest_sql
from footfall.plans.pipeline import ALLOWED, ALLOWED_SQL
from footfall.plans.registry import query
from footfall.plans.views import feed, sql, table, tables, with_faults
from footfall.rules import BLUEIOT, EMPATICA, STATE, TABLES, table_schema
from footfall.session import work_path
from footfall.sinks import writers
from footfall.sources import feeds
from footfall.sources.events_view import events, raw_events

SALT = "footfall-demo"

ALL_ROWS = """
  SELECT ticket_id, event_timestamp, 'empatica' AS t, device_id FROM empatica
  UNION ALL SELECT ticket_id, event_timestamp, 'blueiot', device_id FROM blueiot
  UNION ALL SELECT ticket_id, event_timestamp, 'global_state_events', NULL FROM global_state_events"""


# ---- E7 to E11, D5: lifetimes and listings --------------------------------------------


@query("e7_ticket_timeframes", sql("""
SELECT ticket_id, min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen FROM all_rows
WHERE ticket_id IS NOT NULL GROUP BY ticket_id""", all_rows=ALL_ROWS))
def e7(spark, sf):
    return ex.ticket_timeframes(tables(spark, sf))


@query("e8_i7_list_tickets", sql("""
SELECT ticket_id, min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen, count(*) AS event_count
FROM (SELECT nullif(regexp_extract(state_key, 'Visitors:([^:]+):', 1), '') AS ticket_id, event_timestamp
      FROM global_state_events WHERE state_key LIKE 'Visitors:%:%')
WHERE ticket_id IS NOT NULL GROUP BY ticket_id"""))
def e8(spark, sf):
    return ex.list_tickets(table(spark, sf, STATE))


@query("e9_h1_ticket_table_counts", sql("""
SELECT t AS table_name, ticket_id, count(*) AS row_count, min(event_timestamp) AS earliest,
  max(event_timestamp) AS latest FROM all_rows WHERE ticket_id IS NOT NULL GROUP BY t, ticket_id""",
    all_rows=ALL_ROWS))
def e9(spark, sf):
    return ex.ticket_table_counts(tables(spark, sf))


@query("e10_h4_ticket_devices", sql("""
SELECT DISTINCT t AS table_name, ticket_id, device_id FROM all_rows
WHERE ticket_id IS NOT NULL AND device_id IS NOT NULL""", all_rows=ALL_ROWS))
def e10(spark, sf):
    return ex.ticket_devices({t: table(spark, sf, t) for t in (EMPATICA, BLUEIOT)})


@query("e11_g5_ticket_state_keys", sql("""
SELECT ticket_id, state_key FROM (
  SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY state_key) AS rn
  FROM (SELECT DISTINCT ticket_id, state_key FROM global_state_events WHERE ticket_id IS NOT NULL))
WHERE rn <= 10"""))
def e11(spark, sf):
    return ex.ticket_state_keys(table(spark, sf, STATE), 10)


@query("d5_lifetime_counts", sql("""
SELECT f.ticket_id AS for_ticket, count(*) AS context_events, min(g.event_timestamp) AS from_ts,
  max(g.event_timestamp) AS to_ts
FROM global_state_events g JOIN (SELECT ticket_id, min(event_timestamp) AS a, max(event_timestamp) AS b
  FROM all_rows WHERE ticket_id IS NOT NULL GROUP BY ticket_id) f
  ON g.event_timestamp >= f.a AND g.event_timestamp < f.b GROUP BY f.ticket_id""", all_rows=ALL_ROWS))
def d5(spark, sf):
    made = tables(spark, sf)
    return ex.lifetime_counts(made[STATE], ex.ticket_timeframes(made))


#: All visitors that became inactive.
GONE_TICKETS = """SELECT ticket_id, min(event_timestamp) AS a, max(event_timestamp) AS b FROM all_rows
  WHERE ticket_id IN (SELECT ticket_id FROM global_state_events WHERE state_value = 'Inactive') GROUP BY ticket_id"""


def _gone_tickets(spark, sf):
    """A list drawn from the data: every visitor that became inactive."""
    gone = table(spark, sf, STATE).where("state_value = 'Inactive' and ticket_id is not null")
    return gone.select(F.col("ticket_id").alias("entry")).distinct()


@query("d5_state_in_all_lifetimes", sql("""
SELECT f.ticket_id AS for_ticket, g.event_timestamp, g.event_source_type, g.ticket_id, g.state_key, g.state_value, g.ttl_seconds
FROM global_state_events g JOIN f ON g.event_timestamp >= f.a AND g.event_timestamp < f.b""", all_rows=ALL_ROWS, f=GONE_TICKETS))
def d5_all_rows(spark, sf):
    return _state_in_lifetimes(spark, sf, _gone_tickets(spark, sf))


def _state_in_lifetimes(spark, sf, listed):
    made = tables(spark, sf)
    wanted = listed.withColumnRenamed("entry", "ticket_id")
    lifetimes = ex.ticket_timeframes(made).join(wanted, "ticket_id", "left_semi")
    return ex.state_in_lifetimes(made[STATE], lifetimes)


@query("b12_b13_table_health", sql("""
SELECT 'global_state_events' AS table_name, true AS healthy, count(*) AS rows, true AS has_bytes, 7 AS columns FROM global_state_events
UNION ALL SELECT 'empatica', true, count(*), true, 13 FROM empatica
UNION ALL SELECT 'blueiot', true, count(*), true, 7 FROM blueiot"""))
def b12_b13(spark, sf):
    """The three tables written, entered in the catalog, checked and measured."""
    rows, home = [], work_path(spark, "health")
    for t, df in tables(spark, sf).items():
        name = f"footfall_{t}_{os.path.basename(home).replace('-', '_')}"
        writers.write_partitioned(conform(df, t), t, f"{home}/{t}")
        writers.create_table(spark, t, f"{home}/{t}", name)
        spark.sql(f"MSCK REPAIR TABLE {name}")
        info, healthy = writers.table_info(spark, name), writers.verify_tables(spark, {t: name})[t]
        spark.sql(f"DROP TABLE {name}")
        rows.append((t, healthy and info["partitioning"] == ["event_date"], info["rows"], info["bytes"] > 0, info["columns"]))
    return spark.createDataFrame(rows, "table_name string, healthy boolean, rows bigint, has_bytes boolean, columns int")


# ---- B: sinks, written and read back --------------------------------------------------


@query("b1_parquet_export", sql("SELECT seq, event_timestamp, device_id, heart_rate, steps, ticket_id FROM empatica"))
def b1(spark, sf):
    path = work_path(spark, "parquet-export")
    rows = table(spark, sf, EMPATICA).select(
        "seq", "event_timestamp", "device_id", "heart_rate", "steps", "ticket_id"
    )
    writers.write_parquet(rows, path, "zstd", 100_000)
    return spark.read.schema(rows.schema).parquet(path)


@query("b2_single_replay_export", sql("SELECT timestamp, type, key, text AS value, ttl FROM replay WHERE table_rank = 0"))
def b2(spark, sf):
    path = work_path(spark, "replay-export")
    writers.write_single_replay(table(spark, sf, EMPATICA), path)
    return feeds.read_replay(spark, path).withColumn("value", F.col("value").cast("string"))


@query("b3_g4_combined_replay_export", sql("SELECT timestamp, type, key, text AS value, ttl FROM replay"))
def b3(spark, sf):
    path = work_path(spark, "combined-replay")
    writers.write_replay(replay.combined_replay(tables(spark, sf)), path)
    return feeds.read_replay(spark, path).withColumn("value", F.col("value").cast("string"))


@query("b4_jsonl_export", sql("""
SELECT * REPLACE (date_trunc('millisecond', event_timestamp) AS event_timestamp) FROM global_state_events"""))
def b4(spark, sf):
    path = work_path(spark, "jsonl-export")
    rows = table(spark, sf, STATE)
    writers.write_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path)


PARTITIONED = """
SELECT event_timestamp, event_source_type, ticket_id, state_key, state_value, ttl_seconds,
  {part} AS event_date FROM global_state_events
WHERE event_timestamp >= TIMESTAMP '2024-01-05 06:00:00' AND event_timestamp < TIMESTAMP '2024-01-12 18:00:00'"""
PARTS = {
    "HOUR": "strftime(event_timestamp, '%Y-%m-%d-%H')",
    "DAY": "CAST(event_timestamp AS DATE)",
    "MONTH": "CAST(date_trunc('month', event_timestamp) AS DATE)",
    "YEAR": "CAST(date_trunc('year', event_timestamp) AS DATE)",
}


def partitioned(unit: str):
    """The state table written in partitions of one unit and read back by range."""

    def run(spark, sf):
        path = work_path(spark, f"state-table-{unit.lower()}")
        spec = {STATE: replace(TABLES[STATE], partition_type=unit)}
        writers.write_partitioned(table(spark, sf, STATE).drop("seq"), STATE, path, tables=spec)
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(STATE).fields]
        kind = "string" if unit == "HOUR" else "date"
        written = spark.read.schema(", ".join([*columns, f"event_date {kind}"])).parquet(path)
        return ex.in_range(written, "2024-01-05 06:00:00", "2024-01-12 18:00:00", unit=unit)

    return run


for _unit, _part in PARTS.items():
    query(f"b7_c30_{_unit.lower()}_table", sql(PARTITIONED.format(part=_part)))(partitioned(_unit))


@query("b14_range_export", sql("""
SELECT t AS table_name, date_trunc('millisecond', event_timestamp) AS event_timestamp, id FROM (
  SELECT 'global_state_events' AS t, event_timestamp, state_key AS id FROM global_state_events
  UNION ALL SELECT 'empatica', event_timestamp, device_id FROM empatica UNION ALL SELECT 'blueiot', event_timestamp, device_id FROM blueiot)
WHERE event_timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND event_timestamp < TIMESTAMP '2024-01-20 00:00:00'"""))
def b14(spark, sf):
    spec = ex.RangeSpec(datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 20), format="jsonl")
    files = writers.export_range(tables(spark, sf), spec, work_path(spark, "range-export"))
    schema = "event_timestamp timestamp, device_id string, state_key string"
    parts = [
        spark.read.schema(schema).json(path).select(
            F.lit(t).alias("table_name"), "event_timestamp", F.coalesce("state_key", "device_id").alias("id")
        )
        for t, path in files.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("b6_ticket_export", sql("""
SELECT type, key, count(*) AS records FROM replay r, (
  SELECT ticket_id AS t, min(event_timestamp) AS a, max(event_timestamp) AS b FROM all_rows
  WHERE ticket_id IS NOT NULL GROUP BY ticket_id ORDER BY count(*) DESC, ticket_id LIMIT 1) f
WHERE (table_rank = 2 AND seq IN (SELECT seq FROM global_state_events WHERE event_timestamp >= a AND event_timestamp < b))
   OR (table_rank = 0 AND seq IN (SELECT seq FROM empatica WHERE ticket_id = t))
   OR (table_rank = 1 AND seq IN (SELECT seq FROM blueiot WHERE ticket_id = t))
GROUP BY type, key""", all_rows=ALL_ROWS))
def b6(spark, sf):
    """The export of the busiest ticket, with the whole system state of its lifetime."""
    made = tables(spark, sf)
    rows = ex.ticket_table_counts(made).groupBy("ticket_id").agg(F.sum("row_count").alias("n"))
    busiest = rows.orderBy(F.desc("n"), "ticket_id").first()["ticket_id"]
    spec = ex.TicketSpec(busiest, format="replay")
    files = writers.export_ticket(made, spec, work_path(spark, "ticket-export"))
    log = feeds.read_replay(spark, files["combined"])
    return log.groupBy("type", "key").agg(F.count("*").alias("records"))


@query("b5_b6_export_side_files", sql(f"""
SELECT ticket_id, 'replay' AS format, 3 AS tables, 'timestamp,type,key,value,ttl' AS log_columns, count(*) AS own_rows
FROM all_rows WHERE ticket_id = {busiest_sql('ticket_id', 'all_rows')} GROUP BY ticket_id""", all_rows=ALL_ROWS))
def b5(spark, sf):
    """The metadata and the schema file of a ticket's export, read back."""
    made, out = tables(spark, sf), work_path(spark, "ticket-side-files")
    rows = ex.ticket_table_counts(made).groupBy("ticket_id").agg(F.sum("row_count").alias("own_rows"))
    first = rows.orderBy(F.desc("own_rows"), F.desc("ticket_id")).first()
    spec = ex.TicketSpec(first["ticket_id"], format="replay")
    files = writers.export_ticket(made, spec, out)
    fields = F.from_json("value", "fields array<struct<name:string>>")["fields"]["name"]
    names = spark.read.text(f"{files['combined']}.schema").select(F.array_join(fields, ",").alias("log_columns"))
    meta = spark.read.schema("ticket_id string, format string, tables array<string>").json(f"{out}/{spec.name}/metadata")
    found = meta.select("ticket_id", "format", F.size("tables").alias("tables")).join(names, F.lit(True))
    return found.withColumn("own_rows", F.lit(first["own_rows"]).cast("bigint"))


# ---- I11 to I17, F9, D7, E22: the replay log ------------------------------------------


@query("i11_i15_h2_replay_records", sql("SELECT * FROM replay"))
def i11(spark, sf):
    records = replay.combined_replay(tables(spark, sf))
    return records.withColumn("table_rank", F.col("table_rank").cast("bigint"))


def _log(spark, sf):
    return replay.combined_replay(tables(spark, sf))


@query("f9_replay_schedule", sql("""
SELECT seq, (timestamp - (SELECT min(timestamp) FROM replay)) / CAST(2 AS DOUBLE) AS offset_ms FROM replay"""))
def f9(spark, sf):
    made = tables(spark, sf)
    timed = replay.schedule(replay.combined_replay(made), 2.0, replay.log_span(made))
    return timed.select("seq", "offset_ms")


@query("i17_looped_replay", sql("""
SELECT seq, CAST(i AS BIGINT) AS iteration, CAST(timestamp - a + (i - 1) * (b - a) AS DOUBLE) AS offset_ms
FROM replay, (SELECT min(timestamp) AS a, max(timestamp) AS b FROM replay), (SELECT unnest([1, 2, 3]) AS i)"""))
def i17(spark, sf):
    made = tables(spark, sf)
    span = replay.log_span(made)
    timed = replay.looped(replay.schedule(replay.combined_replay(made), span=span), 3, span)
    return timed.select("seq", F.col("iteration").cast("bigint").alias("iteration"), "offset_ms")


@query("a10_a11_all_tickets_export", sql("""
SELECT table_name, for_ticket, count(*) AS rows, min(t) AS earliest, max(t) AS latest, 'jsonl' AS format, count(*) AS read_back FROM (
  SELECT 'global_state_events' AS table_name, f.ticket_id AS for_ticket, date_trunc('millisecond', g.event_timestamp) AS t
  FROM global_state_events g JOIN f ON g.event_timestamp >= f.a AND g.event_timestamp < f.b
  UNION ALL SELECT 'empatica', e.ticket_id, date_trunc('millisecond', e.event_timestamp) FROM empatica e JOIN f ON e.ticket_id = f.ticket_id
  UNION ALL SELECT 'blueiot', e.ticket_id, date_trunc('millisecond', e.event_timestamp) FROM blueiot e JOIN f ON e.ticket_id = f.ticket_id)
GROUP BY table_name, for_ticket""", all_rows=ALL_ROWS, f=GONE_TICKETS))
def a11_all(spark, sf):
    return _export_listed(spark, sf, _gone_tickets(spark, sf))


def _export_listed(spark, sf, entries):
    """Three tables of the listed tickets with the state of their lifetimes, and the metadata read back beside the rows."""
    made, out, listed = tables(spark, sf), work_path(spark, "ticket-list-export"), work_path(spark, "tickets")
    lines = F.explode(F.array(F.concat(F.lit(" "), "entry"), F.lit("# a comment"), F.lit("")))
    entries.select(lines.alias("value")).write.text(listed)
    writers.export_tickets(made, feeds.read_list(spark, listed), out, "jsonl")
    kept = [
        spark.read.schema("for_ticket string").json(f"{out}/{t}").select(F.lit(t).alias("table_name"), "for_ticket") for t in made
    ]
    counted = reduce(DataFrame.unionByName, kept).groupBy("table_name", "for_ticket").agg(F.count("*").alias("read_back"))
    schema = "table_name string, for_ticket string, rows bigint, earliest timestamp, latest timestamp, format string"
    return spark.read.schema(schema).parquet(f"{out}/metadata").join(counted, ["table_name", "for_ticket"])


@query("d7_many_globs", sql("""
SELECT seq, key, (split_part(key, ':', 1) = 'Visitors' AND key LIKE '%:Status' OR key LIKE '%:_:Lighting:Brightness') AS allowed FROM replay"""))
def d7_many(spark, sf):
    """A list of thousands of globs: one for each visitor, and one that leads with a wildcard."""
    visitors = table(spark, sf, STATE).where("ticket_id is not null").select(
        F.explode(F.array(F.concat(F.lit("Visitors:"), "ticket_id", F.lit(":Stat*")), F.lit("*:?:Lighting:Brightness"))).alias("entry")
    )
    return replay.allowed_by_list(_log(spark, sf), visitors).select("seq", "key", "allowed")


@query("i16_commands", sql("""
SELECT seq, CASE WHEN type = 'channel' THEN 'PUBLISH ' || key || ' ' || text
  ELSE 'SET ' || key || CASE WHEN ttl > 0 THEN ' EX ' || ttl ELSE '' END || ' ' || text END AS command FROM replay"""))
def i16(spark, sf):
    return _log(spark, sf).select("seq", replay.command(F.col("text")).alias("command"))


@query("d7_allow_list_split", sql(f"SELECT seq, key, {ALLOWED_SQL} AS allowed FROM replay"))
def d7(spark, sf):
    lists = {"key_patterns": ALLOWED, "channel_patterns": ALLOWED}
    return replay.with_allowed(_log(spark, sf), **lists).select("seq", "key", "allowed")


@query("d7_allow_list_table", sql("""
SELECT seq, key, (key IN (SELECT state_key FROM global_state_events WHERE state_value = 'Inactive')
  OR key LIKE 'Rooms:_:%') AS allowed FROM replay"""))
def d7_table(spark, sf):
    gone = table(spark, sf, STATE).where("state_value = 'Inactive'")
    entries = gone.select(F.explode(F.array("state_key", F.lit("Rooms:?:*"))).alias("entry"))
    return replay.allowed_by_list(_log(spark, sf), entries).select("seq", "key", "allowed")


@query("e22_replay_counts", sql(f"""
SELECT count(*) AS events, count(*) FILTER (WHERE type = 'channel' AND ok) AS channel_publishes,
  count(*) FILTER (WHERE type = 'key' AND ok) AS key_sets,
  count(*) FILTER (WHERE type = 'channel' AND NOT ok) AS filtered_channels,
  count(*) FILTER (WHERE type = 'key' AND NOT ok) AS filtered_keys
FROM (SELECT type, {ALLOWED_SQL} AS ok FROM replay)"""))
def e22(spark, sf):
    flagged = replay.with_allowed(_log(spark, sf), ALLOWED, ALLOWED)
    return replay.replay_counts(flagged)


# ---- I18 to I21: pseudonyms -----------------------------------------------------------


def _digest(kind: str, real: str) -> str:
    return f"sha256('{SALT}|{kind}|' || {real})"


def _ticket(real: str) -> str:
    h = _digest("ticket", real)
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-4' || substr({h},13,3) || '-a' || "
            f"substr({h},16,3) || '-' || substr({h},19,12))")


def _watch(real: str) -> str:
    return f"('F' || to_base(CAST('0x' || substr({_digest('watch', real)},1,14) AS BIGINT), 36, 11))"


@query("i18_i21_pseudonymise", sql(f"""
SELECT seq, CASE WHEN key LIKE 'Visitors:%'
    THEN 'Visitors:' || {_ticket("split_part(key, ':', 2)")} || ':' || split_part(key, ':', 3)
  WHEN key LIKE 'Wearables:%' THEN 'Wearables:WatchDevices:' || {_watch("split_part(key, ':', 3)")} || ':' || split_part(key, ':', 4)
  ELSE key END AS key,
  CASE WHEN event_type = 'signup' AND value <> '' THEN {_watch("value")}
    WHEN event_type = 'error' THEN value || ' ' || {_watch("device")} || ', ' || {_ticket("split_part(key, ':', 2)")}
    WHEN event_type = 'view' THEN '{{"' || {_watch("device")} || '":["n\\n' || {_watch("device")} || '",61234]}}'
    ELSE value END AS text
FROM (SELECT *, 'E3' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS device FROM uraw)"""))
def i18(spark, sf):
    raw = raw_events(events(spark, sf), uuid_tickets=True, keep=("user_id",))
    key, value = F.col("key"), F.col("value")
    device, ticket = F.regexp_extract(key, "(E3[0-9]+)", 1), F.split_part(key, F.lit(":"), F.lit(2))
    # ids inside a text, and inside the strings, names and escapes of a JSON value
    of_user = F.concat(F.lit("E3"), F.lpad("user_id", 6, "0"))
    records = raw.select(
        "seq",
        "key",
        F.when(key.endswith(":Status"), F.concat(value, F.lit(" "), of_user, F.lit(", "), ticket))
        .when(
            key.endswith(":BlueIoTSensors"),
            F.concat(F.lit('{"'), device, F.lit('":["n\\n'), device, F.lit('",61234]}')),
        )
        .otherwise(value)
        .alias("text"),
        F.when(key.endswith("Sensors"), "json").otherwise("string").alias("value_type"),
    )
    return pseudonymise(records, SALT).select("seq", "key", "text")


@query("i19_scent_values", sql("""
SELECT seq, '7' || lpad(CAST(k AS VARCHAR), 4, '0') AS token,
  'Wearables:Scent:7' || lpad(CAST(k AS VARCHAR), 4, '0') || ':Level' AS key,
  '{"id":"7' || lpad(CAST(k AS VARCHAR), 4, '0') || '","level":6' || lpad(CAST(k AS VARCHAR), 4, '0') || '}' AS text,
  'F' || lpad(CAST(k AS VARCHAR), 4, '0') AS short FROM raw"""))
def i19(spark, sf):
    base = F.lpad(F.get_json_object("props", "$.k"), 4, "0")
    made = (
        spark.read.schema("event_id bigint, props string").parquet(f"{sf}/events.parquet")
        .select(F.col("event_id").alias("seq"), F.concat(F.lit("6"), base).alias("scent"), base.alias("code"))
    )

    def part(name, key, text, kind):
        return F.struct(F.lit(name).alias("name"), key.alias("key"), text.alias("text"), F.lit(kind).alias("value_type"))

    kinds = F.array(
        part("token", F.lit("Visitors:x:ScentDeviceID"), F.col("scent"), "string"),
        part("level", F.concat(F.lit("Wearables:Scent:"), "scent", F.lit(":Level")),
             F.concat(F.lit('{"id":"'), "scent", F.lit('","level":'), "scent", F.lit("}")), "json"),
        part("short", F.lit("Visitors:x:EmpaticaDeviceIDShort"), F.col("code"), "string"),
    )
    faked = pseudonymise(made.select("seq", F.explode(kinds).alias("r")).select("seq", "r.*"), SALT)

    def of(name, column):
        return F.max(F.when(F.col("name") == name, F.col(column)))

    return faked.groupBy("seq").agg(
        of("token", "text").alias("token"), of("level", "key").alias("key"),
        of("level", "text").alias("text"), of("short", "text").alias("short"),
    )


@query("b10_b11_pipeline_counts", sql("""
SELECT count(*) AS received, count(*) FILTER (WHERE event_type = 'click') AS empatica,
  count(*) FILTER (WHERE event_type = 'view') AS blueiot,
  count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS global_state_events,
  (SELECT count(*) FROM raw WHERE seq % 7 = 0) AS unrouted,
  (SELECT count(*) FROM raw WHERE seq % 7 <> 0 AND seq % 5 = 0 AND event_type IN ('click', 'view')) AS skipped,
  count(*) AS dry_run_rows
FROM raw WHERE seq % 7 <> 0 AND NOT (seq % 5 = 0 AND event_type IN ('click', 'view'))""".replace(
    "SELECT count(*) AS received", "SELECT (SELECT count(*) FROM raw) AS received", 1)))
def b11(spark, sf):
    """Counters of a feed with events that no rule takes or that name no device, and what a dry run of the tables sees."""
    made = routing.route(with_faults(feed(spark, sf)), keep_unmatched=True)
    target = F.col("target_table")
    keeps = (target == STATE) | F.col("device_id").isNotNull()
    kept = made.where(target.isNotNull() & keeps)
    seen = writers.dry_run(kept)["rows"]
    return made.agg(
        F.count("*").alias("received"),
        *[F.count_if((target == t) & keeps).alias(t) for t in (EMPATICA, BLUEIOT, STATE)],
        F.count_if(target.isNull()).alias("unrouted"),
        F.count_if(target.isNotNull() & ~keeps).alias("skipped"),
    ).withColumn("dry_run_rows", F.lit(seen).cast("bigint"))
