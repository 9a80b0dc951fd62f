"""Registered queries of the ingest pipeline: A, C and D rows, F4 to F7."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from footfall.functions import biometrics, decode, patterns, text
from footfall.operators import assignment, changes, projection, routing
from footfall.operators import export as ex
from footfall.operators import profile, replay
from footfall.plans.library import busiest, busiest_sql
from footfall.plans.registry import query
from footfall.plans.views import feed, intervals, routed, routed_and_held, sql, table, tables, visits, with_faults
from footfall.rules import BLUEIOT, EMPATICA, RULES, STATE, rules_frame
from footfall.session import work_path
from footfall.sinks import writers
from footfall.sources import feeds
from footfall.sources.events_view import events

RAW = "seq, event_timestamp, source_type, key, value, ttl"


# ---- A: sources -----------------------------------------------------------------------


@query("a1_channel_events", sql(f"SELECT {RAW} FROM raw WHERE event_type IN ('click', 'view')"))
def a1(spark, sf):
    return feeds.channel_events(feed(spark, sf))


@query("a2_key_events", sql(f"SELECT {RAW} FROM raw WHERE event_type NOT IN ('click', 'view')"))
def a2(spark, sf):
    return feeds.key_events(feed(spark, sf))


def _notifications(spark, sf):
    """Feed keys as multi-key notifications: some flushes, some foreign commands."""
    raw = feed(spark, sf)
    pair = F.array(F.encode("key", "UTF-8"), F.encode(F.concat("key", F.lit(":copy")), "UTF-8"),
                   F.unhex(F.lit("FF")), F.encode(F.lit(""), "UTF-8"))
    return raw.select(
        "seq",
        F.when(F.col("seq") % 7 == 0, "flush").otherwise("invalidate").alias("command"),
        F.when(F.col("seq") % 5 != 0, pair).alias("keys"),
    )


@query("a3_invalidated_keys", sql("""
SELECT seq, unnest([key, key || ':copy']) AS key FROM raw WHERE seq % 7 <> 0 AND seq % 5 <> 0"""))
def a3(spark, sf):
    return decode.invalidated_keys(_notifications(spark, sf))


def _messages(spark, sf):
    """Feed keys as key-space (even ``seq``) and key-event messages, and a foreign kind."""
    even, foreign = F.col("seq") % 2 == 0, F.col("seq") % 11 == 0
    return feed(spark, sf).select(
        "seq",
        F.when(foreign, "news").when(even, "__keyspace@0__:*").otherwise("__keyevent@0__:set").alias("pattern"),
        F.when(even, F.concat(F.lit("__keyspace@0__:"), "key")).otherwise("__keyevent@0__:set").alias("channel"),
        F.when(even, "set").otherwise(F.col("key")).alias("data"),
    )


@query("a4_parse_notification", sql("""
SELECT seq, CASE WHEN seq % 2 = 0 THEN 'keyspace' ELSE 'keyevent' END AS kind, key, 'set' AS operation
FROM raw WHERE seq % 11 <> 0"""))
def a4(spark, sf):
    return decode.parse_notification(_messages(spark, sf)).select("seq", "kind", "key", "operation")


@query("e19_operation_counts", sql("""
SELECT 'set:' || key AS event, count(*) AS times FROM raw WHERE seq % 11 <> 0 GROUP BY key"""))
def e19(spark, sf):
    return profile.operation_counts(decode.parse_notification(_messages(spark, sf)))


@query("a5_string_then_hash", sql("""
SELECT seq, CASE WHEN seq % 3 <> 0 THEN value ELSE '{"key":"' || key || '"}' END AS value
FROM raw WHERE seq % 3 <> 0 OR seq % 2 = 0"""))
def a5(spark, sf):
    string = F.when(F.col("seq") % 3 != 0, F.col("value"))
    fields = F.when(F.col("seq") % 2 == 0, F.create_map(F.lit("key"), F.col("key"))).otherwise(
        F.create_map().cast("map<string,string>")
    )
    picked = feed(spark, sf).select("seq", decode.pick_value(string, fields).alias("value"))
    return picked.where(F.col("value").isNotNull())


@query("a6_bootstrap_snapshot", sql("""
SELECT ticket_id, device_id, (-1 - (max(last_seq) OVER () - last_seq)) AS seq FROM (
  SELECT split_part(key, ':', 2) AS ticket_id, trim(arg_max(value, seq)) AS device_id, max(seq) AS last_seq
  FROM raw WHERE event_type = 'signup' GROUP BY key) WHERE device_id <> ''"""))
def a6(spark, sf):
    return assignment.snapshot_log(feeds.key_events(feed(spark, sf)))


@query("a7_table_scan", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 100")
def a7(spark, sf):
    events(spark, sf).createOrReplaceTempView("footfall_events")
    return spark.sql(
        "SELECT event_id, user_id, event_type, value FROM footfall_events WHERE value > 100"
    )


@query("a8_parquet_scan", "SELECT event_id, ts, value FROM events")
def a8(spark, sf):
    return events(spark, sf).select("event_id", "ts", "value")


@query("a9_replay_head", sql("""
SELECT make_timestamp(timestamp * 1000) AS event_timestamp, type, key,
  CASE WHEN length(text) > 50 THEN left(text, 50) || '...' ELSE text END AS value_preview
FROM replay ORDER BY timestamp, key, text LIMIT 10"""))
def a9(spark, sf):
    log = work_path(spark, "replay-head")
    writers.write_replay(replay.combined_replay(tables(spark, sf)), log)
    return feeds.replay_head(feeds.read_replay(spark, log), 10)


# ---- C: routing -----------------------------------------------------------------------

GLOBS = ["Rooms:[1-3]:*", "Visitors:T[!12]*", "Wearables:*:E30000?1:*", "*:Status", "Rooms:1:Lighting:Brightness"]


@query("c1_glob_match", sql("""
SELECT pattern, count(*) AS hits FROM (
  SELECT unnest([CASE WHEN regexp_full_match(key, 'Rooms:[1-3]:.*') THEN 'Rooms:[1-3]:*' END,
    CASE WHEN regexp_full_match(key, 'Visitors:T[^12].*') THEN 'Visitors:T[!12]*' END,
    CASE WHEN regexp_full_match(key, 'Wearables:.*:E30000.1:.*') THEN 'Wearables:*:E30000?1:*' END,
    CASE WHEN key LIKE '%:Status' THEN '*:Status' END,
    CASE WHEN key = 'Rooms:1:Lighting:Brightness' THEN 'Rooms:1:Lighting:Brightness' END]) AS pattern FROM raw)
WHERE pattern IS NOT NULL GROUP BY pattern"""))
def c1(spark, sf):
    hits = F.array(*[F.when(patterns.glob_match(F.col("key"), g), F.lit(g)) for g in GLOBS])
    named = feed(spark, sf).select(F.explode(F.array_compact(hits)).alias("pattern"))
    return named.groupBy("pattern").agg(F.count("*").alias("hits"))


ALLOWED = ["Visitors:*:Status", "Wearables:WatchDevices:E30000?1:*", "Rooms:1:Lighting:Brightness", "Rooms[2]:*"]
ALLOWED_SQL = """(key LIKE 'Visitors:%:Status' OR key LIKE 'Wearables:WatchDevices:E30000_1:%'
  OR key = 'Rooms:1:Lighting:Brightness' OR key LIKE 'Rooms[2]:%')"""


@query("c2_allow_list", sql(f"SELECT seq, key FROM raw WHERE {ALLOWED_SQL}"))
def c2(spark, sf):
    return feed(spark, sf).where(patterns.allow_list_match(F.col("key"), ALLOWED)).select("seq", "key")


@query("c3_c6_rule_hits", sql("""
SELECT CASE WHEN rule IN ('BioSensors', 'Position') THEN 'channel' ELSE 'key' END AS source_type,
  CASE rule WHEN 'Visitors' THEN 2 WHEN 'Rooms' THEN 3 WHEN 'BioSensors' THEN 1 WHEN 'Position' THEN 2 END AS rank,
  rule, CASE rule WHEN 'Visitors' THEN 'Visitors:*' WHEN 'Rooms' THEN 'Rooms:*'
    WHEN 'BioSensors' THEN 'Wearables:WatchDevices:*:BioSensors'
    ELSE 'Wearables:WatchDevices:*:BlueIoTSensors' END AS pattern, count(*) AS events
FROM routed GROUP BY rule"""))
def c3(spark, sf):
    return routing.rule_hits(feed(spark, sf))


@query("c6_patterns_in_use", sql("""
SELECT pattern, coalesce(n, 0) AS events FROM (SELECT unnest(['Wearables:WatchDevices:*:BioSensors',
  'Wearables:WatchDevices:*:BlueIoTSensors', 'Visitors:Register', 'Visitors:*:Status', 'Visitors:*:AssignDevice']) AS pattern)
LEFT JOIN (SELECT CASE rule WHEN 'BioSensors' THEN 'Wearables:WatchDevices:*:BioSensors'
  WHEN 'Position' THEN 'Wearables:WatchDevices:*:BlueIoTSensors' END AS pattern, count(*) AS n
  FROM routed WHERE source_type = 'channel' GROUP BY 1) USING (pattern)"""))
def c6(spark, sf):
    """Every channel pattern with the events that it takes."""
    hits = routing.rule_hits(feed(spark, sf)).where("source_type = 'channel'").select("pattern", "events")
    return routing.patterns_of(rules_frame(spark), "channel").join(hits, "pattern", "left").na.fill(0)


@query("c4_first_match_route", sql("""
SELECT seq, key, rule, CASE rule WHEN 'BioSensors' THEN 'empatica' WHEN 'Position' THEN 'blueiot'
  ELSE 'global_state_events' END AS target_table, rule IN ('Rooms', 'BioSensors', 'Position') AS value_is_object
FROM routed"""))
def c4(spark, sf):
    return routed(spark, sf).select("seq", "key", "rule", "target_table", "value_is_object")


@query("c5_events_by_prefix", sql("""
SELECT prefix, count(*) AS events FROM (
  SELECT unnest(['Galleries:', 'IO:', 'Rooms:', 'Visitors:', 'Wearables:']) AS prefix, key FROM raw
  WHERE source_type = 'key') WHERE starts_with(key, prefix) GROUP BY prefix"""))
def c5(spark, sf):
    # one row per configured rule prefix: configuration, not data
    found = F.broadcast(routing.prefixes(rules_frame(spark)))
    head = feeds.key_events(feed(spark, sf)).select(F.concat(F.substring_index("key", ":", 1), F.lit(":")).alias("prefix"))
    return head.join(found, "prefix").groupBy("prefix").agg(F.count("*").alias("events"))


@query("c7_row_ids", sql("""
SELECT seq, CASE WHEN event_type IN ('click', 'view') THEN split_part(key, ':', 3) ELSE key END AS row_id
FROM routed"""))
def c7(spark, sf):
    return routed(spark, sf).select("seq", routing.row_id().alias("row_id"))


@query("c8_device_ids", sql("""
SELECT seq, split_part(key, ':', 3) AS device_id FROM raw WHERE event_type IN ('click', 'view')"""))
def c8(spark, sf):
    return routed(spark, sf).where(F.col("device_id").isNotNull()).select("seq", "device_id")


@query("c9_i8_data_types", sql("""
SELECT data_type, count(*) AS events FROM (
  SELECT CASE event_type WHEN 'click' THEN 'BioSensors' WHEN 'view' THEN 'BlueIoTSensors'
    WHEN 'error' THEN 'Status' WHEN 'signup' THEN 'EmpaticaDeviceID' ELSE 'Brightness' END AS data_type FROM raw)
GROUP BY data_type"""))
def c9(spark, sf):
    return feed(spark, sf).groupBy(routing.data_type(F.col("key")).alias("data_type")).agg(
        F.count("*").alias("events")
    )


# ---- C: projections -------------------------------------------------------------------


@query("c10_c11_c13_biosensor_rows", sql("""
SELECT seq, event_timestamp, device_id, payload_ok, heart_rate, steps,
  CAST(NULL AS DOUBLE) AS skin_conductivity, CAST(NULL AS DOUBLE) AS battery_level_1 FROM empatica"""))
def c11(spark, sf):
    return projection.sensor_rows(routed(spark, sf), EMPATICA).select(
        "seq", "event_timestamp", "device_id", "payload_ok", "heart_rate", "steps",
        "skin_conductivity", "battery_level_1",
    )


@query("c12_position_rows", sql(
    "SELECT seq, event_timestamp, device_id, payload_ok, position_x, position_y, room FROM blueiot"))
def c12(spark, sf):
    return projection.sensor_rows(routed(spark, sf), BLUEIOT)


@query("c13_c14_coercion", sql("""
SELECT seq, CASE WHEN event_type = 'click' OR event_type = 'view' OR event_type = 'error' THEN NULL
    WHEN event_type = 'signup' THEN NULL ELSE CAST(k % 3 AS BIGINT) END AS as_int,
  CASE WHEN event_type = 'purchase' THEN CAST(k % 3 AS DOUBLE) END AS as_double,
  value = '1' AS as_bool FROM raw"""))
def c13(spark, sf):
    value = F.col("value")
    return feed(spark, sf).select(
        "seq",
        text.coerce(value, "bigint").alias("as_int"),
        text.coerce(value, "double").alias("as_double"),
        text.coerce(value, "boolean").alias("as_bool"),
    )


@query("c15_nested_record", sql("SELECT event_id, k, CAST(NULL AS VARCHAR) AS note FROM base"))
def c15(spark, sf):
    record = projection.nested_record(F.col("props"), "k bigint, note string")
    return events(spark, sf).select("event_id", record.alias("r")).select("event_id", "r.k", "r.note")


@query("c16_c18_c19_state_rows", sql("SELECT * FROM global_state_events"))
def c16(spark, sf):
    return table(spark, sf, STATE)


@query("c17_canonical_values", sql("""
SELECT seq, CASE WHEN event_type = 'view' OR (event_type = 'click' AND k <> 99)
  THEN replace(replace(value, ',', ', '), ':', ': ') ELSE value END AS state_value FROM raw"""))
def c17(spark, sf):
    return feed(spark, sf).select(
        "seq", text.canonical_text(F.col("value"), F.lit(True)).alias("state_value")
    )


@query("c20_e24_assembly_counts", sql("""
SELECT target_table, count(*) AS events, count(*) FILTER (WHERE ok) AS processed,
  count(*) FILTER (WHERE NOT ok) AS skipped, 100.0 * count(*) FILTER (WHERE NOT ok) / count(*) AS skip_rate
FROM (SELECT CASE WHEN seq % 7 = 0 THEN NULL WHEN event_type = 'click' THEN 'empatica' WHEN event_type = 'view' THEN 'blueiot'
    ELSE 'global_state_events' END AS target_table,
  seq % 7 <> 0 AND NOT (seq % 5 = 0 AND event_type IN ('click', 'view')) AS ok FROM raw) GROUP BY target_table"""))
def c20(spark, sf):
    return projection.assembly_counts(routing.route(with_faults(feed(spark, sf)), keep_unmatched=True))


@query("c21_source_time", sql("""
SELECT seq, CASE WHEN seq % 2 = 0 THEN event_timestamp ELSE TIMESTAMP '2024-06-01 00:00:00' END
  AS event_timestamp FROM raw"""))
def c21(spark, sf):
    # odd events come without a time of their own
    timed = feed(spark, sf).withColumn(
        "event_timestamp", F.when(F.col("seq") % 2 == 0, F.col("event_timestamp"))
    )
    arrival = datetime.datetime(2024, 6, 1, tzinfo=datetime.timezone.utc)
    return feeds.with_source_time(timed, arrival).select("seq", "event_timestamp")


@query("c22_c23_decode", sql("""
SELECT seq, CASE WHEN seq % 3 = 0 AND NOT json_valid(value) THEN chr(255) || value ELSE value END AS text,
  key AS field FROM raw"""))
def c22(spark, sf):
    # every third value gets a stray byte: dropped where JSON is left, else read as Latin-1
    data = F.encode("value", "UTF-8")
    broken = F.when(F.col("seq") % 3 == 0, F.concat(F.unhex(F.lit("FF")), data)).otherwise(data)
    fields = F.create_map(F.encode(F.lit("key"), "UTF-8"), F.encode("key", "UTF-8"))
    return feed(spark, sf).select(
        "seq", decode.decode_bytes(broken).alias("text"), decode.decode_hash(fields)["key"].alias("field")
    )


@query("c24_parse_if_object", sql("""
SELECT seq, CASE WHEN event_type = 'click' AND k <> 99 THEN CAST(k AS DOUBLE) END AS heart_rate FROM routed"""))
def c24(spark, sf):
    parsed = decode.parse_if_object(F.col("value"), F.col("value_is_object"))
    return routed(spark, sf).select(
        "seq", F.try_variant_get(parsed, "$.Heart_Rate_Value", "double").alias("heart_rate")
    )


# ---- C: biometric checks --------------------------------------------------------------


@query("c25_c28_i22_checked_readings", sql("""
SELECT event_id, CASE WHEN 3 * (heart_rate - 40) BETWEEN 30 AND 220 THEN 3 * (heart_rate - 40) END AS heart_rate,
  CASE WHEN heart_rate IS NULL OR 3 * (heart_rate - 40) NOT BETWEEN 30 AND 220 THEN NULL
    WHEN 3 * (heart_rate - 40) < 40 THEN 'low' WHEN 3 * (heart_rate - 40) > 200 THEN 'high' ELSE 'ok' END
    AS heart_rate_flag,
  CASE WHEN skin_temperature BETWEEN 20 AND 42 THEN skin_temperature END AS skin_temperature,
  CASE WHEN skin_temperature < 28 THEN 'low' WHEN skin_temperature > 37 THEN 'high' ELSE 'ok' END
    AS skin_temperature_flag,
  CASE WHEN round((skin_temperature + 40 - 32) * 5 / 9, 6) BETWEEN 20 AND 42
    THEN round((skin_temperature + 40 - 32) * 5 / 9, 6) END AS from_fahrenheit,
  CASE WHEN 20 * skin_conductivity BETWEEN 0 AND 100 THEN 20 * skin_conductivity END AS skin_conductivity,
  CASE WHEN 5 * accelerometer_z BETWEEN -20 AND 20 THEN 5 * accelerometer_z END AS accelerometer FROM ve"""))
def c25(spark, sf):
    # the wide table's readings, stretched so that every limit is crossed
    rate = 3 * (F.col("heart_rate") - 40)
    temperature = F.col("skin_temperature")
    return visits(spark, sf).select(
        "event_id",
        biometrics.heart_rate(rate).alias("heart_rate"),
        biometrics.heart_rate_flag(rate).alias("heart_rate_flag"),
        biometrics.skin_temperature(temperature).alias("skin_temperature"),
        biometrics.skin_temperature_flag(temperature).alias("skin_temperature_flag"),
        F.round(biometrics.skin_temperature(temperature + 40, "F"), 6).alias("from_fahrenheit"),
        biometrics.skin_conductivity(20 * F.col("skin_conductivity")).alias("skin_conductivity"),
        biometrics.accelerometer(5 * F.col("accelerometer_z")).alias("accelerometer"),
    )


def _stretched(spark, sf):
    return visits(spark, sf).withColumns({
        "heart_rate": 3 * (F.col("heart_rate") - 40),
        "skin_conductivity": 20 * F.col("skin_conductivity"),
    })


@query("c29_sanitise", sql("""
SELECT event_id, device_id, CASE WHEN 3 * (heart_rate - 40) BETWEEN 30 AND 220 THEN 3 * (heart_rate - 40) END
    AS heart_rate, skin_temperature,
  CASE WHEN 20 * skin_conductivity BETWEEN 0 AND 100 THEN 20 * skin_conductivity END AS skin_conductivity
FROM ve"""))
def c29(spark, sf):
    return biometrics.sanitise(_stretched(spark, sf), ["event_id", "device_id"])


@query("c29_rejected_counts", sql("""
SELECT device_id, count(*) AS readings,
  count(*) FILTER (WHERE 3 * (heart_rate - 40) NOT BETWEEN 30 AND 220) AS rejected_heart_rate,
  0 AS rejected_skin_temperature,
  count(*) FILTER (WHERE 20 * skin_conductivity NOT BETWEEN 0 AND 100) AS rejected_skin_conductivity
FROM ve GROUP BY device_id"""))
def c29_counts(spark, sf):
    return biometrics.rejected_counts(_stretched(spark, sf), ["device_id"])


# ---- C: predicates and texts ----------------------------------------------------------

START, END = "2024-01-05 06:00:00", "2024-01-12 18:00:00"


@query("c30_time_range_sensor", sql(f"""
SELECT * FROM empatica WHERE event_timestamp >= TIMESTAMP '{START}' AND event_timestamp < TIMESTAMP '{END}'"""))
def c30(spark, sf):
    rows = ex.time_range(table(spark, sf, EMPATICA), EMPATICA, START, END)
    return rows.select("seq", "event_timestamp", "device_id", "payload_ok", "heart_rate", "steps", "ticket_id")


@query("c30_time_range_state", sql(f"""
SELECT event_timestamp, event_source_type, state_key, state_value, ttl_seconds FROM global_state_events
WHERE event_timestamp >= TIMESTAMP '{START}' AND event_timestamp < TIMESTAMP '{END}'"""))
def c30_state(spark, sf):
    return ex.time_range(table(spark, sf, STATE), STATE, START, END)


@query("c31_ticket_rows", sql(f"SELECT * FROM blueiot WHERE ticket_id = {busiest_sql('ticket_id', 'blueiot')}"))
def c31(spark, sf):
    rows = table(spark, sf, BLUEIOT)
    return ex.ticket_rows(rows, BLUEIOT, busiest(rows, "ticket_id"))


@query("c35_channel_filters", sql(
    "SELECT seq, key FROM raw WHERE NOT (key LIKE 'Rooms:%' OR key LIKE 'Visitors:%') AND key NOT LIKE '%BlueIoT%'"))
def c35(spark, sf):
    key = F.col("key")
    dropped = patterns.any_prefix(key, ["Rooms:", "Visitors:"]) | patterns.any_part(key, ["BlueIoT"])
    return feed(spark, sf).where(~dropped).select("seq", "key")


@query("c36_text_preview", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS preview
FROM documents""")
def c36(spark, sf):
    docs = spark.read.schema("doc_id bigint, text string").parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", patterns.preview(F.col("text"), 200).alias("preview"))


@query("c37_i5_parse_time", sql("""
SELECT event_id, date_trunc('second', event_timestamp) AS with_offset,
  date_trunc('second', event_timestamp) AS with_zone,
  date_trunc('day', event_timestamp) + INTERVAL 8 HOUR AS date_only FROM ve"""))
def c37(spark, sf):
    ts = F.col("event_timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    plus_two = F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), iso), F.lit("+02:00"))
    new_york = F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), iso), F.lit("[America/New_York]"))
    return visits(spark, sf).select(
        "event_id",
        text.parse_time(plus_two).alias("with_offset"),
        text.parse_time(new_york).alias("with_zone"),
        text.parse_time(F.date_format(ts, "yyyy-MM-dd")).alias("date_only"),
    )


@query("i9_display_time", sql("""
SELECT event_id, strftime(event_timestamp - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS shown FROM ve"""))
def i9(spark, sf):
    return visits(spark, sf).select(
        "event_id", text.show_time(F.col("event_timestamp"), "America/Los_Angeles").alias("shown")
    )


@query("i10_value_hash", sql("SELECT seq, sha256(value) AS value_hash FROM raw"))
def i10(spark, sf):
    return feed(spark, sf).select("seq", text.hash_text(F.col("value")).alias("value_hash"))


@query("i10_hash_of_built_values", sql("""
SELECT seq, sha256(CASE seq % 4 WHEN 0 THEN '{"a":"' || k || '","b":' || k || '}' WHEN 1 THEN '{"a":' || k || '}'
  WHEN 2 THEN '[1,' || k || ']' ELSE '{bad ' || k END) AS value_hash FROM raw"""))
def i10_built(spark, sf):
    """Members out of order, numbers beside texts, a name that comes twice, spaced lists, and no JSON."""
    made = (
        spark.read.schema("event_id bigint, props string").parquet(f"{sf}/events.parquet")
        .select(F.col("event_id").alias("seq"), F.get_json_object("props", "$.k").alias("k"))
    )
    value = (
        F.when(F.col("seq") % 4 == 0, F.format_string('{"b":%s, "a": "%s"}', "k", "k"))
        .when(F.col("seq") % 4 == 1, F.format_string('{"a":"x","a" : %s}', "k"))
        .when(F.col("seq") % 4 == 2, F.format_string("[1, %s]", "k"))
        .otherwise(F.format_string("{bad %s", "k"))
    )
    return made.select("seq", text.hash_text(value).alias("value_hash"))


@query("i23_epoch_millis", sql("""
SELECT seq, epoch_us(event_timestamp) // 1000 AS millis, date_trunc('millisecond', event_timestamp) AS back FROM raw"""))
def i23(spark, sf):
    millis = F.unix_millis("event_timestamp")
    return feed(spark, sf).select("seq", millis.alias("millis"), F.timestamp_millis(millis).alias("back"))


# ---- D, F4 to F7: joins and ordered state ---------------------------------------------


@query("f4_f5_f6_assignment_intervals", sql("SELECT * FROM intervals"))
def f4(spark, sf):
    return intervals(spark, sf)


@query("f5_f6_assignment_log", sql("SELECT * FROM assign_log"))
def f5(spark, sf):
    return assignment.assignment_log(feed(spark, sf))


@query("f7_changed_keys", sql(f"SELECT {RAW} FROM changed"))
def f7(spark, sf):
    return changes.changed_keys(feeds.key_events(feed(spark, sf)))


def _found(events):
    return events.select("seq", F.col("target_table").alias("table_name"), "device_id", "ticket_id")


ENRICHED = """
SELECT r.seq, CASE r.event_type WHEN 'click' THEN 'empatica' ELSE 'blueiot' END AS table_name,
  split_part(r.key, ':', 3) AS device_id, i.ticket_id
FROM raw r LEFT JOIN intervals i ON i.device_id = split_part(r.key, ':', 3)
  AND r.seq >= i.start_seq AND (i.end_seq IS NULL OR r.seq < i.end_seq)
WHERE r.event_type IN ('click', 'view')"""


@query("d1_asof_enrichment", sql(ENRICHED))
def d1(spark, sf):
    return _found(projection.enriched_events(*routed_and_held(spark, sf)))


@query("d1_asof_enrichment_sliced", sql(ENRICHED))
def d1_sliced(spark, sf):
    """As for big input: heavy devices are cut into slices."""
    return _found(projection.enriched_events(*routed_and_held(spark, sf), slice_rows=200))


@query("d2_open_assignments", sql(
    "SELECT ticket_id, device_id, start_seq FROM intervals WHERE end_seq IS NULL"))
def d2_open(spark, sf):
    return assignment.open_assignments(intervals(spark, sf)).select("ticket_id", "device_id", "start_seq")


@query("d2_device_at", sql("""
SELECT g.seq, g.ticket_id, i.device_id FROM global_state_events g LEFT JOIN intervals i
  ON i.ticket_id = g.ticket_id AND g.seq >= i.start_seq AND (i.end_seq IS NULL OR g.seq < i.end_seq)
WHERE g.ticket_id IS NOT NULL"""))
def d2(spark, sf):
    made, held = routed_and_held(spark, sf)
    asked = projection.state_rows(made).where("ticket_id is not null").select("seq", "ticket_id")
    return assignment.device_at(asked, held)


@query("d6_rule_matches", sql("""
SELECT seq, rule, CASE rule WHEN 'Visitors' THEN 2 WHEN 'Rooms' THEN 3 WHEN 'BioSensors' THEN 1
  WHEN 'Position' THEN 2 END AS rank FROM routed"""))
def d6(spark, sf):
    return routing.rule_matches(feed(spark, sf), RULES).select("seq", "rule", "rank")


@query("h3_reconcile", sql("""
SELECT coalesce(e.key, f.key) AS key, CASE WHEN f.key IS NULL THEN 'missed' WHEN e.key IS NULL THEN 'wrong'
  ELSE 'matched' END AS status
FROM (SELECT DISTINCT key FROM raw WHERE source_type = 'key' AND key NOT LIKE '%:Status') e
FULL JOIN (SELECT DISTINCT key FROM raw WHERE value <> '' AND key LIKE 'Visitors:%') f ON e.key = f.key"""))
def h3(spark, sf):
    raw = feed(spark, sf)
    expected = feeds.key_events(raw).where(~F.col("key").endswith(":Status"))
    found = raw.where((F.col("value") != "") & F.col("key").startswith("Visitors:"))
    return profile.reconcile(expected, found)
