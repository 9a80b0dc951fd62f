"""Registered queries over the wide table: Q, P, E, F, G and I rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.operators import profile, visitor_queries as vq
from footfall.plans.registry import query
from footfall.plans.views import feed, rounded, sql, table, visits
from footfall.rules import STATE

WIDE = ", ".join(vq.WIDE)
NARROW = ", ".join(vq.NARROW)
NEWEST = "(SELECT max(event_timestamp) FROM ve)"
SUMMARY = """device_id, ticket_id, count(*) AS total_events, min(event_timestamp) AS first_event,
  max(event_timestamp) AS last_event, round(avg(heart_rate), 6) AS avg_heart_rate,
  min(heart_rate) AS min_heart_rate, max(heart_rate) AS max_heart_rate,
  round(avg(skin_conductivity), 6) AS avg_skin_conductivity,
  round(avg(skin_temperature), 6) AS avg_skin_temperature"""
MEANS = ["avg_heart_rate", "avg_skin_conductivity", "avg_skin_temperature"]


def busiest(df, column):
    """The value of a column with the most rows, as a scalar."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.max_by(column, F.struct("n", column))).scalar()


def busiest_sql(column, source="ve"):
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} DESC LIMIT 1)"


@query("q1_g1_device_events", sql(f"SELECT {WIDE} FROM ve WHERE device_id = {busiest_sql('device_id')}"))
def q1(spark, sf):
    ve = visits(spark, sf)
    return vq.device_events(ve, busiest(ve, "device_id"))


@query("q2_recent_events", sql(
    f"SELECT {WIDE} FROM ve WHERE event_timestamp >= {NEWEST} - INTERVAL 24 HOUR"))
def q2(spark, sf):
    ve = visits(spark, sf)
    return vq.recent_events(ve, vq.newest(ve), hours=24)


@query("q3_c33_events_between", sql(
    f"SELECT {WIDE} FROM ve WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' "
    "AND TIMESTAMP '2024-01-09 23:59:59'"))
def q3(spark, sf):
    return vq.events_between(visits(spark, sf), "2024-01-05 00:00:00", "2024-01-09 23:59:59")


@query("q4_e1_biometric_summary", sql(
    f"SELECT {SUMMARY} FROM ve WHERE heart_rate IS NOT NULL GROUP BY device_id, ticket_id"))
def q4(spark, sf):
    return rounded(vq.biometric_summary(visits(spark, sf)), *MEANS)


@query("q5_f1_movement", sql("""
SELECT event_timestamp, device_id, ticket_id, position_x, position_y, zone,
  lag(position_x) OVER w AS prev_x, lag(position_y) OVER w AS prev_y, lag(zone) OVER w AS prev_zone,
  datesub('second', lag(event_timestamp) OVER w, event_timestamp) AS seconds_since_last_event
FROM ve WHERE position_x IS NOT NULL AND position_y IS NOT NULL
WINDOW w AS (PARTITION BY device_id ORDER BY event_timestamp, event_id)"""))
def q5(spark, sf):
    return vq.movement(visits(spark, sf))


@query("q6_e3_zone_visits", sql("""
SELECT device_id, zone, count(*) AS visit_count, min(event_timestamp) AS first_visit,
  max(event_timestamp) AS last_visit, round(avg(heart_rate), 6) AS avg_heart_rate_in_zone
FROM ve WHERE zone IS NOT NULL GROUP BY device_id, zone"""))
def q6(spark, sf):
    return rounded(vq.zone_visits(visits(spark, sf)), "avg_heart_rate_in_zone")


@query("q7_i1_activity_level", sql("""
SELECT event_timestamp, device_id, ticket_id, accelerometer_x, accelerometer_y, accelerometer_z,
  round(sqrt(accelerometer_x * accelerometer_x + accelerometer_y * accelerometer_y
    + accelerometer_z * accelerometer_z), 6) AS activity_magnitude, heart_rate, zone
FROM ve WHERE accelerometer_x IS NOT NULL"""))
def q7(spark, sf):
    return rounded(vq.activity_level(visits(spark, sf)), "activity_magnitude")


@query("q8_g3_events_of_devices", sql(f"""
SELECT {NARROW} FROM ve WHERE device_id IN (SELECT device_id FROM ve WHERE zone = 'Zone_3' AND heart_rate > 135)"""))
def q8(spark, sf):
    ve = visits(spark, sf)
    listed = ve.where("zone = 'Zone_3' and heart_rate > 135").select("device_id")
    return vq.events_of_devices(ve, listed)


@query("q9_ticket_events", sql(f"SELECT {NARROW} FROM ve WHERE ticket_id = {busiest_sql('ticket_id')}"))
def q9(spark, sf):
    ve = visits(spark, sf)
    return vq.ticket_events(ve, busiest(ve, "ticket_id"))


@query("q10_i2_health_alerts", sql("""
SELECT event_timestamp, device_id, ticket_id, zone, heart_rate, skin_conductivity, skin_temperature,
  CASE WHEN heart_rate > 120 THEN 'High Heart Rate' WHEN heart_rate < 50 THEN 'Low Heart Rate'
       WHEN skin_temperature > 38 THEN 'High Temperature'
       WHEN skin_temperature < 35 THEN 'Low Temperature' ELSE 'Normal' END AS health_status
FROM ve WHERE heart_rate > 120 OR heart_rate < 50 OR skin_temperature > 38 OR skin_temperature < 35"""))
def q10(spark, sf):
    return vq.health_alerts(visits(spark, sf))


@query("q11_d3_latest_events", sql("""
SELECT ve.* FROM ve JOIN (SELECT device_id, max(event_timestamp) AS t FROM ve GROUP BY device_id) m
  ON ve.device_id = m.device_id AND ve.event_timestamp = m.t"""))
def q11(spark, sf):
    return vq.latest_events(visits(spark, sf))


@query("q12_f2_zone_path", sql("""
SELECT device_id, ticket_id, event_timestamp, previous_zone, zone AS current_zone, next_zone FROM (
  SELECT *, lag(zone) OVER w AS previous_zone, lead(zone) OVER w AS next_zone
  FROM ve WHERE zone IS NOT NULL WINDOW w AS (PARTITION BY device_id ORDER BY event_timestamp, event_id))
WHERE zone <> coalesce(previous_zone, '')"""))
def q12(spark, sf):
    return vq.zone_path(visits(spark, sf))


@query("q13_e4_i4_hourly_summary", sql("""
SELECT CAST(event_timestamp AS DATE) AS event_date, CAST(extract(hour FROM event_timestamp) AS BIGINT) AS hour,
  device_id, count(*) AS events_count, count(DISTINCT zone) AS zones_visited,
  round(avg(heart_rate), 6) AS avg_heart_rate, round(avg(skin_temperature), 6) AS avg_temperature,
  min(position_x) AS min_x, max(position_x) AS max_x, min(position_y) AS min_y, max(position_y) AS max_y
FROM ve GROUP BY ALL"""))
def q13(spark, sf):
    out = vq.hourly_summary(visits(spark, sf)).withColumn("hour", F.col("hour").cast("bigint"))
    return rounded(out, "avg_heart_rate", "avg_temperature")


@query("q14_e5_visitors_in_zone", sql(f"""
SELECT device_id, ticket_id, zone, max(event_timestamp) AS last_seen FROM ve
WHERE zone IS NOT NULL AND event_timestamp BETWEEN {NEWEST} - INTERVAL 5 MINUTE AND {NEWEST}
GROUP BY device_id, ticket_id, zone"""))
def q14(spark, sf):
    ve = visits(spark, sf)
    return vq.visitors_in_zone(ve, vq.newest(ve))


@query("q15_e6_distance_travelled", sql("""
SELECT device_id, count(*) AS position_updates,
  round(sum(sqrt((position_x - px) * (position_x - px) + (position_y - py) * (position_y - py))), 6)
    AS total_distance_traveled,
  min(event_timestamp) AS start_time, max(event_timestamp) AS end_time,
  datesub('minute', min(event_timestamp), max(event_timestamp)) AS duration_minutes
FROM (SELECT *, lag(position_x) OVER w AS px, lag(position_y) OVER w AS py FROM ve
      WHERE position_x IS NOT NULL AND position_y IS NOT NULL
      WINDOW w AS (PARTITION BY device_id ORDER BY event_timestamp, event_id))
WHERE px IS NOT NULL AND py IS NOT NULL GROUP BY device_id"""))
def q15(spark, sf):
    return rounded(vq.distance_travelled(visits(spark, sf)), "total_distance_traveled")


@query("p1_g2_latest_n", sql(f"""
SELECT {WIDE} FROM (SELECT *, row_number() OVER (PARTITION BY device_id
  ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM ve) WHERE rn <= 100"""))
def p1(spark, sf):
    return vq.latest_n(visits(spark, sf), 100)


@query("p2_c34_recent_visitor_events", sql(
    f"SELECT {NARROW} FROM ve WHERE event_timestamp >= {NEWEST} - INTERVAL 36 HOUR"))
def p2(spark, sf):
    ve = visits(spark, sf)
    return vq.recent_events(ve, vq.newest(ve), hours=36, columns=vq.NARROW)


@query("p3_e2_visitor_summary", sql(
    f"SELECT {SUMMARY}, count(DISTINCT zone) AS zones_visited FROM ve GROUP BY device_id, ticket_id"))
def p3(spark, sf):
    return rounded(vq.visitor_summary(visits(spark, sf)), *MEANS)


@query("p4_f3_zone_history", sql("""
SELECT device_id, event_timestamp, previous_zone, zone AS current_zone,
  datesub('minute', lag(event_timestamp) OVER (PARTITION BY device_id ORDER BY event_timestamp, event_id),
    event_timestamp) AS minutes_in_previous_zone
FROM (SELECT * FROM (SELECT *, lag(zone) OVER (PARTITION BY device_id ORDER BY event_timestamp, event_id)
        AS previous_zone FROM ve WHERE zone IS NOT NULL) WHERE zone <> coalesce(previous_zone, ''))"""))
def p4(spark, sf):
    return vq.zone_history(visits(spark, sf))


@query("p5_d4_latest_status", sql(f"""
SELECT v.device_id, v.ticket_id, v.event_timestamp AS last_seen, v.zone AS current_zone, v.heart_rate,
  v.skin_temperature, v.position_x, v.position_y
FROM ve v JOIN (SELECT device_id, max(event_timestamp) AS t FROM ve
  WHERE event_timestamp >= {NEWEST} - INTERVAL 1 HOUR GROUP BY device_id) m
  ON v.device_id = m.device_id AND v.event_timestamp = m.t"""))
def p5(spark, sf):
    ve = visits(spark, sf)
    return vq.latest_status(ve, vq.newest(ve))


@query("e12_load_check", sql("""
SELECT count(DISTINCT device_id) AS unique_devices, count(*) AS total_rows, min(event_timestamp) AS earliest,
  max(event_timestamp) AS latest, count(DISTINCT zone) AS zones,
  round(avg(heart_rate), 6) AS avg_heart_rate FROM ve WHERE device_id LIKE 'E3%'"""))
def e12(spark, sf):
    return rounded(profile.load_check(visits(spark, sf), "E3"), "avg_heart_rate")


@query("e12_load_check_zones", sql("""
SELECT zone, count(*) AS zone_rows FROM ve WHERE device_id LIKE 'E3%' AND zone IS NOT NULL GROUP BY zone"""))
def e12_zones(spark, sf):
    return profile.load_check_zones(visits(spark, sf), "E3")


@query("e13_state_check", sql("""
SELECT count(DISTINCT state_key) AS unique_keys, count(*) AS total_rows FROM global_state_events
WHERE state_key LIKE '%DeviceID%'"""))
def e13(spark, sf):
    return profile.state_check(table(spark, sf, STATE), "DeviceID")


@query("e13_state_check_keys", sql(
    "SELECT state_key, count(*) AS key_rows FROM global_state_events GROUP BY state_key"))
def e13_keys(spark, sf):
    return profile.state_check_keys(table(spark, sf, STATE))


@query("e14_table_totals", sql("""
SELECT count(*) AS total_rows, min(event_timestamp) AS earliest_event, max(event_timestamp) AS latest_event
FROM ve"""))
def e14(spark, sf):
    return profile.table_totals(visits(spark, sf))


@query("e15_h1_table_stats", sql("""
SELECT 'visitor_events' AS table_name, count(*) AS total_rows, count(DISTINCT device_id) AS unique_ids FROM ve
UNION ALL
SELECT 'global_state_events', count(*), count(DISTINCT state_key) FROM global_state_events"""))
def e15(spark, sf):
    return profile.table_stats({
        "visitor_events": (visits(spark, sf), "device_id"),
        "global_state_events": (table(spark, sf, STATE), "state_key"),
    })


METRICS = ["heart_rate", "skin_conductivity", "skin_temperature", "position_x"]


@query("e16_describe", sql("\nUNION ALL\n".join(f"""
SELECT '{m}' AS metric, count({m}) AS count, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS std,
  min({m}) AS min, round(quantile_cont({m}, 0.25), 6) AS p25, round(quantile_cont({m}, 0.5), 6) AS p50,
  round(quantile_cont({m}, 0.75), 6) AS p75, max({m}) AS max FROM ve""" for m in METRICS)))
def e16(spark, sf):
    return rounded(profile.describe(visits(spark, sf), METRICS), "mean", "std", "p25", "p50", "p75")


@query("e17_heart_rate_span", sql("""
SELECT round(avg(heart_rate), 6) AS mean_hr, min(heart_rate) AS min_hr, max(heart_rate) AS max_hr,
  min(event_timestamp) AS from_ts, max(event_timestamp) AS to_ts,
  datesub('second', min(event_timestamp), max(event_timestamp)) AS span_seconds FROM ve"""))
def e17(spark, sf):
    return rounded(profile.heart_rate_span(visits(spark, sf)), "mean_hr")


@query("e18_channel_counts", sql("""
SELECT key, count(*) AS messages FROM raw WHERE source_type = 'channel'
  AND key LIKE 'Wearables:WatchDevices:%:BioSensors' GROUP BY key"""))
def e18(spark, sf):
    return profile.channel_counts(feed(spark, sf), "Wearables:WatchDevices:*:BioSensors")


CATEGORIES = {
    "wearables": "Wearables:WatchDevices:*",
    "rooms": "Rooms:*",
    "statuses": "Visitors:*:Status",
    "visitors": "Visitors:*",
}


@query("e20_key_categories", sql("""
SELECT category, count(*) AS key_count, string_agg(key, ',' ORDER BY key) FILTER (WHERE rn <= 3) AS examples
FROM (SELECT category, key, row_number() OVER (PARTITION BY category ORDER BY key) AS rn FROM (
  SELECT DISTINCT 'wearables' AS category, key FROM raw WHERE key LIKE 'Wearables:WatchDevices:%'
  UNION ALL SELECT DISTINCT 'rooms', key FROM raw WHERE key LIKE 'Rooms:%'
  UNION ALL SELECT DISTINCT 'statuses', key FROM raw WHERE key LIKE 'Visitors:%:Status'
  UNION ALL SELECT DISTINCT 'visitors', key FROM raw WHERE key LIKE 'Visitors:%'))
GROUP BY category UNION ALL SELECT 'lifts', 0, NULL"""))
def e20(spark, sf):
    return profile.key_categories(feed(spark, sf), {**CATEGORIES, "lifts": "Lifts:*"})


@query("e21_channel_discovery", sql("""
SELECT count(*) FILTER (WHERE key NOT LIKE '%BlueIoT%') AS messages,
  count(*) FILTER (WHERE key LIKE '%BlueIoT%') AS filtered,
  count(DISTINCT key) FILTER (WHERE key NOT LIKE '%BlueIoT%') AS channels
FROM raw WHERE source_type = 'channel'"""))
def e21(spark, sf):
    return profile.channel_discovery(feed(spark, sf), ["BlueIoT"])


@query("e21_h4_discovered_channels", sql("""
SELECT DISTINCT key AS channel FROM raw WHERE source_type = 'channel' AND key NOT LIKE '%BlueIoT%'"""))
def e21_channels(spark, sf):
    return profile.discovered_channels(feed(spark, sf), ["BlueIoT"])


ASSEMBLY = {
    "heart_rate": "average",
    "skin_conductivity": "sum",
    "skin_temperature": "max",
    "position_x": "min",
    "position_y": "first",
    "zone": "last",
}
ASSEMBLY_SQL = """
SELECT time_bucket(INTERVAL {width}, event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL {width}, event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL {width} AS window_end,
  device_id, round(avg(heart_rate), 6) AS heart_rate, round(sum(skin_conductivity), 6) AS skin_conductivity,
  max(skin_temperature) AS skin_temperature, min(position_x) AS position_x,
  arg_min(position_y, event_timestamp) FILTER (WHERE position_y IS NOT NULL) AS position_y,
  arg_max(zone, event_timestamp) FILTER (WHERE zone IS NOT NULL) AS zone, count(*) AS source_rows
FROM ve GROUP BY ALL"""


@query("e23_windowed_assembly", sql(ASSEMBLY_SQL.format(width="5 SECOND")))
def e23(spark, sf):
    out = profile.windowed_assembly(visits(spark, sf), ASSEMBLY)
    return rounded(out, "heart_rate", "skin_conductivity")


@query("e25_prefix_counts", sql("""
SELECT prefix, count(*) AS row_count, count(DISTINCT device_id) AS unique_values
FROM (SELECT device_id, unnest(['E30000', 'E300001']) AS prefix FROM ve)
WHERE starts_with(device_id, prefix) GROUP BY prefix UNION ALL SELECT 'X', 0, 0"""))
def e25(spark, sf):
    return profile.prefix_counts(visits(spark, sf), "device_id", ["E30000", "E300001", "X"])


@query("f8_resample_mean", sql("""
SELECT minute, mean_value FROM (
  SELECT unnest(generate_series(date_trunc('minute', min(event_timestamp)),
    date_trunc('minute', max(event_timestamp)), INTERVAL 1 MINUTE)) AS minute FROM ve)
LEFT JOIN (SELECT date_trunc('minute', event_timestamp) AS minute, round(avg(heart_rate), 6) AS mean_value
  FROM ve GROUP BY 1) USING (minute)"""))
def f8(spark, sf):
    return rounded(profile.resample_mean(visits(spark, sf)), "mean_value")
