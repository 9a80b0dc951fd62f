"""The inputs of the registered queries, as Spark frames and as SQL for the oracle.

Both sides state the same rule: ``events`` seen as the wide table and as the raw feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.assignment import assignment_intervals, assignment_log
from footfall.operators.projection import (
    enriched_events,
    enriched_rows,
    sensor_table,
    state_rows,
)
from footfall.operators.routing import route
from footfall.rules import BLUEIOT, EMPATICA, STATE
from footfall.sources.events_view import events, raw_events, visitor_events


def visits(spark: SparkSession, sf: str) -> DataFrame:
    return visitor_events(events(spark, sf))


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return raw_events(events(spark, sf))


def routed(spark: SparkSession, sf: str) -> DataFrame:
    return route(feed(spark, sf))


def with_faults(raw: DataFrame) -> DataFrame:
    """The feed with events that no rule takes (every seventh) and sensor events without a device (every fifth)."""
    key, seq = F.col("key"), F.col("seq")
    nameless = F.regexp_replace(key, "^(Wearables:WatchDevices:)[^:]+", "$1")
    changed = F.when(seq % 7 == 0, F.concat(F.lit("Unknown:"), key)).when(seq % 5 == 0, nameless).otherwise(key)
    return raw.withColumn("key", changed)


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    return assignment_intervals(assignment_log(feed(spark, sf)))


def routed_and_held(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The routed feed and the assignment intervals of the same feed."""
    raw = feed(spark, sf)
    return route(raw), assignment_intervals(assignment_log(raw))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One target table, with ``seq``."""
    if name == STATE:
        return state_rows(routed(spark, sf))
    made, held = routed_and_held(spark, sf)
    return enriched_rows(made, name, held)


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The three target tables, in table order, with one look-up for both sensor tables."""
    made, held = routed_and_held(spark, sf)
    sensors = enriched_events(made, held)
    out = {name: sensor_table(sensors, name) for name in (EMPATICA, BLUEIOT)}
    return {**out, STATE: state_rows(made)}


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Means and sums of doubles depend on the order of addition in their last bits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


_RAW = """
  SELECT event_id AS seq, ts AS event_timestamp, k, event_type, user_id,
    CASE WHEN event_type IN ('click','view') THEN 'channel' ELSE 'key' END AS source_type,
    CASE event_type
      WHEN 'click' THEN 'Wearables:WatchDevices:' || device || ':BioSensors'
      WHEN 'view' THEN 'Wearables:WatchDevices:' || device || ':BlueIoTSensors'
      WHEN 'signup' THEN 'Visitors:' || {ticket} || ':EmpaticaDeviceID'
      WHEN 'error' THEN 'Visitors:' || {ticket} || ':Status'
      WHEN 'purchase' THEN 'Rooms:' || CAST(user_id % 8 AS VARCHAR) || ':Lighting:Brightness' END AS key,
    CASE event_type
      WHEN 'click' THEN CASE WHEN k = 99 THEN '{{bad' ELSE
        '{{"Heart_Rate_Value":' || k || ',"Steps":' || (event_id % 50) || '}}' END
      WHEN 'view' THEN '{{"BlueIoT_Position":[' || k || ',' || (event_id % 100) ||
        '],"Room_ID":' || (k % 8) || '}}'
      WHEN 'signup' THEN CASE WHEN k % 10 = 0 THEN '' ELSE device END
      WHEN 'error' THEN CASE WHEN k % 4 = 0 THEN 'Inactive' ELSE 'Active' END
      WHEN 'purchase' THEN CAST(k % 3 AS VARCHAR) END AS value,
    CASE event_type WHEN 'error' THEN -1 WHEN 'purchase' THEN k END AS ttl
  FROM {source}
"""

_RULE = """CASE
    WHEN source_type = 'key' AND key LIKE 'Galleries:%' THEN 'Galleries'
    WHEN source_type = 'key' AND key LIKE 'Wearables:%' THEN 'Wearables'
    WHEN source_type = 'key' AND key LIKE 'Visitors:%' THEN 'Visitors'
    WHEN source_type = 'key' AND key LIKE 'Rooms:%' THEN 'Rooms'
    WHEN source_type = 'key' AND key LIKE 'IO:%' THEN 'IO'
    WHEN source_type = 'channel' AND key = 'Visitors:Register' THEN 'VisitorRegister'
    WHEN source_type = 'channel' AND key LIKE 'Wearables:WatchDevices:%:BioSensors' THEN 'BioSensors'
    WHEN source_type = 'channel' AND key LIKE 'Wearables:WatchDevices:%:BlueIoTSensors' THEN 'Position'
    WHEN source_type = 'channel' AND key LIKE 'Visitors:%:Status' THEN 'VisitorStatus'
    WHEN source_type = 'channel' AND key LIKE 'Visitors:%:AssignDevice' THEN 'DeviceAssignment'
  END"""

_LOG = """
  SELECT seq, trim(split_part(key, ':', 2)) AS ticket_id,
    CASE WHEN key LIKE '%:EmpaticaDeviceID' THEN nullif(trim(value), '') END AS device_id
  FROM {source}
  WHERE key LIKE 'Visitors:%:EmpaticaDeviceID'
     OR (key LIKE 'Visitors:%:Status' AND trim(value) = 'Inactive')
"""

_INTERVALS = """
  SELECT device_id, ticket_id, seq AS start_seq, least(ticket_next, device_next) AS end_seq
  FROM (SELECT *, lead(seq) OVER (PARTITION BY device_id ORDER BY seq) AS device_next
        FROM (SELECT *, lead(seq) OVER (PARTITION BY ticket_id ORDER BY seq) AS ticket_next FROM {log})
        WHERE device_id IS NOT NULL)
"""

_BIO = """
  SELECT r.seq, r.event_timestamp, split_part(r.key, ':', 3) AS device_id, r.value <> '{{bad' AS payload_ok,
    CASE WHEN r.value <> '{{bad' THEN CAST(r.k AS DOUBLE) END AS heart_rate,
    CASE WHEN r.value <> '{{bad' THEN r.seq % 50 END AS steps,
    CASE WHEN r.value <> '{{bad' THEN i.ticket_id END AS ticket_id
  FROM {source} r LEFT JOIN {intervals} i ON i.device_id = split_part(r.key, ':', 3)
    AND r.seq >= i.start_seq AND (i.end_seq IS NULL OR r.seq < i.end_seq)
  WHERE r.event_type = 'click'
"""

_POS = """
  SELECT r.seq, r.event_timestamp, split_part(r.key, ':', 3) AS device_id, true AS payload_ok,
    CAST(r.k AS DOUBLE) AS position_x, CAST(r.seq % 100 AS DOUBLE) AS position_y, r.k % 8 AS room,
    i.ticket_id
  FROM {source} r LEFT JOIN {intervals} i ON i.device_id = split_part(r.key, ':', 3)
    AND r.seq >= i.start_seq AND (i.end_seq IS NULL OR r.seq < i.end_seq)
  WHERE r.event_type = 'view'
"""

_STATE = """
  SELECT seq, event_timestamp, source_type AS event_source_type,
    CASE WHEN key LIKE 'Visitors:%' THEN split_part(key, ':', 2) END AS ticket_id,
    key AS state_key, value AS state_value, nullif(ttl, -1) AS ttl_seconds
  FROM {source} WHERE event_type IN ('signup', 'error', 'purchase')
"""

_CHANGED = """
  SELECT * EXCLUDE (before) FROM (
    SELECT *, lag(value) OVER (PARTITION BY key ORDER BY seq) AS before FROM {source}
    WHERE source_type = 'key')
  WHERE before IS DISTINCT FROM value
"""

_UUID = "(substr(md5({t}),1,8) || '-' || substr(md5({t}),9,4) || '-' || substr(md5({t}),13,4) || '-' || substr(md5({t}),17,4) || '-' || substr(md5({t}),21,12))"
_TICKET = "('T' || ((user_id * 7 + k) % 40))"

CTES = {
    "base": """
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    'E3' || CASE WHEN length(CAST(user_id AS VARCHAR)) < 6 THEN lpad(CAST(user_id AS VARCHAR), 6, '0')
                 ELSE CAST(user_id AS VARCHAR) END AS device
  FROM events
""",
    "ve": """
  SELECT event_id, ts AS event_timestamp, device AS device_id, 'T' || (user_id + 7 * (k % 3)) AS ticket_id,
    CASE WHEN event_type <> 'error' THEN value END AS position_x,
    CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) END AS position_y,
    CASE WHEN event_type <> 'signup' THEN 'Zone_' || (k % 8) END AS zone,
    CASE WHEN event_type <> 'purchase' THEN CAST(40 + k AS DOUBLE) END AS heart_rate,
    CAST(k AS DOUBLE) / CAST(10 AS DOUBLE) AS skin_conductivity,
    CAST(30 AS DOUBLE) + CAST(event_id % 100 AS DOUBLE) / CAST(10 AS DOUBLE) AS skin_temperature,
    CASE WHEN event_type <> 'view' THEN CAST(k % 5 AS DOUBLE) END AS accelerometer_x,
    CASE WHEN event_type <> 'view' THEN CAST(k % 7 AS DOUBLE) END AS accelerometer_y,
    CASE WHEN event_type <> 'view' THEN CAST(k % 11 AS DOUBLE) END AS accelerometer_z
  FROM base
""",
    "raw": _RAW.format(source="base", ticket=_TICKET),
    "uraw": _RAW.format(source="base", ticket=_UUID.format(t=_TICKET)),
    "routed": f"SELECT *, {_RULE} AS rule FROM raw",
    "assign_log": _LOG.format(source="raw"),
    "intervals": _INTERVALS.format(log="assign_log"),
    "empatica": _BIO.format(source="raw", intervals="intervals"),
    "blueiot": _POS.format(source="raw", intervals="intervals"),
    "global_state_events": _STATE.format(source="raw"),
    "changed": _CHANGED.format(source="raw"),
    # the live pipeline: unchanged key values are dropped first
    "live": "SELECT * FROM changed UNION ALL SELECT * FROM raw WHERE source_type = 'channel'",
    "live_log": _LOG.format(source="live"),
    "live_intervals": _INTERVALS.format(log="live_log"),
    "live_empatica": _BIO.format(source="live", intervals="live_intervals"),
    "live_blueiot": _POS.format(source="live", intervals="live_intervals"),
    "live_state": _STATE.format(source="live"),
    "replay": """
  SELECT epoch_us(event_timestamp) // 1000 AS timestamp, 'channel' AS type,
    'Wearables:WatchDevices:' || device_id || ':BioSensors' AS key,
    CASE WHEN payload_ok THEN '{"Heart_Rate_Value":' || CAST(heart_rate AS BIGINT) || ',"Steps":' || steps || '}'
         ELSE '{}' END AS text,
    'json' AS value_type, CAST(NULL AS BIGINT) AS ttl, seq, 0 AS table_rank
  FROM empatica
  UNION ALL
  SELECT epoch_us(event_timestamp) // 1000, 'channel', 'Wearables:WatchDevices:' || device_id || ':BlueIoTSensors',
    '{"BlueIoT_Position":[' || CAST(position_x AS BIGINT) || '.0,' || CAST(position_y AS BIGINT) ||
    '.0],"Room_ID":' || room || '}', 'json', NULL, seq, 1
  FROM blueiot
  UNION ALL
  SELECT epoch_us(event_timestamp) // 1000, event_source_type, state_key, state_value,
    CASE WHEN state_key LIKE 'Rooms:%' THEN 'int' ELSE 'string' END, ttl_seconds, seq, 2
  FROM global_state_events
""",
}


def sql(body: str, **extra: str) -> str:
    """A query over the views; ``extra`` adds named sub-queries of its own."""
    parts = {**CTES, **extra}
    head = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {head}\n{body}"
