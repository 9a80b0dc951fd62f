"""Registered queries of the streaming forms: J rows and E23 on a stream.

Each runs its stream over what the data set holds and returns what the stream wrote.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from footfall.operators.assignment import assignment_intervals, assignment_log, open_assignments
from footfall.operators.changes import suppress_unchanged
from footfall.operators.routing import route
from footfall.plans.library import ASSEMBLY, ASSEMBLY_SQL
from footfall.plans.registry import query
from footfall.plans.views import feed, rounded, sql, visits, with_faults
from footfall.rules import BLUEIOT, EMPATICA, KEY, STATE
from footfall.session import work_path, written
from footfall.sources.events_view import events_stream, raw_events, visitor_events
from footfall.sources.feeds import key_events, read_raw, stream_raw
from footfall.streaming.bridge import Bridge, compact_output, read_output, read_stats, start_bridge
from footfall.streaming.changes import last_hashes, start_changes
from footfall.streaming.windows import LateSplit, assemble_sessions, assemble_stream, run_available


def _live(spark, sf, change=lambda raw: raw, before=None):
    """The live pipeline over what the data set holds."""
    home = work_path(spark, "live")
    bridge = Bridge(spark, f"{home}/tables", f"{home}/state")
    if before:
        before(bridge)
    start_bridge(
        change(raw_events(events_stream(spark, sf))), bridge, f"{home}/checkpoint", interval=None
    ).awaitTermination()
    return bridge


@query("b11_j1_live_counters", sql("""
SELECT count(*) AS received, count(*) FILTER (WHERE seq % 7 = 0) AS unrouted,
  count(*) FILTER (WHERE seq % 7 <> 0 AND seq % 5 = 0 AND event_type IN ('click', 'view')) AS skipped,
  count(*) FILTER (WHERE seq % 7 <> 0 AND seq % 5 <> 0 AND event_type = 'click') AS empatica,
  count(*) FILTER (WHERE seq % 7 <> 0 AND seq % 5 <> 0 AND event_type = 'view') AS blueiot,
  (SELECT count(*) FROM kept) AS global_state_events,
  count(*) FILTER (WHERE seq % 7 <> 0 AND event_type NOT IN ('click', 'view')) - (SELECT count(*) FROM kept) AS unchanged FROM raw""",
    kept="""SELECT * FROM (SELECT *, lag(value) OVER (PARTITION BY key ORDER BY seq) AS before FROM raw
  WHERE source_type = 'key' AND seq % 7 <> 0) WHERE before IS DISTINCT FROM value"""))
def b11_live(spark, sf):
    """What the live pipeline counts of a feed with events that no rule takes and that name no device."""
    names = ["received", "unrouted", "skipped", EMPATICA, BLUEIOT, STATE, "unchanged"]
    return read_stats(_live(spark, sf, with_faults)).agg(*[F.sum(n).alias(n) for n in names])


@query("b8_compacted_output", sql("""
SELECT event_timestamp, state_key, ticket_id, state_value FROM live_state"""))
def b8(spark, sf):
    bridge = _live(spark, sf)
    done = read_output(bridge, STATE).agg(F.max("batch_id")).first()[0] + 1
    return compact_output(bridge, STATE, done).select("event_timestamp", "state_key", "ticket_id", "state_value")


@query("j1_j2_j5_live_pipeline", sql("""
SELECT 'empatica' AS table_name, event_timestamp, device_id AS id, ticket_id, CAST(CAST(heart_rate AS BIGINT) AS VARCHAR) AS reading
FROM live_empatica
UNION ALL SELECT 'blueiot', event_timestamp, device_id, ticket_id, CAST(room AS VARCHAR) FROM live_blueiot
UNION ALL SELECT 'global_state_events', event_timestamp, state_key, ticket_id, state_value FROM live_state"""))
def j1(spark, sf):
    return _readings(_live(spark, sf))


def _readings(bridge):
    shapes = [
        (EMPATICA, "device_id", F.col("heart_rate").cast("bigint").cast("string")),
        (BLUEIOT, "device_id", F.col("room").cast("string")),
        (STATE, "state_key", F.col("state_value")),
    ]
    parts = [
        read_output(bridge, t).select(
            F.lit(t).alias("table_name"), "event_timestamp", F.col(i).alias("id"), "ticket_id",
            reading.alias("reading"),
        )
        for t, i, reading in shapes
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


BATCHES = 12
#: Files of a part of the feed: what one micro-batch takes in.
FILES = 4


def _feed_files(raw, folder, parts):
    """The feed in ``parts`` parts in order of arrival, each of ``FILES`` files, one part written after the other:
    files are taken in order of age."""
    ends = raw.agg(F.min("seq").alias("a"), F.max("seq").alias("b")).first()
    for i in range(parts):
        low, high = (ends.a + (ends.b + 1 - ends.a) * n // parts for n in (i, i + 1))
        part = raw.where((F.col("seq") >= low) & (F.col("seq") < high))
        part.repartition(FILES).write.mode("append").parquet(folder)


@query("j1_live_many_batches", sql("""
SELECT 'empatica' AS table_name, event_timestamp, device_id AS id, ticket_id, CAST(CAST(heart_rate AS BIGINT) AS VARCHAR) AS reading
FROM live_empatica
UNION ALL SELECT 'blueiot', event_timestamp, device_id, ticket_id, CAST(room AS VARCHAR) FROM live_blueiot
UNION ALL SELECT 'global_state_events', event_timestamp, state_key, ticket_id, state_value FROM live_state"""))
def j1_many(spark, sf):
    """The live pipeline over the feed in twelve parts, a micro-batch each."""
    home = work_path(spark, "live-many")
    _feed_files(feed(spark, sf), f"{home}/feed", BATCHES)
    bridge = Bridge(spark, f"{home}/tables", f"{home}/state")
    stream = stream_raw(spark, f"{home}/feed", max_files=FILES)
    start_bridge(stream, bridge, f"{home}/checkpoint", interval=None).awaitTermination()
    return _readings(bridge)


class Cut(RuntimeError):
    """The end of a process between two writes of a batch."""


class CutBridge(Bridge):
    """A pipeline that ends in one batch, after its state is written and before its rows are."""

    ends_in = 1

    def _write(self, rows, batch_id):
        if batch_id == self.ends_in:
            raise Cut(f"batch {batch_id}")
        return super()._write(rows, batch_id)


@query("j6_j8_restart_after_cut", sql("""
SELECT 'empatica' AS table_name, event_timestamp, device_id AS id, ticket_id, CAST(CAST(heart_rate AS BIGINT) AS VARCHAR) AS reading
FROM live_empatica WHERE seq >= (SELECT (min(seq) + max(seq)) // 2 FROM raw)
UNION ALL SELECT 'blueiot', event_timestamp, device_id, ticket_id, CAST(room AS VARCHAR) FROM live_blueiot
  WHERE seq >= (SELECT (min(seq) + max(seq)) // 2 FROM raw)
UNION ALL SELECT 'global_state_events', event_timestamp, state_key, ticket_id, state_value FROM live_state
  WHERE seq >= (SELECT (min(seq) + max(seq)) // 2 FROM raw)"""))
def j6_j8(spark, sf):
    """The second half of the feed after a restart: seeded with the first half's state, cut off inside a batch, started
    again from the checkpoint, merged, and its first batches run once more. The rows are those of one undisturbed run."""
    home, raw = work_path(spark, "live-restart"), feed(spark, sf)
    ends = raw.agg(F.min("seq").alias("a"), F.max("seq").alias("b")).first()
    middle = (ends.a + ends.b) // 2
    earlier = route(raw.where(F.col("seq") < middle))
    log = assignment_log(suppress_unchanged(earlier))
    still_open = open_assignments(assignment_intervals(log)).select(F.col("start_seq").alias("seq"), "ticket_id", "device_id")
    seeds = {
        "seed": written(still_open, "seed-assignments"),
        "seed_hashes": written(last_hashes(earlier.where(F.col("source_type") == KEY)), "seed-hashes"),
    }
    _feed_files(raw.where(F.col("seq") >= middle), f"{home}/feed", 3)
    where = (spark, f"{home}/tables", f"{home}/state")
    stream = stream_raw(spark, f"{home}/feed", max_files=FILES)
    first = start_bridge(stream, CutBridge(*where, **seeds), f"{home}/checkpoint", interval=None)
    try:
        first.awaitTermination()
        raise AssertionError("the batch was to be cut off")
    except StreamingQueryException as e:
        if "Cut" not in str(e):
            raise
    bridge = Bridge(*where, **seeds)
    start_bridge(stream, bridge, f"{home}/checkpoint", interval=None).awaitTermination()
    compact_output(bridge, STATE, 2)
    files = sorted(spark.read.parquet(f"{home}/feed").select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect(), key=lambda r: r[1])
    for batch_id in (0, 1):  # a batch that was merged adds nothing; one of other tables replaces its own rows
        part = [r[0] for r in files[batch_id * FILES : (batch_id + 1) * FILES]]
        bridge.process(read_raw(spark, part), batch_id)
    return _readings(bridge)


@query("j3_j9_e23_stream_windows", sql(
    "SELECT * FROM assembled WHERE window_end <= (SELECT max(event_timestamp) FROM ve) - INTERVAL 10 MINUTE",
    assembled=ASSEMBLY_SQL.format(width="5 SECOND")))
def j3(spark, sf):
    """Windows that the watermark (ten minutes behind the newest event) has closed."""
    home = work_path(spark, "windows")
    stream = assemble_stream(visitor_events(events_stream(spark, sf)), ASSEMBLY)
    out = run_available(stream, f"{home}/out", f"{home}/checkpoint")
    return rounded(out, "heart_rate", "skin_conductivity")


@query("j3_session_assembly", sql("""
SELECT min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL 1 HOUR AS session_end, device_id,
  round(avg(heart_rate), 6) AS heart_rate, count(*) AS source_rows
FROM (SELECT *, sum(fresh) OVER (PARTITION BY device_id ORDER BY event_timestamp, event_id) AS part FROM (
  SELECT *, CASE WHEN event_timestamp < lag(event_timestamp) OVER (PARTITION BY device_id
    ORDER BY event_timestamp, event_id) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM ve))
GROUP BY device_id, part"""))
def j3_sessions(spark, sf):
    return rounded(assemble_sessions(visits(spark, sf), "heart_rate", "1 hour"), "heart_rate")


@query("j3_session_hot_device", sql("""
SELECT min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL 10 MINUTE AS session_end, device_id,
  round(avg(heart_rate), 6) AS heart_rate, count(*) AS source_rows
FROM (SELECT *, sum(fresh) OVER (PARTITION BY device_id ORDER BY event_timestamp, event_id) AS part FROM (
  SELECT *, CASE WHEN event_timestamp <= lag(event_timestamp) OVER (PARTITION BY device_id
    ORDER BY event_timestamp, event_id) + INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS fresh
  FROM (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN 'E3GATE' ELSE device_id END AS device_id) FROM ve)))
GROUP BY device_id, part"""))
def j3_session_hot(spark, sf):
    """Sessions of a feed in which one device, a gate, has half of all rows and goes silent a few times an hour."""
    gate = F.when(F.col("event_id") % 2 == 0, F.lit("E3GATE")).otherwise(F.col("device_id"))
    events = visits(spark, sf).withColumn("device_id", gate)
    return rounded(assemble_sessions(events, "heart_rate", "10 minutes", slice_rows=1000), "heart_rate")


@query("j3_session_stream", sql("""
SELECT session_start, session_end, device_id, heart_rate, source_rows FROM (
  SELECT min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL 1 HOUR AS session_end, device_id,
    round(avg(heart_rate), 6) AS heart_rate, count(*) AS source_rows
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY device_id ORDER BY event_timestamp, event_id) AS part FROM (
    SELECT *, CASE WHEN event_timestamp < lag(event_timestamp) OVER (PARTITION BY device_id
      ORDER BY event_timestamp, event_id) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM ve))
  GROUP BY device_id, part)
WHERE session_end <= (SELECT max(event_timestamp) FROM ve) - INTERVAL 10 MINUTE"""))
def j3_session_stream(spark, sf):
    """Sessions that the watermark (ten minutes behind the newest event) has closed."""
    home = work_path(spark, "sessions")
    stream = assemble_sessions(visitor_events(events_stream(spark, sf)), "heart_rate", "1 hour", "10 minutes")
    return rounded(run_available(stream, f"{home}/out", f"{home}/checkpoint"), "heart_rate")


LATE_EVERY = 20


@query("j9_windows_and_late_rows", sql("""
SELECT 'window' AS kind, time_bucket(INTERVAL 5 SECOND, event_timestamp, TIMESTAMP '1970-01-01') AS at, device_id, count(*) AS source_rows
FROM judged WHERE NOT late AND time_bucket(INTERVAL 5 SECOND, event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL 5 SECOND
  <= (SELECT date_trunc('millisecond', max(event_timestamp)) FROM ve) - INTERVAL 10 MINUTE GROUP BY ALL
UNION ALL SELECT 'late', event_timestamp, device_id, count(*) FROM judged WHERE late GROUP BY ALL""",
    judged="""SELECT *, event_id % 20 = 0 AND time_bucket(INTERVAL 5 SECOND, event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL 5 SECOND
  <= (SELECT date_trunc('millisecond', max(event_timestamp)) FROM ve WHERE event_id % 20 <> 0) - INTERVAL 10 MINUTE AS late FROM ve"""))
def j9(spark, sf):
    """Windows of a feed whose every twentieth row comes at the end, and beside them the rows that came too late.

    Together with the windows that are still open they hold every row of the feed.
    """
    home = work_path(spark, "late")
    rows = visits(spark, sf)
    held = F.col("event_id") % LATE_EVERY == 0
    for part in (rows.where(~held), rows.where(held)):  # files are taken in order of age
        part.repartition(FILES).write.mode("append").parquet(f"{home}/feed")
    split = LateSplit(spark, f"{home}/split")
    feed_ = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(f"{home}/feed")
    split.start(feed_, f"{home}/checkpoint-split").awaitTermination()
    closed = run_available(assemble_stream(split.in_time(rows.schema), {}), f"{home}/out", f"{home}/checkpoint")
    late = split.late(rows.schema).groupBy(F.col("event_timestamp").alias("at"), "device_id").agg(F.count("*").alias("source_rows"))
    windows = closed.select(F.lit("window").alias("kind"), F.col("window_start").alias("at"), "device_id", "source_rows")
    return windows.unionByName(late.select(F.lit("late").alias("kind"), "at", "device_id", "source_rows"))


@query("j4_stream_changed_keys", sql("SELECT seq, source_type, key, value FROM changed"))
def j4(spark, sf):
    home = work_path(spark, "changes")
    columns = ["seq", "source_type", "key", "value"]
    stream = key_events(raw_events(events_stream(spark, sf)))
    start_changes(stream, f"{home}/out", f"{home}/state", f"{home}/checkpoint", columns).awaitTermination()
    return spark.read.schema(stream.select(*columns).schema).parquet(f"{home}/out").select(*columns)


@query("j7_admission", sql("""
SELECT kind, count(*) AS events, 6 AS batches, true AS within FROM raw CROSS JOIN (VALUES ('files'), ('bytes')) AS k (kind) GROUP BY kind"""))
def j7(spark, sf):
    """Limits on what a micro-batch takes in: a backlog of twelve files, in six batches by number of files and by bytes.

    ``within`` says that no batch took more than its limit, by the stream's own progress.
    """
    home, raw = work_path(spark, "admission"), feed(spark, sf)
    raw.repartition(12).write.parquet(f"{home}/feed")
    sizes = [r[0] for r in spark.read.parquet(f"{home}/feed").select("_metadata.file_size", "_metadata.file_path").distinct().collect()]
    per_file = spark.read.parquet(f"{home}/feed").groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    rows = []
    for kind, limit in (("files", {"max_files": 2}), ("bytes", {"max_bytes": str(2 * max(sizes))})):
        stream = stream_raw(spark, f"{home}/feed", **limit).select("seq")
        out = stream.writeStream.format("noop").option("checkpointLocation", f"{home}/checkpoint-{kind}").trigger(availableNow=True).start()
        out.awaitTermination()
        taken = [p.numInputRows for p in out.recentProgress if p.numInputRows]
        rows.append((kind, sum(taken), len(taken), max(taken, default=0) <= 2 * per_file))
    return spark.createDataFrame(rows, "kind string, events bigint, batches int, within boolean")
