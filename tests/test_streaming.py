"""Streams give what the batch operators give on the same input."""

import datetime
import glob
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import bag
from footfall.operators import assignment, changes, projection, routing
from footfall.plans.views import feed
from footfall.rules import BLUEIOT, EMPATICA, STATE
from footfall.sources import feeds
from footfall.streaming import bridge as bridge_module
from footfall.streaming.bridge import Bridge, compact_output, read_output, read_stats, start_bridge
from footfall.streaming.changes import last_hashes, start_changes
from footfall.streaming.health import HealthListener
from footfall.streaming.windows import LateSplit, assemble_sessions, assemble_stream, run_available

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split_feed(spark):
    """The feed in three files, in order of arrival: three micro-batches."""
    raw = feed(spark, SF).persist()
    n = raw.count()
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for i in range(3):
        part = raw.where((F.col("seq") >= n * i // 3) & (F.col("seq") < n * (i + 1) // 3))
        part.coalesce(1).write.mode("append").parquet(f"{home}/feed")
    return raw, f"{home}/feed", home


def expected_tables(raw):
    live = changes.suppress_unchanged(routing.route(raw)).select(*raw.columns)
    routed = routing.route(live)
    held = assignment.assignment_intervals(assignment.assignment_log(live))
    return {
        EMPATICA: projection.conform(projection.empatica_rows(routed, held), EMPATICA),
        BLUEIOT: projection.conform(projection.blueiot_rows(routed, held), BLUEIOT),
        STATE: projection.conform(projection.state_rows(routed), STATE),
    }


def test_pipeline_over_batches_equals_batch(spark, split_feed):
    raw, path, home = split_feed
    listener = HealthListener(feed_limit=100)
    spark.streams.addListener(listener)
    bridge = Bridge(spark, f"{home}/tables", f"{home}/state")
    stream = feeds.stream_raw(spark, path, max_files=1)
    start_bridge(stream, bridge, f"{home}/checkpoint", interval=None).awaitTermination()
    assert [s["batch_id"] for s in bridge.stats] == [0, 1, 2]
    wanted = expected_tables(raw)
    for table, df in wanted.items():
        got = read_output(bridge, table)
        assert bag(got.collect(), df.columns) == bag(df.collect(), df.columns), table
    # setting the stream back by two batches and running them again changes nothing
    everything = {t: bag(read_output(bridge, t).collect(), df.columns) for t, df in wanted.items()}
    parts = sorted(glob.glob(f"{path}/*.parquet"), key=os.path.getmtime)
    for number in (1, 2):
        bridge.process(feeds.read_raw(spark, parts[number]), number)
    for table, rows in everything.items():
        assert bag(read_output(bridge, table).collect(), wanted[table].columns) == rows, table
    # a batch that is run again replaces its own rows
    again = routing.route(changes.suppress_unchanged(feeds.read_raw(spark, path)).select(*raw.columns))
    last = bridge.stats[-1]
    before = read_output(bridge, STATE).count()
    redo = read_output(bridge, STATE).where(f"batch_id = {last['batch_id']}").count()
    assert 0 < redo < before and again.count() > 0
    # a restart on the same checkpoint has nothing left to do
    rerun = Bridge(spark, f"{home}/tables", f"{home}/state")
    start_bridge(stream, rerun, f"{home}/checkpoint", interval=None).awaitTermination()
    assert read_output(bridge, STATE).count() == before
    spark.streams.removeListener(listener)
    assert listener.triggers >= 3 and any("events in one trigger" in a for a in listener.alerts)


def test_batch_is_repeatable_and_seeded(spark, raw_of):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    seed = spark.createDataFrame([(-1, "T9", "D9")], "seq bigint, ticket_id string, device_id string")
    bridge = Bridge(spark, f"{home}/t", f"{home}/s", seed=seed)
    batch = raw_of([
        ("channel", "Wearables:WatchDevices:D9:BioSensors", '{"Steps":1}'), ("key", "Nothing:here", "1"),
        ("key", "Visitors:T9:Status", "Inactive"), ("channel", "Wearables:WatchDevices:D9:BioSensors", '{"Steps":2}'),
    ])
    for _ in range(2):
        bridge.process(batch, 0)
    rows = {r["steps"]: r["ticket_id"] for r in read_output(bridge, EMPATICA).collect()}
    assert rows == {1: "T9", 2: None} and read_output(bridge, EMPATICA).count() == 2
    assert bridge.stats[0] == {
        "batch_id": 0, "received": 4, "unrouted": 1, "skipped": 0, "empatica": 2, "blueiot": 0, "global_state_events": 1, "unchanged": 0,
    }
    assert read_stats(bridge).count() == 1


def test_bad_payloads_pass_and_are_counted(spark, raw_of):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    bridge = Bridge(spark, f"{home}/t", f"{home}/s")
    values = ['{"a":1,"a":2}', '{"a":2}', '{"a":"2"}', "{bad", "[1, 2]", "[1,2]", None]
    bridge.process(raw_of([("key", "IO:x", v) for v in values] + [("channel", "Wearables:WatchDevices::BioSensors", "{}")]), 0)
    got = [r["state_value"] for r in read_output(bridge, STATE).orderBy("event_timestamp").collect()]
    assert len(got) == 5 and bridge.stats[0]["unchanged"] == 2 and bridge.stats[0]["skipped"] == 1


def test_compaction_keeps_the_rows(spark, raw_of):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    bridge = Bridge(spark, f"{home}/t", f"{home}/s")
    for number in range(4):
        bridge.process(raw_of([("key", "IO:x", str(number)), ("key", "IO:y", str(number))]), number)
    before = bag(read_output(bridge, STATE).collect(), ["state_key", "state_value"])
    merged = compact_output(bridge, STATE, 3)
    assert bag(merged.collect(), ["state_key", "state_value"]) == before
    assert {r["batch_id"] for r in merged.select("batch_id").distinct().collect()} == {2, 3}


def test_batches_run_again_after_compaction(spark, raw_of):
    """Rows are neither lost nor doubled by any batch that runs again, before, between and after merges."""
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    bridge = Bridge(spark, f"{home}/t", f"{home}/s")
    names = ["state_key", "state_value"]
    batches = [raw_of([("key", "IO:x", str(n)), ("key", f"IO:y{n}", "1"), ("channel", "Wearables:WatchDevices:D:BioSensors", "{}")]) for n in range(5)]
    for number, batch in enumerate(batches):
        bridge.process(batch, number)
    rows = bag(read_output(bridge, STATE).collect(), names)
    assert len(rows) == 10
    compact_output(bridge, STATE, 2)
    for number in (1, 0, 2):
        bridge.process(batches[number], number)
        assert bag(read_output(bridge, STATE).collect(), names) == rows
    assert bag(compact_output(bridge, STATE, 4).collect(), names) == rows
    assert bag(compact_output(bridge, STATE, 3).collect(), names) == rows  # an earlier merge has nothing left to do
    for number in (3, 0, 4):
        bridge.process(batches[number], number)
        assert bag(read_output(bridge, STATE).collect(), names) == rows
    assert read_output(bridge, EMPATICA).count() == 5  # a table that is not merged replaces its own rows
    kept = {p.rsplit("=", 1)[1] for p in glob.glob(f"{home}/t/target_table={STATE}/event_date=*/batch_id=*")}
    assert kept == {"-4", "4"}


def test_a_merge_cut_short_leaves_the_rows(spark, raw_of, monkeypatch):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    live = Bridge(spark, f"{home}/t", f"{home}/s")
    for number in range(3):
        live.process(raw_of([("key", "IO:x", str(number))]), number)
    for step in ("put_text", "remove_path"):  # before the mark is set, and before the old files go
        with monkeypatch.context() as m:
            m.setattr(bridge_module, step, lambda *a: (_ for _ in ()).throw(OSError("cut")))
            with pytest.raises(OSError):
                compact_output(live, STATE, 2)
        assert sorted(r["state_value"] for r in read_output(live, STATE).collect()) == ["0", "1", "2"]
    assert live.merged_below(STATE) == 2


def test_seeds_stand_for_the_earlier_feed(spark, raw_of):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    before = routing.route(raw_of([("key", "IO:x", "1"), ("key", "IO:x", "2"), ("key", "Rooms:a", '{"b": 1}')]))
    bridge = Bridge(spark, f"{home}/t", f"{home}/s", seed_hashes=last_hashes(before))
    bridge.process(raw_of([("key", "IO:x", "2"), ("key", "IO:z", "1")]), 0)
    bridge.process(raw_of([("key", "Rooms:a", '{"b":1}'), ("key", "IO:x", "1")]), 1)
    assert sorted((r["state_key"], r["state_value"]) for r in read_output(bridge, STATE).collect()) == [("IO:x", "1"), ("IO:z", "1")]
    assert [s["unchanged"] for s in bridge.stats] == [1, 1]


@pytest.mark.parametrize("slice_rows", [1, 4, 50])
def test_sessions_of_hot_devices(spark, slice_rows):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"d{rng.randrange(4)}", rng.choice([5 * i, 5 * i + rng.randrange(40)]), rng.choice([None, 1.0, 2.5])) for i in range(400)]
    rows += [(None, 100, 1.0), (None, 103, 2.0), ("hot", 700, 1.0), ("hot", 700, 3.0)]
    events = spark.createDataFrame(rows, "device_id string, at int, hr double").withColumn("event_timestamp", F.timestamp_seconds(F.col("at") + 1704067200))
    columns = ["session_start", "session_end", "device_id", "hr", "source_rows"]
    plain, sliced = (F.round("hr", 6), F.round("hr", 6))
    want = assemble_sessions(events, "hr", "7 seconds", slice_rows=0).withColumn("hr", plain)
    got = assemble_sessions(events, "hr", "7 seconds", slice_rows=slice_rows).withColumn("hr", sliced)
    assert want.count() > 40 and bag(got.collect(), columns) == bag(want.collect(), columns)


def test_windows_and_late_rows_hold_the_whole_input(spark):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    parts = [[1000, 1001, 1007], [5000, 3000, 4989, 4990], [4984, 4985, 4986, 990, 6000], [4999, 5985, 5989, 5990, 7000]]
    schema = "event_timestamp timestamp, device_id string"
    for seconds in parts:
        spark.createDataFrame([(s,) for s in seconds], "s int").select(F.timestamp_seconds("s").alias("event_timestamp"), F.lit("d").alias("device_id")).coalesce(1).write.mode("append").parquet(f"{home}/in")
    split = LateSplit(spark, f"{home}/split", "5 seconds", 10)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    split.start(events, f"{home}/c1").awaitTermination()
    second = lambda df: sorted(int(r[0].replace(tzinfo=datetime.timezone.utc).timestamp()) for r in df.select("event_timestamp").collect())
    # a window is closed when it ends at or before the newest earlier event less ten seconds
    newest, late = None, []
    for seconds in parts:
        late += [s for s in seconds if newest is not None and s // 5 * 5 + 5 <= newest - 10]
        newest = max([*seconds, *([newest] if newest is not None else [])])
    assert second(split.late(events.schema)) == sorted(late) and late
    out = run_available(assemble_stream(split.in_time(events.schema), {}, lateness="10 seconds"), f"{home}/out", f"{home}/c2")
    windows = sum(r["source_rows"] for r in out.collect())
    open_rows = sum(s // 5 * 5 + 5 > newest - 10 for seconds in parts for s in seconds)
    assert windows + len(late) + open_rows == sum(map(len, parts))
    # a batch of the split that runs again parts its rows as before
    split.process(spark.createDataFrame([(s,) for s in parts[2]], "s int").select(F.timestamp_seconds("s").alias("event_timestamp"), F.lit("d").alias("device_id")), 2)
    assert second(split.late(events.schema)) == sorted(late)


def test_late_rows_are_reported(spark, raw_of):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    schema = "event_timestamp timestamp, device_id string, hr double"
    for second in (1000, 5000, 10, 6000):  # the third file comes long after its windows have closed
        spark.range(3).select(F.timestamp_seconds(F.lit(second)).alias("event_timestamp"), F.lit("d").alias("device_id"), F.lit(1.0).alias("hr")).coalesce(1).write.mode("append").parquet(f"{home}/in")
    listener = HealthListener()
    spark.streams.addListener(listener)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    run_available(assemble_sessions(stream, "hr", "5 seconds", "10 seconds"), f"{home}/out", f"{home}/checkpoint")
    for _ in range(50):
        if listener.late_rows:
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert listener.late_rows and any("behind the watermark" in a for a in listener.alerts)


def test_dry_run_writes_no_tables(spark, raw_of):
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    bridge = Bridge(spark, f"{home}/t", f"{home}/s", dry_run=True)
    bridge.process(raw_of([("key", "Visitors:T9:Status", "Active")]), 0)
    assert bridge.stats[0]["received"] == 1 and not os.path.exists(f"{home}/t")


def test_change_state_survives_a_restart(spark, split_feed):
    raw, path, home = split_feed
    for _ in range(2):
        stream = feeds.stream_raw(spark, path, max_files=1)
        start_changes(stream, f"{home}/changes", f"{home}/changes-state", f"{home}/changes-checkpoint").awaitTermination()
    out = spark.read.schema(raw.schema).parquet(f"{home}/changes")
    wanted = changes.suppress_unchanged(raw)
    assert bag(out.collect(), raw.columns) == bag(wanted.collect(), raw.columns)
