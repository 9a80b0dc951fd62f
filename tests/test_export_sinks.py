"""Extracts, sinks and profiles."""

import datetime
import glob
import gzip
import json
import math
import os
import random
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import bag
from footfall.operators import export as ex
from footfall.operators import ordered, profile
from footfall.plans.views import tables, visits
from footfall.rules import EMPATICA, STATE
from footfall.session import remove_path, shared_dir, work_path
from footfall.sinks import writers
from footfall.sources import feeds

SF = "/root/testdata/sf0.001"
DAY = datetime.datetime


@pytest.fixture(scope="module")
def made(spark):
    return {t: df.persist() for t, df in tables(spark, SF).items()}


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_specs_are_checked():
    with pytest.raises(ValueError):
        ex.RangeSpec(DAY(2024, 1, 2), DAY(2024, 1, 2))
    with pytest.raises(ValueError):
        ex.RangeSpec(DAY(2024, 1, 1), DAY(2024, 1, 2), ("visitors",))
    with pytest.raises(ValueError):
        ex.TicketSpec("T1", DAY(2024, 1, 3), DAY(2024, 1, 2))
    assert ex.TicketSpec("T1").name == "ticket_T1"
    assert ex.RangeSpec(DAY(2024, 1, 1), DAY(2024, 1, 2)).name == "timerange_20240101_000000_to_20240102_000000"


def test_range_is_half_open_and_columns_follow_the_table(made):
    first, second = [r[0] for r in made[STATE].orderBy("event_timestamp").select("event_timestamp").limit(2).collect()]
    got = ex.time_range(made[STATE], STATE, first, second)
    assert got.count() == 1 and "ticket_id" not in got.columns
    assert "ticket_id" in ex.time_range(made[EMPATICA], EMPATICA, first, second).columns
    assert "ticket_id" not in ex.time_range(made[EMPATICA], EMPATICA, first, second, False).columns


def test_lifetime_of_one_ticket(made):
    span = ex.ticket_timeframes(made, "T7").first()
    every = [r[0] for t in made.values() for r in t.where("ticket_id = 'T7'").select("event_timestamp").collect()]
    assert (span["first_seen"], span["last_seen"]) == (min(every), max(every))
    assert ex.ticket_timeframes(made, "nobody").first() is None
    context = ex.state_context(made[STATE], min(every), max(every))
    assert context.where("ticket_id <> 'T7'").count() > 0
    assert context.agg(F.max("event_timestamp")).first()[0] < max(every), "the end is exclusive"
    closed = ex.state_context(made[STATE], min(every), max(every), inclusive_end=True)
    assert closed.count() - context.count() in (0, 1)
    narrowed = ex.state_context(made[STATE], min(every), max(every), start=every[len(every) // 2])
    assert narrowed.count() < context.count()


@pytest.mark.parametrize("slice_rows,bucket", [(0, 3600), (0, 86400), (5, 86400), (1, 700000)])
def test_range_join_equals_brute_force(made, slice_rows, bucket):
    spans = ex.ticket_timeframes(made)
    hits = ex.state_in_lifetimes(made[STATE], spans, bucket, slice_rows=slice_rows)
    got = {r["for_ticket"]: r["count"] for r in hits.groupBy("for_ticket").count().collect()}
    times = [r[0] for r in made[STATE].select("event_timestamp").collect()]
    expected = {s["ticket_id"]: sum(s["first_seen"] <= t < s["last_seen"] for t in times) for s in spans.collect()}
    assert got == {t: n for t, n in expected.items() if n}


@pytest.fixture(scope="module")
def crowded(spark):
    """State events of which a third come in one hour, and a tenth in one moment, with lifetimes across them."""
    at = F.when(F.col("id") % 3 == 0, F.col("id") % 3600 + 500_000).when(F.col("id") % 10 == 1, 123_456).otherwise(F.xxhash64("id") % 500_000 + 500_000)
    state = spark.range(6000).select(
        F.timestamp_seconds(1704067200 + at).alias("event_timestamp"), F.lit("key").alias("event_source_type"), F.format_string("T%d", F.col("id") % 40).alias("ticket_id"),
        F.concat(F.lit("k"), F.col("id")).alias("state_key"), F.lit("v").alias("state_value"), F.lit(None).cast("bigint").alias("ttl_seconds"),
    ).persist()
    span = lambda c: F.timestamp_seconds(1704067200 + F.xxhash64("id", F.lit(c)) % 700_000 + 400_000)
    lives = spark.range(60).select(F.concat(F.lit("L"), F.col("id")).alias("ticket_id"), F.least(span("a"), span("b")).alias("first_seen"), F.greatest(span("a"), span("b")).alias("last_seen"))
    edges = state.select(F.lit("all").alias("ticket_id"), F.min("event_timestamp").over(W.partitionBy()).alias("first_seen"), F.max("event_timestamp").over(W.partitionBy()).alias("last_seen")).limit(1)
    return state, lives.unionByName(edges).persist()


@pytest.mark.parametrize("slice_rows", [None, 0, 50, 7])
def test_crowded_hours_and_moments(crowded, slice_rows):
    state, lives = crowded
    times = sorted(r[0] for r in state.select("event_timestamp").collect())
    want = {}
    for s in lives.collect():
        if inside := [t for t in times if s["first_seen"] <= t < s["last_seen"]]:
            want[s["ticket_id"]] = (len(inside), inside[0], inside[-1])
    listed = ex.state_in_lifetimes(state, lives, slice_rows=slice_rows).groupBy("for_ticket").agg(
        F.count("*").alias("n"), F.countDistinct("state_key").alias("keys"), F.min("event_timestamp").alias("a"), F.max("event_timestamp").alias("b")
    )
    rows = {r["for_ticket"]: r for r in listed.collect()}
    assert {t: (r["n"], r["a"], r["b"]) for t, r in rows.items()} == want and all(r["n"] == r["keys"] for r in rows.values())
    counts = ex.lifetime_counts(state, lives, slice_rows=slice_rows).collect()
    assert {r["for_ticket"]: (r["context_events"], r["from_ts"], r["to_ts"]) for r in counts} == want


def test_slices_hold_equal_numbers_of_rows(crowded, monkeypatch):
    state, _ = crowded
    monkeypatch.setattr(ordered, "STEPS", 16)
    for slice_rows, most, usual in ((1000, 450, 450), (20, 450, 45)):
        number = ordered.even_slices(state, "event_timestamp", slice_rows)
        moments = state.groupBy("event_timestamp").count().withColumn("s", number("event_timestamp"))
        by_slice = moments.groupBy("s").agg(F.sum("count").alias("n"), F.max("count").alias("hot"), F.min("event_timestamp").alias("a"), F.max("event_timestamp").alias("b"))
        rows = by_slice.orderBy("s").collect()
        assert all(x["b"] < y["a"] for x, y in zip(rows, rows[1:]))
        sizes = sorted(r["n"] - r["hot"] for r in rows)  # the rows of one moment stay together
        assert sizes[-1] <= most and sizes[len(sizes) // 2] <= usual


def test_listing(made):
    listed = ex.list_tickets(made[STATE]).collect()
    assert [r["first_seen"] for r in listed] == sorted((r["first_seen"] for r in listed), reverse=True)
    assert ex.ticket_state_keys(made[STATE], 1, "T7").count() == 1
    assert ex.ticket_devices(made, "T7").where("ticket_id <> 'T7'").count() == 0


def test_shared_dir_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_clear_work_takes_what_was_written(spark):
    kept = work_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    assert os.path.isdir(kept) and spark.sparkContext.applicationId in kept
    remove_path(spark, kept)
    assert not os.path.exists(kept)


def test_parquet_codec_and_row_groups(spark, folder):
    writers.write_parquet(spark.range(0, 1000, 1, 1), f"{folder}/p", "zstd", 300)
    meta = pq.ParquetFile(glob.glob(f"{folder}/p/*.parquet")[0]).metadata
    assert meta.row_group(0).column(0).compression == "ZSTD" and meta.row_group(0).num_rows <= 300
    with pytest.raises(ValueError):
        writers.write_parquet(spark.range(1), f"{folder}/q", "lzma")


def test_jsonl_writes_nulls(spark, folder):
    writers.write_jsonl(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, timestamp'2024-01-01 00:00:00' AS t"), f"{folder}/j")
    line = open(glob.glob(f"{folder}/j/*.json")[0]).read().strip()
    assert json.loads(line) == {"a": 1, "b": None, "t": "2024-01-01T00:00:00.000Z"}


def test_replay_files_are_in_time_order(spark, made, folder):
    files = writers.export_range(made, ex.RangeSpec(DAY(2024, 1, 1), DAY(2024, 2, 1), format="replay"), folder)
    parts = sorted(glob.glob(f"{files['combined']}/*.parquet"))
    stamps = [t for p in parts for t in pq.read_table(p, columns=["timestamp"])["timestamp"].to_pylist()]
    assert stamps == sorted(stamps) and len(stamps) == sum(df.count() for df in made.values())
    assert len(feeds.replay_head(feeds.read_replay(spark, files["combined"]), 5).collect()) == 5
    assert glob.glob(f"{files['combined']}.schema/*.txt")


def test_ticket_export_and_metadata(spark, made, folder):
    files = writers.export_ticket(made, ex.TicketSpec("T7"), folder)
    assert set(files) <= set(made) and STATE in files
    meta = json.loads(open(glob.glob(f"{folder}/ticket_T7/metadata/*.json")[0]).read())
    assert meta["ticket_id"] == "T7" and meta["files"] == files and meta["time_range"] == {"start": None, "end": None}
    with pytest.raises(ValueError):
        writers.export_ticket(made, ex.TicketSpec("nobody"), folder)


def test_empty_tables_write_nothing(made, folder):
    assert writers.export_range(made, ex.RangeSpec(DAY(2030, 1, 1), DAY(2030, 1, 2)), folder) == {}
    with pytest.raises(ValueError):
        writers.write_tables({}, folder, "csv", "x")


def test_many_tickets_in_one_job(spark, made, folder):
    with open(f"{folder}/list.txt", "w") as f:
        f.write("# tickets\n\n T7 \nT8\n")
    writers.export_tickets(made, feeds.read_list(spark, f"{folder}/list.txt"), f"{folder}/out")
    assert sorted(os.path.basename(p) for p in glob.glob(f"{folder}/out/{STATE}/for_ticket=*")) == ["for_ticket=T7", "for_ticket=T8"]
    meta = {(r["table_name"], r["for_ticket"]): r["rows"] for r in spark.read.parquet(f"{folder}/out/metadata").collect()}
    for ticket in ("T7", "T8"):
        alone = writers.export_ticket(made, ex.TicketSpec(ticket), folder)
        for table, path in alone.items():
            rows = spark.read.parquet(f"{folder}/out/{table}/for_ticket={ticket}")
            assert rows.count() == spark.read.parquet(path).count() == meta[table, ticket]


def test_json_of_many_tickets_is_compressed_and_whole(spark, made, folder, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_TEXT_FILE", 50)
    writers.export_tickets(made, spark.createDataFrame([("T7",), ("T8",)], "entry string"), f"{folder}/out", "jsonl")
    writers.export_tickets(made, spark.createDataFrame([("T7",), ("T8",)], "entry string"), f"{folder}/plain")
    for table in made:
        files = glob.glob(f"{folder}/out/{table}/for_ticket=*/part-*")
        assert files and all(f.endswith(".json.gz") for f in files)
        texts = {f: gzip.open(f).read() for f in files}
        assert max(t.count(b"\n") for t in texts.values()) <= 50
        columns = [c for c, kind in made[table].dtypes if kind == "string"] + ["for_ticket"]
        want, got = spark.read.parquet(f"{folder}/plain/{table}"), spark.read.json(f"{folder}/out/{table}")
        columns = [c for c in columns if c in want.columns]
        assert bag(got.collect(), columns) == bag(want.collect(), columns)
        assert table != STATE or 3 * sum(map(os.path.getsize, files)) < sum(map(len, texts.values()))
    metas = [spark.read.parquet(f"{folder}/{n}/metadata").drop("format", "path", "earliest", "latest").collect() for n in ("out", "plain")]
    assert sorted(map(tuple, metas[0])) == sorted(map(tuple, metas[1])) != []


def test_bounds_with_a_zone(made):
    first, last = datetime.datetime(2024, 1, 5, 8, tzinfo=datetime.timezone.utc), DAY(2024, 1, 9)
    got = ex.state_context(made[STATE], DAY(2024, 1, 1), last, start=first)
    assert got.count() == made[STATE].where("event_timestamp >= '2024-01-05 08:00:00' and event_timestamp < '2024-01-09'").count()
    assert ex.state_context(made[STATE], "2024-01-05 08:00:00", "2024-01-09").count() == got.count()


def test_lifetime_counts_equal_brute_force(spark, made):
    spans = ex.ticket_timeframes(made)
    times = sorted(r[0] for r in made[STATE].select("event_timestamp").collect())
    want = {}
    for s in spans.collect():
        inside = [t for t in times if s["first_seen"] <= t < s["last_seen"]]
        if inside:
            want[s["ticket_id"]] = (len(inside), inside[0], inside[-1])
    for bucket in (60, 3600, 10_000_000):
        rows = ex.lifetime_counts(made[STATE], spans, bucket).collect()
        assert {r["for_ticket"]: (r["context_events"], r["from_ts"], r["to_ts"]) for r in rows} == want


def test_partitioned_table_prunes_and_repeats_safely(spark, made, folder):
    rows = made[STATE].drop("seq")
    for _ in range(2):
        writers.write_partitioned(rows, STATE, f"{folder}/t", batch_id=3)
    back = spark.read.parquet(f"{folder}/t")
    assert back.count() == rows.count()
    day = ex.in_range(back, "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert bag(day.collect(), ["state_key", "event_timestamp"]) == bag(
        ex.in_range(rows, "2024-01-05 00:00:00", "2024-01-06 00:00:00").collect(), ["state_key", "event_timestamp"])


def test_catalog_tables(spark, made, folder):
    spark.sql("DROP TABLE IF EXISTS state_check_table")
    path = f"{folder}/state"
    writers.write_partitioned(made[STATE].drop("seq"), STATE, path)
    assert writers.create_table(spark, STATE, path, "state_check_table") is True
    assert writers.create_table(spark, STATE, path, "state_check_table") is False
    spark.sql("MSCK REPAIR TABLE state_check_table")
    assert writers.verify_tables(spark, {STATE: "state_check_table", EMPATICA: "absent_table"}) == {STATE: True, EMPATICA: False}
    info = writers.table_info(spark, "state_check_table")
    assert info["rows"] == made[STATE].count() and info["partitioning"] == ["event_date"] and info["bytes"] > 0
    spark.sql("DROP TABLE state_check_table")


def test_look_ups_skip_row_groups(spark, folder):
    """A device that lies between a file's smallest and largest, and is not in it, costs no rows of that file."""
    devices = F.format_string("E3%06d", F.col("id") * 2 % 20_000)
    rows = spark.range(20_000).select(
        F.timestamp_seconds(F.col("id") + 1704067200).alias("event_timestamp"), F.format_string("T%d", F.col("id") % 7).alias("ticket_id"), devices.alias("device_id"),
    )
    from footfall.operators.projection import conform
    writers.write_partitioned(conform(rows, EMPATICA), EMPATICA, f"{folder}/t")
    for device, some in (("E3004000", True), ("E3004001", False)):
        found = spark.read.parquet(f"{folder}/t").where(F.col("device_id") == device)
        execution = found._jdf.queryExecution()
        assert len(execution.executedPlan().executeCollect()) == (2 if some else 0)
        leaf = execution.executedPlan().collectLeaves().head()
        assert (leaf.metrics().apply("numOutputRows").value() > 0) is some


def test_dry_run_counts(spark):
    assert writers.dry_run(spark.range(42)) == {"rows": 42}


def test_describe_is_exact(spark):
    df = visits(spark, SF)
    pdf = df.select("heart_rate", "position_x").toPandas().describe()
    for row in profile.describe(df, ["heart_rate", "position_x"]).collect():
        want = pdf[row["metric"]]
        got = [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(list(want)), row["metric"]


def test_describe_with_outliers(spark):
    values = [float(i % 97) / 7 - 5 for i in range(3000)] + [1e300, -1e250, float("inf"), float("-inf"), 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = profile.describe(df, ["x"]).first()
    want = sorted(values)
    at = [(len(want) - 1) * q for q in (0.25, 0.5, 0.75)]
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx([want[int(a)] + (want[int(a) + 1] - want[int(a)]) * (a % 1) for a in at])
    assert (row["min"], row["max"]) == (float("-inf"), float("inf"))


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    rows = {r["metric"]: r for r in profile.describe(df, ["x", "y"]).collect()}
    assert rows["y"]["count"] == 0 and rows["y"]["p50"] is None and rows["x"]["p50"] == 1.0


def test_describe_of_a_constant(spark):
    row = profile.describe(spark.range(10).select(F.lit(4.0).alias("x")), ["x"]).first()
    assert (row["p25"], row["p50"], row["p75"], row["std"]) == (4.0, 4.0, 4.0, 0.0)


def test_assembly_rules(spark):
    df = spark.sql("""
      SELECT 'd' AS device_id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,i) AS event_timestamp, v
      FROM VALUES (0, 1), (1, null), (2, 5), (4, null), (5, 9) AS t(i, v)""")
    for rule, first in (("average", 3.0), ("sum", 6), ("min", 1), ("max", 5), ("first", 1), ("last", 5)):
        got = profile.windowed_assembly(df, {"v": rule}).orderBy("window_start").collect()
        assert [r["v"] for r in got] == [first, 9], rule


def test_describe_of_close_values_counts_in_bounded_groups(spark, monkeypatch):
    """Values a few steps of a double apart, beside outliers and infinities, are told apart by counts alone."""
    monkeypatch.setattr(profile, "QUANTILE_BUCKETS", 8)
    rng = random.Random(8)
    close = [1.0 + k * 2.0**-52 for k in range(300)]
    cases = {
        "close": close, "wide": close + [1e300, -1e300, math.inf, -math.inf], "same": [0.0] * 50, "two": [-0.5, 7.0],
        "mixed": [rng.choice([rng.gauss(0, 1), 1e9 + rng.random(), -3.0]) for _ in range(400)], "ends": [-math.inf] * 5 + [math.inf] * 4,
    }
    for name, values in cases.items():
        rng.shuffle(values)
        row = profile.describe(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).first()
        ordered_ = sorted(values)
        for q, column in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            at = (len(values) - 1) * q
            low, high = ordered_[math.floor(at)], ordered_[math.ceil(at)]
            assert row[column] == (low if low == high else low + (high - low) * (at - math.floor(at))), (name, column)
        assert (row["min"], row["max"], row["count"]) == (ordered_[0], ordered_[-1], len(values))
