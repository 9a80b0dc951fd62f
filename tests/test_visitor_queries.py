"""The query library: parameters, order, sliced plans, pushed filters."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import bag
from footfall.operators import visitor_queries as vq
from footfall.plans.views import visits
from footfall.sources.events_view import events

SF = "/root/testdata/sf0.001"
DEVICE = "E3000003"


@pytest.fixture(scope="module")
def ve(spark):
    return visits(spark, SF).persist()


def test_one_device_is_the_filtered_whole(ve):
    for run in (vq.device_events, vq.biometric_summary, vq.visitor_summary, vq.movement, vq.zone_visits,
                vq.activity_level, vq.health_alerts, vq.zone_path, vq.hourly_summary, vq.distance_travelled,
                vq.zone_history):
        one, all_of_them = run(ve, device_id=DEVICE), run(ve).where(F.col("device_id") == DEVICE)
        assert one.count() > 0
        assert bag(one.collect(), one.columns) == bag(all_of_them.collect(), one.columns), run.__name__


def test_sliced_plans_give_the_same(ve):
    for run in (vq.movement, vq.zone_path, vq.zone_history):
        plain, sliced = run(ve, slice_rows=0), run(ve, slice_rows=9)
        assert bag(plain.collect(), plain.columns) == bag(sliced.collect(), plain.columns), run.__name__
    plain, sliced = (vq.distance_travelled(ve, slice_rows=n).drop("total_distance_traveled") for n in (0, 9))
    assert bag(plain.collect(), plain.columns) == bag(sliced.collect(), plain.columns)


def test_order(ve):
    times = [r[0] for r in vq.device_events(ve, DEVICE).select("event_timestamp").collect()]
    assert times == sorted(times, reverse=True)
    rows = [(r["device_id"], r["event_timestamp"]) for r in vq.events_of_devices(ve, [DEVICE, "E3000001"]).collect()]
    assert rows == sorted(rows, key=lambda r: (r[0], -r[1].timestamp())) and len({d for d, _ in rows}) == 2
    counts = [r["visit_count"] for r in vq.zone_visits(ve).collect()]
    assert counts == sorted(counts, reverse=True)
    hours = [(r["event_date"], r["hour"]) for r in vq.hourly_summary(ve, DEVICE).collect()]
    assert hours == sorted(hours, reverse=True)


def test_latest_n(ve):
    newest = [r["event_timestamp"] for r in vq.latest_n(ve, 5, DEVICE).collect()]
    assert newest == [r["event_timestamp"] for r in vq.device_events(ve, DEVICE).limit(5).collect()]
    per_device = vq.latest_n(ve, 3).groupBy("device_id").count()
    assert per_device.agg(F.max("count")).first()[0] == 3
    plan = vq.latest_n(ve, 5, DEVICE)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_recent_takes_literal_moments(ve):
    as_of = datetime.datetime(2024, 1, 10, tzinfo=datetime.timezone.utc)
    got = vq.recent_events(ve, as_of, hours=24)
    assert got.count() == ve.where("event_timestamp >= timestamp'2024-01-09 00:00:00'").count() > 0
    assert vq.recent_events(ve, as_of, hours=24, device_id=DEVICE).where(F.col("device_id") != DEVICE).count() == 0


def test_latest_status_keeps_ties(spark):
    row = "timestamp'2024-01-01 10:00:00'"
    df = spark.sql(f"""
      SELECT device_id, ticket_id, t AS event_timestamp, 'z' AS zone, 1d AS heart_rate, 1d AS skin_temperature,
        1d AS position_x, 1d AS position_y
      FROM VALUES ('a', 'T1', {row}), ('a', 'T2', {row}), ('b', 'T3', timestamp'2024-01-01 08:00:00')
        AS v(device_id, ticket_id, t)""")
    got = vq.latest_status(df, datetime.datetime(2024, 1, 1, 10, 30), hours=1)
    assert sorted(r["ticket_id"] for r in got.collect()) == ["T1", "T2"]
    assert vq.latest_events(df).count() == 3


def test_zone_and_alert_parameters(ve):
    last = ve.agg(F.max("event_timestamp")).first()[0]
    in_zone = vq.visitors_in_zone(ve, last, zone="Zone_1", minutes=60 * 24 * 40)
    assert {r["zone"] for r in in_zone.collect()} == {"Zone_1"}
    assert vq.health_alerts(ve, high_rate=1000, low_rate=0, high_temperature=1000, low_temperature=0).count() == 0


def test_time_filters_reach_the_scan(spark):
    raw = events(spark, SF).where("ts >= timestamp'2024-01-05 00:00:00'").select("event_id", "ts")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "props" not in plan
    one = vq.events_between(visits(spark, "/root/testdata/sf0.01"), "2024-01-05", "2024-01-06")
    assert "GreaterThanOrEqual(ts" in one._jdf.queryExecution().executedPlan().toString()
