"""Device assignment, enrichment and change detection against a replay with two dicts."""

import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import assignment, changes, projection, routing
from footfall.rules import EMPATICA


def replay(events):
    """What a process that handles one event after the other would look up."""
    ticket_of, device_of, seen = {}, {}, {}
    for seq, (_, key, value, *_) in enumerate(events):
        parts = key.split(":")
        if key.endswith(":EmpaticaDeviceID"):
            ticket, device = parts[1].strip(), (value or "").strip()
            if device:
                if ticket_of.get(device, ticket) != ticket:
                    device_of.pop(ticket_of[device], None)
                if device_of.get(ticket, device) != device:
                    ticket_of.pop(device_of[ticket], None)
                ticket_of[device], device_of[ticket] = ticket, device
            elif ticket in device_of:
                ticket_of.pop(device_of.pop(ticket), None)
        elif key.endswith(":Status") and (value or "").strip() == "Inactive":
            if parts[1] in device_of:
                ticket_of.pop(device_of.pop(parts[1]), None)
        elif key.endswith(":BioSensors"):
            seen[seq] = ticket_of.get(parts[2])
    return seen, ticket_of


def random_feed(n, hot, seed):
    rng = random.Random(seed)
    events = []
    for _ in range(n):
        device = "D0" if rng.random() < hot else f"D{rng.randrange(12)}"
        ticket = f"T{rng.randrange(14)}"
        kind = rng.random()
        if kind < 0.25:
            value = rng.choice([device] * 8 + ["", None])
            events.append(("key", f"Visitors:{ticket}:EmpaticaDeviceID", value))
        elif kind < 0.4:
            events.append(("key", f"Visitors:{ticket}:Status", rng.choice(["Inactive", "Active", " Inactive "])))
        else:
            events.append(("channel", f"Wearables:WatchDevices:{device}:BioSensors", '{"Steps":1}'))
    return events


@pytest.fixture(scope="module", params=[0.0, 0.6])
def case(request, raw_of):
    events = random_feed(1500, request.param, 11)
    return raw_of(events).persist(), *replay(events)


@pytest.mark.parametrize("slice_rows", [0, 40, None])
def test_enrichment_equals_replay(case, slice_rows):
    raw, seen, _ = case
    intervals = assignment.assignment_intervals(assignment.assignment_log(raw), slice_rows)
    sensor = projection.sensor_rows(routing.route(raw), EMPATICA)
    got = assignment.ticket_at(sensor, intervals, slice_rows).collect()
    assert {r["seq"]: r["ticket_id"] for r in got} == seen


def test_open_assignments_equal_replay(case):
    raw, _, ticket_of = case
    intervals = assignment.assignment_intervals(assignment.assignment_log(raw))
    got = {r["device_id"]: r["ticket_id"] for r in assignment.open_assignments(intervals).collect()}
    assert got == ticket_of


def test_reverse_lookup(raw_of):
    raw = raw_of([
        ("key", "Visitors:T1:EmpaticaDeviceID", "D1"), ("key", "Visitors:T1:Status", "Active"),
        ("key", "Visitors:T2:EmpaticaDeviceID", "D1"), ("key", "Visitors:T1:Status", "Active"),
    ])
    intervals = assignment.assignment_intervals(assignment.assignment_log(raw))
    asked = raw.where("seq in (1, 3)").select("seq", F.lit("T1").alias("ticket_id"))
    got = {r["seq"]: r["device_id"] for r in assignment.device_at(asked, intervals).collect()}
    assert got == {1: "D1", 3: None}


def test_channel_assignment_messages_do_not_assign(raw_of):
    raw = raw_of([("channel", "Visitors:T1:AssignDevice", "D1"), ("key", "Visitors:T1:EmpaticaDeviceIDShort", "1")])
    assert assignment.assignment_log(raw).count() == 0


def test_deletes_release_on_request(raw_of):
    raw = raw_of([("key", "Visitors:T1:EmpaticaDeviceID", "D1")] * 2).withColumn(
        "op", F.when(F.col("seq") == 1, "del")
    )
    assert assignment.open_assignments(assignment.assignment_intervals(assignment.assignment_log(raw))).count() == 1
    log = assignment.assignment_log(raw, deletes_release=True)
    assert assignment.open_assignments(assignment.assignment_intervals(log)).count() == 0


def test_snapshot_seeds(raw_of):
    raw = raw_of([
        ("key", "Visitors:T1:EmpaticaDeviceID", "D1"), ("key", "Visitors:T2:EmpaticaDeviceID", " D2 "),
        ("key", "Visitors:T1:EmpaticaDeviceID", "D3"), ("key", "Visitors:T3:EmpaticaDeviceID", ""),
        ("key", "Visitors:T4:EmpaticaDeviceID", "D3"), ("key", "Visitors:T4:Status", "x"),
    ])
    seeds = assignment.snapshot_log(raw)
    assert seeds.agg(F.max("seq")).first()[0] == -1 and seeds.select("seq").distinct().count() == seeds.count()
    got = assignment.open_assignments(assignment.assignment_intervals(seeds))
    assert {(r["device_id"], r["ticket_id"]) for r in got.collect()} == {("D2", "T2"), ("D3", "T4")}


@pytest.mark.parametrize("slice_rows", [0, 10])
def test_changes_are_not_distinct_values(raw_of, slice_rows):
    values = ["A", "A", "B", "A", "A", None, None, "", "1"]
    raw = raw_of([("key", "Rooms:x", v) for v in values] + [("channel", "c", "A"), ("channel", "c", "A")])
    kept = changes.suppress_unchanged(raw, slice_rows)
    assert sorted(r["seq"] for r in kept.collect()) == [0, 2, 3, 5, 7, 8, 9, 10]


def test_changes_compare_objects_by_member(raw_of):
    raw = raw_of([("key", "Rooms:x", v) for v in ('{"a":1,"b":2}', '{"b":2,"a":1}', '{"a":1,"b":3}')])
    assert sorted(r["seq"] for r in changes.changed_keys(raw).collect()) == [0, 2]


def test_changes_on_a_hot_key_equal_a_loop(raw_of):
    rng = random.Random(3)
    events = [("key", "Rooms:hot" if rng.random() < 0.5 else f"Rooms:{rng.randrange(5)}", str(rng.randrange(2)))
              for _ in range(900)]
    last, expected = {}, []
    for seq, (_, key, value) in enumerate(events):
        if last.get(key) != value:
            expected.append(seq)
        last[key] = value
    got = changes.changed_keys(raw_of(events), slice_rows=50)
    assert sorted(r["seq"] for r in got.collect()) == expected
