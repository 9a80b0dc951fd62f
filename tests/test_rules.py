"""Rules, schemas and their validation."""

import pytest
from pyspark.sql import types as T

from footfall import rules
from footfall.functions.patterns import specificity
from footfall.operators import routing

GOOD = {"name": "x", "source_type": "key", "pattern": "A:*", "target_table": "global_state_events"}


def test_table_schema_follows_declaration():
    schema = rules.table_schema("empatica")
    assert [f.name for f in schema.fields][:4] == ["event_timestamp", "ticket_id", "device_id", "heart_rate"]
    assert schema["steps"].dataType == T.LongType()
    assert not schema["device_id"].nullable and schema["ticket_id"].nullable
    with pytest.raises(rules.ConfigError):
        rules.table_schema("other")


def test_nested_repeated_and_unknown_types():
    columns = (
        rules.Column("r", "RECORD", fields=(rules.Column("a", "INT64"), rules.Column("b", "GEOGRAPHY"))),
        rules.Column("l", "FLOAT64", repeated=True),
        rules.Column("d", "DATETIME"),
    )
    made = rules.struct_of(columns)
    assert made["r"].dataType["b"].dataType == T.StringType()
    assert made["l"].dataType == T.ArrayType(T.DoubleType())
    assert made["d"].dataType == T.TimestampNTZType()


def test_check_rules():
    assert rules.check_rule(GOOD).value_is_object is False
    for bad in (
        {k: v for k, v in GOOD.items() if k != "pattern"},
        {**GOOD, "source_type": "list"},
        {**GOOD, "target_table": "visitor_events"},
        {**GOOD, "target_table": "empatica"},
        {**GOOD, "id_regex": "([a-z"},
    ):
        with pytest.raises(rules.ConfigError):
            rules.check_rule(bad)
    with pytest.raises(rules.ConfigError, match="rule 1"):
        rules.check_rules([GOOD, {}])


def test_check_table():
    raw = {
        "partition_field": "t", "partition_type": "DAY", "clustering": ["a"],
        "columns": [{"name": "t", "type": "TIMESTAMP", "mode": "REQUIRED"}, {"name": "a", "type": "STRING"}],
    }
    table = rules.check_table("x", raw)
    assert table.columns[0].required and not table.columns[1].required and table.field_mappings == {}
    with pytest.raises(rules.ConfigError):
        rules.check_table("x", {"columns": []})


def test_specificity_order():
    patterns = ["*", "?x:*", "A:*", "A:B:*", "A:B:C", "A:B", "*:Z", "*:ZZ"]
    ordered = sorted(patterns, key=specificity)
    assert ordered == ["A:B:C", "A:B", "A:B:*", "?x:*", "A:*", "*:ZZ", "*:Z", "*"]


def test_catch_all_is_tried_last(raw_of):
    made = [
        rules.Rule("all", "key", "*", "global_state_events"),
        rules.Rule("bio", "channel", "Wearables:WatchDevices:*:BioSensors", "empatica", "x"),
        rules.Rule("pos", "key", "Wearables:WatchDevices:*:Position", "global_state_events"),
    ]
    raw = raw_of([
        ("key", "Wearables:WatchDevices:EMB001:Position", "1"),
        ("key", "Rooms:MainHall:Audio:MasterVolume", "1"),
        ("channel", "Installation:State:Active", "1"),
    ])
    got = {r["seq"]: r["rule"] for r in routing.route(raw, made, keep_unmatched=True).collect()}
    assert got == {0: "pos", 1: "all", 2: None}
    assert routing.route(raw, made).count() == 2
    assert sorted(r["rule"] for r in routing.rule_matches(raw, made).where("seq = 0").collect()) == ["all", "pos"]


def test_prefixes_and_patterns(spark):
    made = [rules.Rule("a", "key", p, "global_state_events") for p in
            ("Visitors:*:Status", "Wearables:Scent:*", "IO:*", "Plain", "Pre*", "*", "Visitors:*")]
    frame = rules.rules_frame(spark, made)
    assert [r[0] for r in routing.prefixes(frame).collect()] == [
        "IO:", "Plain", "Pre", "Visitors:", "Wearables:Scent:"
    ]
    assert routing.patterns_of(frame, "channel").count() == 0
    assert routing.patterns_of(frame, "key").count() == 7
