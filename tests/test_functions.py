"""Scalar functions: globs, decoding, texts, checks."""

import fnmatch
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.functions import biometrics, decode, patterns, text

KEYS = ["Rooms:1:A", "Rooms:2:B", "Visitors:T1:Status", "a]b", "a-b", "a[b", "x\ny", "Other:Random:Key", "RandomKey", ""]


def evaluate(spark, column, *values, type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("glob", [
    "Rooms:*", "*:Status", "?ooms:*", "Rooms:[12]:*", "Rooms:[!1]:*", "a[]]b", "a[!-]b", "a[[]b", "a[b", "*",
    "x?y", "Wearables:*:*:*", "RandomKey",
])
def test_glob_match_is_fnmatch(spark, glob):
    got = evaluate(spark, patterns.glob_match(F.col("v"), glob), *KEYS)
    assert got == [fnmatch.fnmatchcase(k, glob) for k in KEYS]


@settings(max_examples=200, deadline=None)
@given(st.text("ab:[]!-*?^&\\", max_size=8), st.text("ab:[]!-^&\\", max_size=6))
def test_glob_regex_agrees_with_fnmatch(glob, key):
    made = patterns.glob_to_regex(glob).replace(r"\z", r"\Z")
    try:
        regex = re.compile(made)
    except re.error:  # a reversed range such as [b-a], which fnmatch treats in its own way
        return
    assert bool(regex.match(key)) == fnmatch.fnmatchcase(key, glob) or "-" in glob


def test_allow_list_takes_brackets_literally(spark):
    allowed = ["Colors[0]:*", "Exact[1]", "a?c"]
    values = ["Colors[0]:Color", "Colors0:Color", "Exact[1]", "Exact1", "abc", "abbc"]
    got = evaluate(spark, patterns.allow_list_match(F.col("v"), allowed), *values)
    assert got == [True, False, True, False, True, False]


def test_text_parts(spark):
    assert evaluate(spark, patterns.preview(F.col("v"), 3), "abc", "abcd") == ["abc", "abc..."]
    assert evaluate(spark, patterns.segment(F.col("v"), 1), "a:b:c", "a") == ["b", None]
    assert evaluate(spark, patterns.last_segment(F.col("v")), "a:b:c", "a") == ["c", "a"]


def test_canonical_text(spark):
    values = ['{"b":1,"a":[1, 2],"t":"x, y:z"}', "[1,2]", "true", "12.50", '"quoted"', "null", "{bad", "plain", None]
    got = evaluate(spark, text.canonical_text(F.col("v"), F.lit(True)), *values)
    assert got == ['{"b": 1, "a": [1, 2], "t": "x, y:z"}', "[1, 2]", "true", "12.50", "quoted", None, "{bad", "plain", None]
    assert evaluate(spark, text.canonical_text(F.col("v"), F.lit(False)), values[0]) == [values[0]]


def test_hash_tells_values_apart_and_never_fails(spark):
    same = [('{"a":1,"b":2}', '{"b":2, "a":1}'), ("[1,2]", "[1, 2]"), ('{"a":1,"a":2}', '{"a":2}'), ('{"a": "x, y", "b":1, "a" : "z"}', '{"a":"z","b":1}')]
    other = [('{"a":1}', '{"a":"1"}'), ('{"a":2,"b":1}', '{"a":1,"b":2}'), ("[1,2]", "[2,1]"), ("{bad", "{worse"), ("x", None), ('{"a":{"b":1},"c":{"b":2}}', '{"a":{"b":3},"c":{"b":2}}')]
    got = evaluate(spark, text.hash_text(F.col("v")), *[v for pair in same + other for v in pair])
    assert all(got[2 * i] == got[2 * i + 1] for i in range(len(same)))
    assert all(got[2 * i] != got[2 * i + 1] for i in range(len(same), len(same + other)))
    assert None not in got
    plain = evaluate(spark, text.hash_text(F.col("v"), F.lit(False)), "[1,2]", "[1, 2]")
    assert plain[0] != plain[1]


def test_parse_time_with_zone_names(spark):
    values = ["2025-01-09T10:30:00[Mars/Base]", "2025-01-09T10:30:00+02:00[America/New_York]", "2025-01-09T10:30:00Z[Europe/Paris]"]
    got = evaluate(spark, F.date_format(text.parse_time(F.col("v")), "yyyy-MM-dd HH:mm"), *values)
    assert got == [None, "2025-01-09 15:30", "2025-01-09 09:30"]


def test_coerce(spark):
    values = ["7", "7.9", "-7.9", "x", "", None, "9007199254740993"]
    assert evaluate(spark, text.coerce(F.col("v"), "bigint"), *values) == [7, 7, -7, None, None, None, 9007199254740993]
    assert evaluate(spark, text.coerce(F.col("v"), "boolean"), "true", "YES", "on", "1", "0", "off", None) == [
        True, True, True, True, False, False, None
    ]


def test_parse_time(spark):
    values = [
        "2025-01-09T10:30:00Z", "2025-01-09T10:30:00+02:00", "2025-01-09T10:30:00[America/New_York]",
        "2025-01-09 10:30:00", "2025-01-09", "2025-07-09T00:00:00", "nonsense",
    ]
    got = evaluate(spark, F.date_format(text.parse_time(F.col("v")), "yyyy-MM-dd HH:mm"), *values)
    assert got == [
        "2025-01-09 10:30", "2025-01-09 08:30", "2025-01-09 15:30", "2025-01-09 18:30", "2025-01-09 08:00",
        "2025-07-09 07:00", None,
    ]


def test_decode_bytes_tiers(spark):
    values = [b"plain", b'\xff{"a":1}', b"\xe9t\xe9", b"7", b""]
    assert evaluate(spark, decode.decode_bytes(F.col("v")), *values, type="binary") == [
        "plain", '{"a":1}', "été", "7", ""
    ]


def test_decoder_slot_comes_first(spark):
    def structured(data):
        return F.when(F.hex(data) == "01", F.lit("one"))

    assert evaluate(spark, decode.decode_bytes(F.col("v"), structured), b"\x01", b"x", type="binary") == ["one", "x"]


def test_decode_hash_and_pick(spark):
    df = spark.createDataFrame([({b"k": b"\xe9"},)], "h map<binary,binary>")
    assert df.select(decode.decode_hash(F.col("h"))).first()[0] == {"k": "é"}
    df = spark.createDataFrame([("s", {"a": "1"}), (None, {"a": "1"}), (None, {}), (None, None)], "s string, h map<string,string>")
    assert [r[0] for r in df.select(decode.pick_value(F.col("s"), F.col("h"))).collect()] == ["s", '{"a":"1"}', None, None]


def test_notifications(spark):
    df = spark.createDataFrame(
        [(1, "invalidate", [b"a", b"\xff", b"", b"b"]), (2, "invalidate", None), (3, "other", [b"c"])],
        "n int, command string, keys array<binary>",
    )
    assert sorted((r["n"], r["key"]) for r in decode.invalidated_keys(df).collect()) == [(1, "a"), (1, "b")]
    df = spark.createDataFrame(
        [("__keyspace@0__:*", "__keyspace@0__:A:B", "set"), ("__keyevent@0__:*", "__keyevent@0__:del", "A:B"), ("x", "y", "z")],
        "pattern string, channel string, data string",
    )
    got = [(r["kind"], r["key"], r["operation"]) for r in decode.parse_notification(df).collect()]
    assert got == [("keyspace", "A:B", "set"), ("keyevent", "A:B", "del")]


def test_biometric_bounds(spark):
    assert evaluate(spark, biometrics.heart_rate(F.col("v")), "29.9", "30", "220", "221", "x") == [None, 30.0, 220.0, None, None]
    assert evaluate(spark, biometrics.heart_rate_flag(F.col("v")), "35", "100", "210", "10") == ["low", "ok", "high", None]
    assert evaluate(spark, biometrics.skin_temperature(F.col("v"), "F"), "98.6", "10") == [pytest.approx(37.0), None]
    assert evaluate(spark, biometrics.skin_conductivity(F.col("v")), "-1", "0", "100") == [None, 0.0, 100.0]
    assert evaluate(spark, biometrics.accelerometer(F.col("v")), "-20", "20.1") == [-20.0, None]
