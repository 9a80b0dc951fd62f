"""Replay typing, commands, schedules, allow-lists and pseudonyms."""

import random
import re

import pytest
from pyspark.sql import functions as F

from footfall.functions import pseudonym
from footfall.functions.patterns import allow_glob_to_regex
from footfall.operators import replay

UUID = "0f1e2d3c-4b5a-4968-8776-655443322110"
AT = "atabcdef-0908172789abcdef01-89abcdef"


def state(spark, rows, columns="state_key string, state_value string, ttl_seconds bigint"):
    df = spark.createDataFrame(rows, columns)
    return df.withColumn("event_timestamp", F.timestamp_millis(F.lit(1704067200123)))


def test_value_types(spark):
    cases = [
        ("Visitors:N1:EmpaticaDeviceID", "908172", "string", "908172"),
        ("Visitors:N2:ScentDeviceID", "551", "string", "551"),
        ("Visitors:N3:BlueIoTDeviceID", "42.5", "string", "42.5"),
        ("Visitors:N4:Status", "100", "int", "100"),
        ("Visitors:N5:EmpaticaDeviceID", "E3Q7K55Z01", "string", "E3Q7K55Z01"),
        ("a", "42.5", "float", "42.5"),
        ("b", "1e3", "float", "1e3"),
        ("c", '{"x": 1}', "json", '{"x": 1}'),
        ("d", "[1, 2]", "json", "[1, 2]"),
        ("e", "true", "bool", "true"),
        ("f", '"text"', "string", "text"),
        ("g", "2024-01-01T10:00:00Z", "time", "2024-01-01T10:00:00+00:00"),
        ("h", "Tea: at 5: or Z", "string", "Tea: at 5: or Z"),
        ("i", "007", "int", "7"),
        ("j", "", "string", ""),
        ("k", None, "string", ""),
        ("l", "null", "null", ""),
        ("m", "{bad", "string", "{bad"),
    ]
    got = {r["key"]: (r["value_type"], r["text"]) for r in
           replay.to_replay(state(spark, [(k, v, None) for k, v, *_ in cases])).collect()}
    assert got == {k: (kind, text) for k, _, kind, text in cases}


def test_state_record_defaults(spark):
    row = replay.as_log(replay.to_replay(state(spark, [("Visitors:TICKET123:Status", "Active", 3600)]))).first()
    assert (row["timestamp"], row["type"], row["key"], bytes(row["value"]), row["ttl"]) == (
        1704067200123, "key", "Visitors:TICKET123:Status", b"Active", 3600
    )
    typed = state(spark, [("k", "v", None, "channel"), ("l", "v", None, None)],
                  "state_key string, state_value string, ttl_seconds bigint, event_source_type string")
    assert {r["key"]: r["type"] for r in replay.to_replay(typed).collect()} == {"k": "channel", "l": "key"}


def test_sensor_records(spark):
    at = F.timestamp_millis(F.lit(5))
    bio = spark.createDataFrame([("d", 75.9, 0.5, None)], "device_id string, heart_rate double, skin_conductivity double, steps bigint")
    row = replay.to_replay(bio.withColumn("event_timestamp", at)).first()
    assert (row["key"], row["text"]) == ("Wearables:WatchDevices:d:BioSensors", '{"Heart_Rate_Value":75,"Skin_Conductivity_Value":0.5}')
    pos = spark.createDataFrame([("d", None, 2.5, None)], "device_id string, position_x double, position_y double, room bigint")
    row = replay.to_replay(pos.withColumn("event_timestamp", at)).first()
    assert (row["type"], row["text"]) == ("channel", '{"BlueIoT_Position":[0.0,2.5]}')
    with pytest.raises(ValueError):
        replay.to_replay(spark.range(1))


def log_of(spark, rows):
    return spark.createDataFrame(rows, "timestamp bigint, type string, key string, text string, ttl bigint")


def test_commands(spark):
    log = log_of(spark, [(1, "channel", "c", "v", None), (2, "key", "k", "v", 10), (3, "key", "k", "v", -1), (4, "key", "k", "v", None)])
    got = [r[0] for r in log.orderBy("timestamp").select(replay.command(F.col("text"))).collect()]
    assert got == ["PUBLISH c v", "SET k EX 10 v", "SET k v", "SET k v"]


def test_schedule_counts_filtered_records(spark):
    log = log_of(spark, [(1000, "key", "a", "", None), (3000, "key", "b", "", None)])
    timed = replay.schedule(log, speed=2.0)
    assert timed.where("key = 'b'").first()["offset_ms"] == 1000.0
    assert sorted(r["offset_ms"] for r in replay.looped(timed, 2).collect()) == [0.0, 1000.0, 1000.0, 2000.0]
    with pytest.raises(ValueError):
        replay.schedule(log, speed=0)


def test_allow_lists(spark):
    log = log_of(spark, [(1, "channel", "c:1", "", None), (2, "key", "k:1", "", None), (3, "key", "x", "", None)])
    counts = replay.replay_counts(replay.with_allowed(log, key_patterns=["k:*"])).first()
    assert tuple(counts) == (3, 1, 1, 0, 1)
    entries = spark.createDataFrame([("x",), ("c:?",)], "entry string")
    assert {r["key"]: r["allowed"] for r in replay.allowed_by_list(log, entries).collect()} == {"c:1": True, "k:1": False, "x": True}
    many = spark.range(5000).select(F.concat(F.lit("k:?"), "id", F.lit("*")).alias("entry"))
    log = log.union(spark.sql("select 4L, 'key', 'k:x4999y', '', cast(null as bigint)")) if len(log.columns) == 5 else log
    got = {r["key"]: r["allowed"] for r in replay.allowed_by_list(log, many.union(spark.sql("select '*[1]?'"))).collect()}
    assert got == {"c:1": False, "k:1": False, "x": False, "k:x4999y": True}


def test_random_globs_equal_plain_matching(spark):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("ab:") for _ in range(rng.randrange(n)))
    glob = lambda: "".join(rng.choice(["*", "?", word(4), word(4)]) for _ in range(rng.randrange(1, 5)))
    keys = sorted({word(9) for _ in range(400)} | {"a.b[c]", "ab\n", "a\nb", "(", "é:日"})
    for globs in ([glob() for _ in range(60)], ["??"], ["*"], ["*?", "???", "a*"], ["*.b[*", "?[?]", "*日"], ["*a:b*", "*bbb:a*", "**:a?*"], []):
        entries = spark.createDataFrame([(g,) for g in globs] + [(None,)], "entry string")
        log = log_of(spark, [(i, "key", k, "", None) for i, k in enumerate(keys)] + [(999, "key", None, "", None)])
        got = {r["key"]: r["allowed"] for r in replay.allowed_by_list(log, entries).collect()}
        wanted = {k: k in globs or any(re.match(allow_glob_to_regex(g), k) for g in globs if set(g) & set("*?")) for k in keys}
        assert got == wanted | {None: False}, globs


def test_tried_globs_grow_with_keys_and_globs(spark):
    """A glob for each of a thousand visitors is tried on that visitor's keys alone, whichever end names it."""
    keys = spark.range(1000).select(F.explode(F.array(*[F.format_string(f"Visitors:T%04d:{k}", "id") for k in ("Status", "Room", "Device", "Scent")])).alias("key"))
    globs = spark.range(1000).select(F.explode(F.array(
        F.format_string("Visitors:T%04d:St*", "id"), F.format_string("*T%04d:Room", "id"), F.format_string("Vis*:T%04d:Sc?nt", "id"), F.format_string("*s:T%04d:De*", "id"),
    )).alias("entry"))
    tried = replay.glob_candidates(keys, globs)
    assert tried.count() == 4000
    plan = replay.allowed_by_list(keys.select(F.lit(1).alias("seq"), "key"), globs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "collect_list" not in plan


def fake(spark, key, text, kind="string", salt="s"):
    df = spark.createDataFrame([(key, text, kind)], "key string, text string, value_type string")
    row = pseudonym.pseudonymise(df, salt).first()
    return row["key"], row["text"]


def test_keys(spark):
    key, _ = fake(spark, f"Visitors:{UUID}:Status", "")
    assert re.fullmatch(r"Visitors:[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}:Status", key) and UUID not in key
    assert AT not in fake(spark, f"Visitors:{AT}", "")[0]
    assert re.fullmatch(r"Wearables:WatchDevices:F[0-9A-Z]{11}:X", fake(spark, "Wearables:WatchDevices:E3AB:X", "")[0])
    assert fake(spark, "Wearables:Scent:61234:Level", "")[0] == "Wearables:Scent:71234:Level"
    for same in ("Visitors:T1:Status", "Wearables:Scent:612345:x", "Rooms:E3ABCDEF", "Visitors:Register"):
        assert fake(spark, same, "")[0] == same


def test_values_use_the_same_tokens(spark):
    ticket = fake(spark, f"Visitors:{UUID}", "")[0].split(":")[1]
    watch = fake(spark, "Wearables:WatchDevices:E3ABCDEF", "")[0].split(":")[2]
    other = fake(spark, "Wearables:WatchDevices:E3ABCD", "")[0].split(":")[2]
    assert fake(spark, "k", f"{UUID} E3ABCDEF,E3ABCD xE3ABCDEF")[1] == f"{ticket} {watch},{other} xE3ABCDEF"
    assert fake(spark, "k", "E3ABCDEF", salt="t")[1] != watch
    made = f'{{"{UUID}": ["E3ABCDEF", 1, {{"n": "a\\nE3ABCDEF\\u2013E3ABCD"}}]}}'
    assert fake(spark, "k", made, "json")[1] == f'{{"{ticket}": ["{watch}", 1, {{"n": "a\\n{watch}\\u2013{other}"}}]}}'


def test_scent_and_short_ids(spark):
    assert fake(spark, "k", "61234")[1] == "61234"
    assert fake(spark, "Visitors:x:ScentDeviceID", "61234")[1] == "71234"
    assert fake(spark, "a:Scent:b", '{"id":"61234","n":61234}', "json")[1] == '{"id":"71234","n":61234}'
    assert fake(spark, "a:Scent:b", "61234", "int")[1] == "61234"
    assert fake(spark, "Visitors:x:EmpaticaDeviceIDShort", "12AB")[1] == "F12AB"
