"""Feed rows to table rows."""

import pytest
from pyspark.sql import functions as F

from footfall.functions import biometrics
from footfall.operators import assignment, projection, routing
from footfall.rules import BLUEIOT, EMPATICA, STATE, table_schema
from footfall.sources import feeds

BIO = "Wearables:WatchDevices:{}:BioSensors"
POS = "Wearables:WatchDevices:{}:BlueIoTSensors"


def by_seq(df):
    return {r["seq"]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def feed(raw_of):
    return raw_of([
        ("key", "Visitors:VIS-B7:EmpaticaDeviceID", "watch-41"),
        ("channel", BIO.format("watch-41"),
         '{"Heart_Rate_Value":81.25,"Skin_Conductivity_Value":0.8,"Skin_Temperature_Value":"33.75","Steps":7.9,"Other":1}'),
        ("channel", BIO.format("watch-41"), "{bad"),
        ("channel", BIO.format("watch-41"), '{"Heart_Rate_Value":"high","Activity":null}'),
        ("channel", BIO.format(""), '{"Heart_Rate_Value":1}'),
        ("channel", POS.format("tag-9"), '{"BlueIoT_Position":[4.125,17.5],"Room_ID":1}'),
        ("channel", POS.format("tag-9"), '{"BlueIoT_Position":[3]}'),
        ("key", "Visitors:VIS-A3:Status", "Active", -1),
        ("channel", "Visitors:Register", '{"ticket_id":"VIS-B7","status":"Registered"}', 5),
        ("key", "Rooms:A:Playhead", '{"b":1,"a":true}', 30),
        ("key", "Unknown:Key", "1"),
        ("channel", BIO.format("watch-41"), "12"),
    ])


@pytest.fixture(scope="module")
def routed(feed):
    return routing.route(feed)


def test_biosensor_rows(routed, feed):
    held = assignment.assignment_intervals(assignment.assignment_log(feed))
    rows = by_seq(projection.empatica_rows(routed, held))
    assert set(rows) == {1, 2, 3, 11}, "an empty device id drops the row, bad JSON does not"
    first = rows[1]
    assert (first["device_id"], first["heart_rate"], first["skin_conductivity"], first["skin_temperature"]) == (
        "watch-41", 81.25, 0.8, 33.75
    )
    assert first["steps"] == 7 and first["counter"] is None and first["ticket_id"] == "VIS-B7"
    for seq in (2, 11):
        assert rows[seq]["heart_rate"] is None and rows[seq]["ticket_id"] is None and not rows[seq]["payload_ok"]
    assert rows[3]["heart_rate"] is None and rows[3]["activity"] is None and rows[3]["ticket_id"] == "VIS-B7"


def test_position_rows(routed):
    rows = by_seq(projection.sensor_rows(routed, BLUEIOT))
    assert (rows[5]["position_x"], rows[5]["position_y"], rows[5]["room"]) == (4.125, 17.5, 1)
    assert (rows[6]["position_x"], rows[6]["position_y"], rows[6]["room"]) == (3.0, None, None)


def test_state_rows(routed):
    rows = by_seq(projection.state_rows(routed))
    assert set(rows) == {0, 7, 8, 9}
    status = rows[7]
    assert (status["ticket_id"], status["event_source_type"], status["state_value"], status["ttl_seconds"]) == (
        "VIS-A3", "key", "Active", None
    )
    assert (rows[8]["event_source_type"], rows[8]["ticket_id"], rows[8]["ttl_seconds"]) == ("channel", "Register", None)
    assert rows[8]["state_value"] == '{"ticket_id": "VIS-B7", "status": "Registered"}'
    assert (rows[9]["state_value"], rows[9]["ttl_seconds"], rows[9]["ticket_id"]) == ('{"b": 1, "a": true}', 30, None)


def test_ids_and_tags(routed):
    ids = {r["seq"]: (r["i"], r["t"]) for r in routed.select(
        "seq", routing.row_id().alias("i"), routing.data_type(F.col("key")).alias("t")).collect()}
    assert ids[1] == ("watch-41", "BioSensors") and ids[4][0] == BIO.format("")
    assert ids[0] == ("Visitors:VIS-B7:EmpaticaDeviceID", "EmpaticaDeviceID")
    assert ids[9] == ("Rooms:A:Playhead", "Playhead")


def test_ids_with_dashes(raw_of):
    rows = projection.state_rows(routing.route(raw_of([("key", "Visitors:VISITOR-2024-001:Status", "checked_in")])))
    assert rows.first()["ticket_id"] == "VISITOR-2024-001"


def test_conform_gives_the_declared_table(routed):
    for table, rows in ((EMPATICA, projection.sensor_rows(routed, EMPATICA)), (STATE, projection.state_rows(routed))):
        made = projection.conform(rows, table)
        assert [(f.name, f.dataType) for f in made.schema.fields] == [
            (f.name, f.dataType) for f in table_schema(table).fields
        ]
    holes = projection.state_rows(routed).withColumn("state_key", F.lit(None).cast("string"))
    assert projection.conform(holes, STATE).count() == 0


def test_counts_and_times(routed, feed):
    got = {r["target_table"]: (r["events"], r["skipped"]) for r in projection.assembly_counts(routed).collect()}
    assert got == {"empatica": (5, 1), "blueiot": (2, 0), "global_state_events": (4, 0)}
    untimed = feed.withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    assert feeds.with_source_time(untimed).where("event_timestamp is null").count() == 0


def test_sanitise(spark):
    df = spark.createDataFrame([("d", 300.0, 36.0, 5.0)], "device_id string, heart_rate double, skin_temperature double, skin_conductivity double")
    assert biometrics.sanitise(df, ["device_id"]).first().asDict() == {
        "device_id": "d", "heart_rate": None, "skin_temperature": 36.0, "skin_conductivity": 5.0
    }
