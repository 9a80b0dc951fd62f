"""Routing rules, table schemas and their validation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, CHANNEL = "key", "channel"
EMPATICA, BLUEIOT, STATE = "empatica", "blueiot", "global_state_events"
TABLE_NAMES = (EMPATICA, BLUEIOT, STATE)


class ConfigError(ValueError):
    """A rule or table description that cannot be used."""


@dataclass(frozen=True)
class Rule:
    """Sends the keys or channels that match a glob to one target table."""

    name: str
    source_type: str
    pattern: str
    target_table: str
    id_regex: str | None = None
    value_is_object: bool = False


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    fields: tuple["Column", ...] = ()
    repeated: bool = False


@dataclass(frozen=True)
class Table:
    """A target table: schema, day partitioning, clustering and payload mapping.

    ``field_mappings`` maps payload field to column, ``field_types`` gives the
    type a payload field has when the row is turned back into a message.
    """

    name: str
    columns: tuple[Column, ...]
    clustering: tuple[str, ...]
    field_mappings: dict[str, str] = field(default_factory=dict)
    field_types: dict[str, str] = field(default_factory=dict)
    partition_field: str = "event_timestamp"
    partition_type: str = "DAY"


# The routing rules, in file order.
RULES = (
    Rule("Galleries", KEY, "Galleries:*", STATE, "(?P<state_key>.*)", False),
    Rule("IO", KEY, "IO:*", STATE, "(?P<state_key>.*)", True),
    Rule("Rooms", KEY, "Rooms:*", STATE, "(?P<state_key>.*)", True),
    Rule("Visitors", KEY, "Visitors:*", STATE, "Visitors:(?P<ticket_id>[^:]+):.*", False),
    Rule("Wearables", KEY, "Wearables:*", STATE, "(?P<state_key>.*)", False),
    Rule("BioSensors", CHANNEL, "Wearables:WatchDevices:*:BioSensors", EMPATICA,
         "Wearables:WatchDevices:(?P<device_id>[^:]+):BioSensors", True),
    Rule("Position", CHANNEL, "Wearables:WatchDevices:*:BlueIoTSensors", BLUEIOT,
         "Wearables:WatchDevices:(?P<device_id>[^:]+):BlueIoTSensors", True),
    Rule("VisitorRegister", CHANNEL, "Visitors:Register", STATE, "(?P<state_key>.*)", True),
    Rule("VisitorStatus", CHANNEL, "Visitors:*:Status", STATE,
         "Visitors:(?P<ticket_id>[^:]+):.*", False),
    Rule("DeviceAssignment", CHANNEL, "Visitors:*:AssignDevice", STATE,
         "Visitors:(?P<ticket_id>[^:]+):.*", False),
)

# Columns, clustering, payload mappings and payload types per table.
TABLES = {
    EMPATICA: Table(
        EMPATICA,
        (
            Column("event_timestamp", "TIMESTAMP", True),
            Column("ticket_id", "STRING"),
            Column("device_id", "STRING", True),
            Column("heart_rate", "FLOAT64"),
            Column("skin_conductivity", "FLOAT64"),
            Column("skin_temperature", "FLOAT64"),
            Column("accelerometer", "FLOAT64"),
            Column("steps", "INT64"),
            Column("activity", "FLOAT64"),
            Column("counter", "FLOAT64"),
            Column("battery_level_1", "FLOAT64"),
            Column("battery_level_2", "FLOAT64"),
        ),
        ("ticket_id", "device_id"),
        {
            "Heart_Rate_Value": "heart_rate",
            "Skin_Conductivity_Value": "skin_conductivity",
            "Skin_Temperature_Value": "skin_temperature",
            "Accelerometer_Value": "accelerometer",
            "Activity": "activity",
            "Counter": "counter",
            "Steps": "steps",
            "Battery_1": "battery_level_1",
            "Battery_2": "battery_level_2",
        },
        {
            "Heart_Rate_Value": "int",
            "Skin_Conductivity_Value": "float",
            "Skin_Temperature_Value": "float",
            "Accelerometer_Value": "float",
            "Activity": "int",
            "Counter": "int",
            "Steps": "int",
            "Battery_1": "int",
            "Battery_2": "int",
        },
    ),
    BLUEIOT: Table(
        BLUEIOT,
        (
            Column("event_timestamp", "TIMESTAMP", True),
            Column("ticket_id", "STRING"),
            Column("device_id", "STRING", True),
            Column("position_x", "FLOAT64"),
            Column("position_y", "FLOAT64"),
            Column("room", "INT64"),
        ),
        ("ticket_id", "device_id"),
        {"BlueIoT_Position": "position", "Room_ID": "room"},
        {"BlueIoT_Position": "float", "Room_ID": "int"},
    ),
    STATE: Table(
        STATE,
        (
            Column("event_timestamp", "TIMESTAMP", True),
            Column("event_source_type", "STRING", True),
            Column("ticket_id", "STRING"),
            Column("state_key", "STRING", True),
            Column("state_value", "STRING"),
            Column("ttl_seconds", "INT64"),
        ),
        ("ticket_id", "state_key"),
        {"key": "state_key", "value": "state_value"},
        {"key": "str", "value": "str"},
    ),
}

# The Spark type of each declared column type.
SPARK_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampNTZType(),
}

RAW_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("source_type", T.StringType(), False),
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.StringType()),
        T.StructField("ttl", T.LongType()),
    ]
)


def column_type(column: Column) -> T.DataType:
    """Spark type of a declared column; an unknown type is text."""
    if column.type == "RECORD":
        base: T.DataType = struct_of(column.fields)
    else:
        base = SPARK_TYPES.get(column.type, T.StringType())
    return T.ArrayType(base) if column.repeated else base


def struct_of(columns) -> T.StructType:
    return T.StructType([T.StructField(c.name, column_type(c), not c.required) for c in columns])


def table_schema(table: str, tables: dict[str, Table] = TABLES) -> T.StructType:
    """Schema of a target table, built from its declared columns."""
    if table not in tables:
        raise ConfigError(f"unknown table: {table}")
    return struct_of(tables[table].columns)


def _compiles(regex: str | None) -> bool:
    try:
        return re.compile(regex or "") is not None
    except re.error:
        return False


# What must hold of a rule and of a table: the field it is about, the test, and what to say.
RULE_CHECKS = (
    ("source_type", lambda r: r.source_type in (KEY, CHANNEL), f"is neither {KEY} nor {CHANNEL}"),
    ("target_table", lambda r: r.target_table in TABLE_NAMES, f"is none of {', '.join(TABLE_NAMES)}"),
    ("id_regex", lambda r: r.id_regex or r.target_table not in (EMPATICA, BLUEIOT), "is needed to find the device"),
    ("id_regex", lambda r: _compiles(r.id_regex), "is no regular expression"),
)
TABLE_CHECKS = (
    ("columns", lambda t: len({c.name for c in t.columns}) == len(t.columns), "name a column twice"),
    ("clustering", lambda t: set(t.clustering) <= {c.name for c in t.columns}, "names no column of the table"),
    ("partition_field", lambda t: t.partition_field in {c.name for c in t.columns}, "is no column of the table"),
)


def _faults(thing, checks) -> list[str]:
    return [f"{name} {said}" for name, holds, said in checks if not holds(thing)]


def _absent(raw: dict, needed) -> list[str]:
    return [f"{name} is missing" for name in needed if raw.get(name) is None]


def rule_faults(raw: dict) -> list[str]:
    """Everything that is wrong with a described rule."""
    return _absent(raw, ("name", "source_type", "pattern", "target_table")) or _faults(_rule(raw), RULE_CHECKS)


def _rule(raw: dict) -> Rule:
    known = {f.name: raw[f.name] for f in fields(Rule) if raw.get(f.name) is not None}
    return Rule(**known | {"value_is_object": bool(raw.get("value_is_object"))})


def check_rule(raw: dict) -> Rule:
    """Turns a described rule into a ``Rule``, or reports all its faults."""
    return check_rules([raw])[0]


def check_rules(raw_rules) -> tuple[Rule, ...]:
    """Turns described rules into ``Rule``s, or reports the faults of all of them together."""
    found = {at: faults for at, raw in enumerate(raw_rules) if (faults := rule_faults(raw))}
    if found:
        raise ConfigError("; ".join(f"rule {at}: {', '.join(faults)}" for at, faults in found.items()))
    return tuple(map(_rule, raw_rules))


def check_table(name: str, raw: dict) -> Table:
    """Turns a described table into a ``Table``, or reports its faults; mappings and types are optional."""
    faults = _absent(raw, ("partition_field", "partition_type", "clustering", "columns"))
    if not faults:
        columns = [Column(c["name"], c["type"], c.get("mode") == "REQUIRED", repeated=c.get("mode") == "REPEATED") for c in raw["columns"]]
        optional = {f: dict(raw[f]) for f in ("field_mappings", "field_types") if f in raw}
        table = Table(
            name, tuple(columns), tuple(raw["clustering"]), **optional,
            partition_field=raw["partition_field"], partition_type=raw["partition_type"],
        )
        faults = _faults(table, TABLE_CHECKS)
    if faults:
        raise ConfigError(f"table {name}: {', '.join(faults)}")
    return table


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    """The rules as a small table, with their position in the file."""
    entries = [
        F.struct(
            F.lit(i).cast("bigint").alias("rule_idx"),
            F.lit(r.name).alias("name"),
            F.lit(r.source_type).alias("source_type"),
            F.lit(r.pattern).alias("pattern"),
            F.lit(r.target_table).alias("target_table"),
            F.lit(r.id_regex).cast("string").alias("id_regex"),
            F.lit(r.value_is_object).alias("value_is_object"),
        )
        for i, r in enumerate(rules)
    ]
    return spark.range(1).select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def java_regex(regex: str) -> str:
    """The regex with its named groups as plain ones (JVM group names allow no ``_``)."""
    return re.sub(r"\(\?P<\w+>", "(", regex)


def group_number(regex: str | None, name: str) -> int | None:
    return re.compile(regex).groupindex.get(name) if regex else None
