"""Tables back to a replay log, and the schedule and commands of a replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.patterns import allow_list_match
from footfall.rules import BLUEIOT, EMPATICA, STATE, TABLES

EVENT_TIME = "event_timestamp"
LOG_COLUMNS = ["timestamp", "type", "key", "value", "ttl"]


def table_kind(columns) -> str | None:
    """Which table a frame is, judged by its columns."""
    names = set(columns)
    if "state_key" in names:
        return STATE
    if {"device_id", "heart_rate"} <= names:
        return EMPATICA
    if {"device_id", "position_x"} <= names:
        return BLUEIOT
    return None


def typed_value(key: Column, text: Column) -> Column:
    """Struct ``value_type, value`` of a stored state text.

    Device ids stay text; then time, JSON and numbers are tried; empty and null are ''.
    """
    is_time = (
        text.contains("T")
        & (text.contains("+") | text.contains("Z") | text.rlike(":.*:"))
        & text.rlike(r"^\d{4}-?\d{2}-?\d{2}T")
        & F.regexp_replace(text, "Z$", "+00:00").try_cast("timestamp").isNotNull()
    )
    parsed = F.try_parse_json(text)
    first = F.substring(F.trim(text), 1, 1)

    def typed(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("value_type"), value.alias("value"))

    trimmed = F.trim(text)
    return (
        F.when(F.coalesce(text, F.lit("")) == "", typed("string", F.lit("")))
        .when(key.contains("DeviceID"), typed("string", text))
        .when(is_time, typed("time", F.regexp_replace(text, "Z$", "+00:00")))
        .when(parsed.isNotNull() & first.isin("{", "["), typed("json", text))
        .when(parsed.isNotNull() & (first == '"'),
              typed("string", F.try_variant_get(parsed, "$", "string")))
        .when(trimmed.isin("true", "false"), typed("bool", trimmed))
        .when(trimmed == "null", typed("null", F.lit("")))
        .when(trimmed.rlike(r"^[+-]?\d+$"),
              typed("int", F.coalesce(trimmed.try_cast("decimal(38,0)").cast("string"), trimmed)))
        .when(trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") &
              (parsed.isNotNull() | trimmed.contains(".")), typed("float", trimmed))
        .otherwise(typed("string", text))
    )


def replay_state(df: DataFrame) -> DataFrame:
    """State rows as replay records; a missing source type means ``key``."""
    names = set(df.columns)
    kind = F.col("event_source_type") if "event_source_type" in names else F.lit(None)
    ttl = F.col("ttl_seconds") if "ttl_seconds" in names else F.lit(None)
    typed = typed_value(F.col("state_key"), F.col("state_value"))
    return df.withColumn("_typed", typed).select(
        F.unix_millis("event_timestamp").alias("timestamp"),
        F.coalesce(kind, F.lit("key")).alias("type"),
        F.col("state_key").alias("key"),
        F.col("_typed.value").alias("text"),
        F.col("_typed.value_type").alias("value_type"),
        ttl.cast("bigint").alias("ttl"),
        *_arrival(df),
    )


def _arrival(df: DataFrame) -> list[str]:
    return [c for c in ("seq",) if c in df.columns]


def _as_type(value: Column, kind: str) -> Column:
    if kind == "int":
        return value.cast("double").cast("bigint")
    return value.cast("double" if kind == "float" else "string")


def _channel(tail: str) -> Column:
    return F.concat(F.lit("Wearables:WatchDevices:"), F.col("device_id"), F.lit(tail))


def _sensor_record(df: DataFrame, tail: str, message: Column) -> DataFrame:
    return df.select(
        F.unix_millis("event_timestamp").alias("timestamp"),
        F.lit("channel").alias("type"),
        _channel(tail).alias("key"),
        F.to_json(message).alias("text"),
        F.lit("json").alias("value_type"),
        F.lit(None).cast("bigint").alias("ttl"),
        *_arrival(df),
    )


def replay_empatica(df: DataFrame, table=TABLES[EMPATICA]) -> DataFrame:
    """Biosensor rows as channel messages; null readings are left out."""
    fields = [
        _as_type(F.col(column), table.field_types.get(source, "float")).alias(source)
        for source, column in table.field_mappings.items()
        if column in df.columns
    ]
    return _sensor_record(df, ":BioSensors", F.struct(*fields))


def replay_blueiot(df: DataFrame, table=TABLES[BLUEIOT]) -> DataFrame:
    """Position rows as channel messages; a null coordinate becomes 0."""
    point_type = table.field_types.get("BlueIoT_Position", "float")
    point = F.array(
        *[F.coalesce(_as_type(F.col(c), point_type), F.lit(0)) for c in ("position_x", "position_y")]
    )
    fields = [point.alias("BlueIoT_Position")]
    if "room" in df.columns:
        fields.append(_as_type(F.col("room"), table.field_types.get("Room_ID", "string")).alias("Room_ID"))
    return _sensor_record(df, ":BlueIoTSensors", F.struct(*fields))


def to_replay(df: DataFrame) -> DataFrame:
    """Any of the three tables as replay records (``text`` and its ``value_type``)."""
    makers = {STATE: replay_state, EMPATICA: replay_empatica, BLUEIOT: replay_blueiot}
    kind = table_kind(df.columns)
    if kind is None:
        raise ValueError(f"no known table has the columns {df.columns}")
    return makers[kind](df)


def combined_replay(frames: dict[str, DataFrame]) -> DataFrame:
    """All tables as one log; ``table_rank`` and ``seq`` settle equal milliseconds."""
    parts = [
        to_replay(df).withColumn("table_rank", F.lit(rank)) for rank, df in enumerate(frames.values())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def in_replay_order(log: DataFrame) -> DataFrame:
    """The log in time order (a range-partitioned sort)."""
    ties = [c for c in ("table_rank", "seq") if c in log.columns]
    return log.orderBy("timestamp", *ties)


def as_log(records: DataFrame) -> DataFrame:
    """The five stored columns, the value as UTF-8 bytes."""
    return records.withColumn("value", F.encode("text", "UTF-8")).select(*LOG_COLUMNS)


def log_span(frames: dict[str, DataFrame]) -> DataFrame:
    """``first`` and ``last`` time of a combined log, in milliseconds, from the tables' times alone."""
    spans = [df.agg(F.min(EVENT_TIME).alias("a"), F.max(EVENT_TIME).alias("b")) for df in frames.values()]
    both = reduce(DataFrame.unionByName, spans)
    return both.agg(F.unix_millis(F.min("a")).alias("first"), F.unix_millis(F.max("b")).alias("last"))


def schedule(log: DataFrame, speed: float = 1.0, span: DataFrame | None = None) -> DataFrame:
    """Adds ``offset_ms``: time since the log's first record, divided by ``speed``.

    The first record is that of the whole log, before any filter: by ``span`` (``log_span``)
    where it is given, else looked up.
    """
    if speed <= 0:
        raise ValueError("speed must be positive")
    first = (log.agg(F.min("timestamp").alias("first")) if span is None else span.select("first")).scalar()
    return log.withColumn("offset_ms", (F.col("timestamp") - first) / F.lit(float(speed)))


def looped(scheduled: DataFrame, times: int, span: DataFrame | None = None, speed: float = 1.0) -> DataFrame:
    """The schedule ``times`` over; each ``iteration`` starts where the one before ended.

    ``span`` and ``speed`` as in ``schedule`` save a pass over the log for its length.
    """
    whole = scheduled.agg(F.max("offset_ms").alias("length"))
    if span is not None:
        whole = span.select(((F.col("last") - F.col("first")) / F.lit(float(speed))).alias("length"))
    length = whole.scalar()
    rounds = F.explode(F.sequence(F.lit(1), F.lit(times)))
    return scheduled.withColumn("iteration", rounds).withColumn(
        "offset_ms", F.col("offset_ms") + (F.col("iteration") - 1) * length
    )


def with_allowed(
    log: DataFrame, key_patterns: list[str] | None = None, channel_patterns: list[str] | None = None
) -> DataFrame:
    """Adds ``allowed``: whether the allow-list of the record's type names its key.

    A type without a list lets everything through.
    """

    def listed(patterns) -> Column:
        return F.lit(True) if patterns is None else allow_list_match(F.col("key"), patterns)

    return log.withColumn(
        "allowed", F.when(F.col("type") == "channel", listed(channel_patterns)).otherwise(listed(key_patterns))
    )


def allowed_by_list(log: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds ``allowed`` by a list table (``entry``) of exact keys and globs.

    Both may be many. The log's distinct keys are joined to the exact entries, and to the globs
    that ``glob_candidates`` names for them, which are then tested. A null key is not allowed.
    """
    is_glob = F.col("entry").contains("*") | F.col("entry").contains("?")
    keys = log.select("key").where("key is not null").distinct()
    exact = keys.join(entries.where(~is_glob).select(F.col("entry").alias("key")), "key", "left_semi")
    tried = glob_candidates(keys, entries.where(is_glob).select("entry").distinct())
    by_glob = tried.where(F.rlike("key", allow_regex("entry"))).select("key")
    allowed = exact.union(by_glob).distinct().withColumn("_listed", F.lit(True))
    marked = log.join(allowed, "key", "left")
    return marked.withColumn("allowed", F.coalesce("_listed", F.lit(False))).select(*log.columns, "allowed")


def glob_candidates(keys: DataFrame, globs: DataFrame) -> DataFrame:
    """(key, entry): the globs of ``globs`` that a key of ``keys`` has to be tested against.

    A glob is dealt by its literal ends, the text before its first and after its last wildcard. A key
    looks up its prefixes of the lengths that occur; each prefix that is some glob's names the lengths of
    those globs' ends, and the key looks up prefix and end together. So a pair comes out only where
    both ends fit. Globs with a longer text between wildcards than at their ends are dealt by that text, which a
    key looks up among its parts of the lengths that occur; those without any text by the number of characters they ask for.
    """
    # a glob's end may stand before a key's last line break, as its pattern's does
    bare = F.regexp_replace("key", r"(\r\n|[\n\r\x{85}\x{2028}\x{2029}])\z", "")
    probes = keys.select("key", F.explode(F.array_distinct(F.array("key", bare))).alias("_text"))
    lead, tail = F.regexp_extract("entry", r"\A[^*?]*", 0), F.regexp_extract("entry", r"[^*?]*\z", 0)
    between = F.regexp_extract_all(F.expr("substring(entry, length(_lead) + 1, length(entry) - length(_lead) - length(_tail))"), F.lit("[^*?]+"), 0)
    ends = globs.withColumns({"_lead": lead, "_tail": tail}).withColumn("_runs", between)
    inner = F.coalesce(F.array_max(F.transform("_runs", lambda r: F.struct(F.length(r).alias("n"), r.alias("text"))))["text"], F.lit(""))
    ends = ends.select("entry", "_lead", "_tail", inner.alias("_inner"))
    at_ends = F.length("_lead") + F.length("_tail")
    ended = ends.where((at_ends > 0) & (at_ends >= F.length("_inner")))
    # lengths are few: none is longer than the longest entry
    lengths = ended.agg(F.coalesce(F.collect_set(F.length("_lead")), F.array().cast("array<int>"))).scalar()
    heads = ended.groupBy("_lead").agg(F.collect_set(F.length("_tail")).alias("_tails"))
    size = F.length("_text")
    fitting = F.filter("_sizes", lambda n: n <= size)
    by_lead = probes.withColumn("_sizes", lengths).select("key", "_text", F.explode(fitting).alias("_n")).withColumn("_lead", F.left("_text", F.col("_n")))
    by_lead = by_lead.join(heads, "_lead")
    room = F.filter("_tails", lambda n: n + F.col("_n") <= size)
    by_ends = by_lead.select("key", "_text", "_lead", F.explode(room).alias("_m")).withColumn("_tail", F.right("_text", F.col("_m")))
    by_ends = by_ends.select("key", "_lead", "_tail").join(ended, ["_lead", "_tail"]).select("key", "entry")

    inner = ends.where(at_ends < F.length("_inner"))
    sizes = inner.agg(F.coalesce(F.collect_set(F.length("_inner")), F.array().cast("array<int>"))).scalar()
    parts = F.flatten(F.transform(F.filter("_sizes", lambda n: n <= size), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring("_text", i, n))))
    by_inner = probes.withColumn("_sizes", sizes).select("key", F.explode(F.array_distinct(parts)).alias("_inner")).join(inner, "_inner").select("key", "entry")

    bare_wild = ends.where((at_ends == 0) & (F.col("_inner") == "")).withColumn("_n", F.length(F.replace("entry", F.lit("*"))))
    open_ended = F.col("entry").contains("*")
    # of the open ones, the one that asks for the fewest characters takes what any other takes
    least = bare_wild.where(open_ended).agg(F.min_by("entry", "_n").alias("entry"), F.min("_n").alias("_n")).where("entry is not null")
    by_least = probes.join(F.broadcast(least), size >= F.col("_n")).select("key", "entry")
    by_size = probes.withColumn("_n", size).join(bare_wild.where(~open_ended), "_n").select("key", "entry")
    return reduce(DataFrame.union, [by_ends, by_inner, by_least, by_size])


def allow_regex(glob: str) -> Column:
    """The regex of an allow-list glob, as a column: ``*`` and ``?`` are wild, all else is literal."""
    literal = F.regexp_replace(glob, r"([^A-Za-z0-9*?])", r"\\$1")
    wild = F.replace(F.replace(literal, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.concat(F.lit(r"(?:\A"), wild, F.lit("$)"))


def command(text: Column) -> Column:
    """The command that replays a record: publish, set, or set with a positive time to live."""
    key, ttl = F.col("key"), F.col("ttl")
    expiry = F.when(ttl > 0, F.concat(F.lit(" EX "), ttl.cast("string"))).otherwise("")
    return F.when(
        F.col("type") == "channel", F.concat(F.lit("PUBLISH "), key, F.lit(" "), text)
    ).otherwise(F.concat(F.lit("SET "), key, expiry, F.lit(" "), text))


def replay_counts(flagged: DataFrame) -> DataFrame:
    """Events, publishes, key sets and what the allow-lists held back."""
    channel, ok = F.col("type") == "channel", F.col("allowed")
    return flagged.agg(
        F.count("*").alias("events"),
        F.count_if(channel & ok).alias("channel_publishes"),
        F.count_if(~channel & ok).alias("key_sets"),
        F.count_if(channel & ~ok).alias("filtered_channels"),
        F.count_if(~channel & ~ok).alias("filtered_keys"),
    )
