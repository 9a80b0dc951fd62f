"""Time-range and per-ticket extracts, ticket lifetimes and listings."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.operators.ordered import PLAIN, SLICE_ROWS, choose_slicing, even_slices, first_n, settled
from footfall.rules import BLUEIOT, EMPATICA, STATE, TABLE_NAMES, TABLES

TS = "event_timestamp"
FORMATS = ("parquet", "jsonl", "replay")
STATE_COLUMNS = [TS, "event_source_type", "ticket_id", "state_key", "state_value", "ttl_seconds"]


def check_tables(tables) -> tuple[str, ...]:
    unknown = sorted(set(tables) - set(TABLE_NAMES))
    if unknown:
        raise ValueError(f"unknown tables {unknown}; known are {list(TABLE_NAMES)}")
    return tuple(tables)


def _check_range(start, end) -> None:
    if start is not None and end is not None and start >= end:
        raise ValueError("the start must lie before the end")


@dataclass(frozen=True)
class RangeSpec:
    """What a time-range export takes in: ``[start, end)`` of some tables."""

    start: datetime
    end: datetime
    tables: tuple[str, ...] = TABLE_NAMES
    format: str = "parquet"
    include_ticket_id: bool = True

    def __post_init__(self) -> None:
        _check_range(self.start, self.end)
        check_tables(self.tables)

    @property
    def name(self) -> str:
        stamp = "%Y%m%d_%H%M%S"
        return f"timerange_{self.start.strftime(stamp)}_to_{self.end.strftime(stamp)}"


@dataclass(frozen=True)
class TicketSpec:
    """What a per-ticket export takes in; start and end narrow it further."""

    ticket_id: str
    start: datetime | None = None
    end: datetime | None = None
    tables: tuple[str, ...] = TABLE_NAMES
    format: str = "parquet"
    inclusive_end: bool = False

    def __post_init__(self) -> None:
        _check_range(self.start, self.end)
        check_tables(self.tables)

    @property
    def name(self) -> str:
        return f"ticket_{self.ticket_id}"


PARTITION_UNITS = ("HOUR", "DAY", "MONTH", "YEAR")


def partition_start(moment: Column, unit: str) -> Column:
    """The partition of a moment: the start of its day, month or year, or its hour as text. An unknown unit means days."""
    unit = unit if unit in PARTITION_UNITS else "DAY"
    if unit == "HOUR":
        return F.date_format(F.date_trunc("HOUR", moment), "yyyy-MM-dd-HH")
    return F.to_date(F.date_trunc(unit, moment))


def in_range(
    df: DataFrame, start=None, end=None, inclusive_end: bool = False, unit: str = TABLES[STATE].partition_type
) -> DataFrame:
    """Rows of ``[start, end)``; the partitions (of that ``unit``) outside the range are not read.

    Bounds are times, with or without a zone, texts, or columns.
    """

    def at(moment) -> Column:
        return (moment if isinstance(moment, Column) else F.lit(moment)).cast("timestamp")

    if start is not None:
        df = df.where(F.col(TS) >= at(start))
    if end is not None:
        df = df.where(F.col(TS) <= at(end) if inclusive_end else F.col(TS) < at(end))
    if "event_date" in df.columns:
        if start is not None:
            df = df.where(F.col("event_date") >= partition_start(at(start), unit))
        if end is not None:
            df = df.where(F.col("event_date") <= partition_start(at(end), unit))
    return df


def time_range(df: DataFrame, table: str, start, end, include_ticket_id: bool = True) -> DataFrame:
    """Rows of one table in ``[start, end)``, oldest first.

    The state table comes without its ticket, the sensor tables with it unless
    ``include_ticket_id`` is false.
    """
    check_tables([table])
    rows = in_range(df, start, end, unit=TABLES[table].partition_type)
    if table == STATE:
        rows = rows.select(*[c for c in STATE_COLUMNS if c != "ticket_id"])
    elif not include_ticket_id:
        rows = rows.drop("ticket_id")
    return rows.orderBy(TS)


def ticket_rows(df: DataFrame, table: str, ticket_id=None, start=None, end=None) -> DataFrame:
    """A ticket's own rows, oldest first (all tickets' rows when none is named)."""
    check_tables([table])
    own = F.col("ticket_id").isNotNull() if ticket_id is None else F.col("ticket_id") == ticket_id
    rows = in_range(df.where(own), start, end, unit=TABLES[table].partition_type)
    return (rows.select(*STATE_COLUMNS) if table == STATE else rows).orderBy(TS)


def ticket_timeframes(tables: dict[str, DataFrame], ticket_id: str | None = None) -> DataFrame:
    """First and last event time of each ticket over all tables.

    Every table is reduced before the union, so the tables themselves are not shuffled.
    """

    def spans(df: DataFrame) -> DataFrame:
        own = df.where(F.col("ticket_id").isNotNull())
        if ticket_id is not None:
            own = own.where(F.col("ticket_id") == ticket_id)
        return own.groupBy("ticket_id").agg(
            F.min(TS).alias("first_seen"), F.max(TS).alias("last_seen")
        )

    parts = reduce(DataFrame.unionByName, [spans(df) for df in tables.values()])
    return parts.groupBy("ticket_id").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def state_context(
    state: DataFrame, first_seen, last_seen, start=None, end=None, inclusive_end: bool = False
) -> DataFrame:
    """All state events, of any ticket, in a lifetime narrowed by an optional range.

    Any bound may be a time, with or without a zone, a text, or a column.
    """
    rows = in_range(in_range(state, first_seen, last_seen, inclusive_end), start, end)
    return rows.select(*STATE_COLUMNS).orderBy(TS)


def state_in_lifetimes(
    state: DataFrame,
    lifetimes: DataFrame,
    bucket_seconds: int | None = None,
    inclusive_end: bool = False,
    slice_rows: int | None = None,
) -> DataFrame:
    """Every state event inside every ticket's lifetime (``for_ticket``).

    An equi-join on slices of time with the exact bounds as the residual. The slices hold equal
    numbers of events (``even_slices``; ``bucket_seconds`` asks for equal lengths instead), so a
    lifetime's copies cost little beside its result: each copy but the first and the last stands for a whole
    slice of rows. In large input a slice that still has more than ``slice_rows`` events, as those of one
    moment stay together, is split over several tasks.
    """
    slice_rows = choose_slicing(state, slice_rows)
    number = _slices(state, TS, bucket_seconds, slice_rows)
    spans = lifetimes.select(
        F.col("ticket_id").alias("for_ticket"),
        "first_seen",
        "last_seen",
        F.explode(F.sequence(number("first_seen"), number("last_seen"))).alias("_bucket"),
    )
    events = state.withColumn("_bucket", number(TS))
    on = ["_bucket"]
    if slice_rows != PLAIN:
        # One row per slice that has more events than one task should take: rows / slice_rows at most.
        crowded = F.broadcast(
            events.groupBy("_bucket")
            .agg(F.count("*").alias("_n"))
            .where(F.col("_n") > slice_rows)
            .select("_bucket", F.ceil(F.col("_n") / slice_rows).cast("bigint").alias("_parts"))
        )
        parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
        spread = F.pmod(F.xxhash64("state_key", "state_value", TS, F.monotonically_increasing_id()), parts)
        events = events.join(crowded, "_bucket", "left").withColumn("_part", spread).drop("_parts")
        spans = spans.join(crowded, "_bucket", "left").withColumn(
            "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
        ).drop("_parts")
        on.append("_part")
    upper = F.col(TS) <= F.col("last_seen") if inclusive_end else F.col(TS) < F.col("last_seen")
    hits = events.join(spans, on).where((F.col(TS) >= F.col("first_seen")) & upper)
    return hits.select("for_ticket", *STATE_COLUMNS)


def _slices(times: DataFrame, column: str, bucket_seconds: int | None, slice_rows: int):
    """A function from a time column's name to its slice: of equal length, or of equally many rows of ``times``."""
    if bucket_seconds is None:
        return even_slices(times, column, SLICE_ROWS if slice_rows == PLAIN else slice_rows)
    return lambda ts: F.floor(F.unix_seconds(F.col(ts)) / bucket_seconds).cast("bigint")


def lifetime_counts(
    state: DataFrame, lifetimes: DataFrame, bucket_seconds: int | None = None, slice_rows: int | None = None
) -> DataFrame:
    """Number, first and last of the state events in every ticket's lifetime, without listing them.

    Events of one moment are counted together first. An event count up to a moment is the count of all
    earlier slices of time, plus the events before it in its own slice. So each lifetime adds two marks
    to the moments, and the work grows with their sum. Slices hold equal numbers of moments, however
    crowded an hour is (``bucket_seconds`` asks for equal lengths instead). Tickets without events give no row.
    """
    slice_rows = choose_slicing(state, slice_rows)
    moments = state.where(F.col(TS).isNotNull()).groupBy(F.col(TS).alias("at")).agg(F.count("*").alias("n"))
    moments = settled(moments, slice_rows, "moments")
    number = _slices(moments, "at", bucket_seconds, slice_rows)
    ends = F.array(*[F.struct(F.lit(c).alias("side"), F.col(c).alias("at")) for c in ("first_seen", "last_seen")])
    marks = lifetimes.select("ticket_id", F.explode(ends).alias("e")).select("ticket_id", "e.side", "e.at", F.lit(0).cast("bigint").alias("n"))
    nobody = F.lit(None).cast("string")
    rows = marks.unionByName(moments.select(nobody.alias("ticket_id"), nobody.alias("side"), "at", "n"))
    event = F.when(F.col("side").isNull(), F.col("at"))
    rows = rows.select("*", number("at").alias("bucket"), event.alias("event"))
    # a mark stands before the events of its own moment
    inside = W.partitionBy("bucket").orderBy("at", F.col("side").isNull())
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.select(
        "ticket_id", "side", "bucket",
        F.sum("n").over(so_far).alias("inner"),
        F.max("event").over(so_far).alias("latest"),
        F.min("event").over(inside.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("next"),
    ).where(F.col("side").isNotNull())
    # one row for each slice of the time line
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n"), F.min("event").alias("lo"), F.max("event").alias("hi"))
    line = W.orderBy("bucket")
    earlier, later = line.rowsBetween(W.unboundedPreceding, -1), line.rowsBetween(1, W.unboundedFollowing)
    sums = sums.select(
        "bucket",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.max("hi").over(earlier).alias("hi_before"),
        F.min("lo").over(later).alias("lo_after"),
    )
    at = placed.join(sums, "bucket").withColumn("rank", F.col("before") + F.col("inner"))

    def of(side: str, value: Column) -> Column:
        return F.max(F.when(F.col("side") == side, value))

    return (
        at.groupBy(F.col("ticket_id").alias("for_ticket"))
        .agg(
            (of("last_seen", F.col("rank")) - of("first_seen", F.col("rank"))).alias("context_events"),
            of("first_seen", F.coalesce("next", "lo_after")).alias("from_ts"),
            of("last_seen", F.coalesce("latest", "hi_before")).alias("to_ts"),
        )
        .where("context_events > 0")
    )


def list_tickets(state: DataFrame, start=None, end=None) -> DataFrame:
    """Tickets named in visitor keys: first and last event, number of events, newest first."""
    ticket = F.nullif(F.regexp_extract("state_key", "Visitors:([^:]+):", 1), F.lit(""))
    hits = in_range(state, start, end).where(F.col("state_key").like("Visitors:%:%"))
    return (
        hits.groupBy(ticket.alias("ticket_id"))
        .agg(
            F.min(TS).alias("first_seen"),
            F.max(TS).alias("last_seen"),
            F.count("*").alias("event_count"),
        )
        .where(F.col("ticket_id").isNotNull())
        .orderBy(F.desc("first_seen"))
    )


def ticket_table_counts(tables: dict[str, DataFrame], ticket_id: str | None = None) -> DataFrame:
    """Rows, earliest and latest event per ticket and table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        own = df.where(F.col("ticket_id").isNotNull())
        if ticket_id is not None:
            own = own.where(F.col("ticket_id") == ticket_id)
        return own.groupBy(F.lit(name).alias("table_name"), "ticket_id").agg(
            F.count("*").alias("row_count"), F.min(TS).alias("earliest"), F.max(TS).alias("latest")
        )

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])


def ticket_devices(tables: dict[str, DataFrame], ticket_id: str | None = None) -> DataFrame:
    """Distinct devices per ticket and sensor table, ordered."""
    parts = [
        tables[t].select(F.lit(t).alias("table_name"), "ticket_id", "device_id")
        for t in (EMPATICA, BLUEIOT)
        if t in tables
    ]
    rows = reduce(DataFrame.unionByName, parts).where(F.col("ticket_id").isNotNull())
    if ticket_id is not None:
        rows = rows.where(F.col("ticket_id") == ticket_id)
    return rows.distinct().orderBy("table_name", "ticket_id", "device_id")


def ticket_state_keys(state: DataFrame, n: int = 10, ticket_id: str | None = None) -> DataFrame:
    """The first ``n`` distinct state keys of a ticket, or of each ticket."""
    own = state.where(F.col("ticket_id").isNotNull())
    if ticket_id is not None:
        own = own.where(F.col("ticket_id") == ticket_id)
    keys = own.select("ticket_id", "state_key").distinct()
    if ticket_id is not None:
        return keys.orderBy("state_key").limit(n)
    return first_n(keys, ["ticket_id"], [F.col("state_key")], n)


def rows_of_tickets(df: DataFrame, tickets: DataFrame) -> DataFrame:
    """Rows whose ticket is in a list (``entry``): many per-ticket extracts as one job."""
    wanted = tickets.select(F.col("entry").alias("ticket_id"))
    return df.join(wanted, "ticket_id", "left_semi")
