"""Data-quality profiles, counts and reconciliation reports."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.patterns import any_part, glob_match
from footfall.operators.ordered import first_n

TS = "event_timestamp"
# Value buckets of the exact quantile search, per metric.
QUANTILE_BUCKETS = 4_096
QUARTILES = (0.25, 0.5, 0.75)
# Past every finite double on the bent scale.
BEYOND = 1_500.0


def load_check(df: DataFrame, prefix: str = "", since=None) -> DataFrame:
    """Devices, rows, time span, number of zones and mean heart rate of devices with a prefix."""
    return _load_rows(df, prefix, since).agg(
        F.countDistinct("device_id").alias("unique_devices"),
        F.count("*").alias("total_rows"),
        F.min(TS).alias("earliest"),
        F.max(TS).alias("latest"),
        F.countDistinct("zone").alias("zones"),
        F.avg("heart_rate").alias("avg_heart_rate"),
    )


def load_check_zones(df: DataFrame, prefix: str = "", since=None) -> DataFrame:
    """The distinct zones behind ``load_check``, one row each."""
    rows = _load_rows(df, prefix, since).where(F.col("zone").isNotNull())
    return rows.groupBy("zone").agg(F.count("*").alias("zone_rows"))


def _load_rows(df: DataFrame, prefix: str, since) -> DataFrame:
    rows = df.where(F.col("device_id").startswith(prefix))
    return rows if since is None else rows.where(F.col(TS) >= since)


def state_check(state: DataFrame, part: str = "", since=None) -> DataFrame:
    """Distinct keys and rows of state keys that contain a text."""
    return _state_rows(state, part, since).agg(
        F.countDistinct("state_key").alias("unique_keys"), F.count("*").alias("total_rows")
    )


def state_check_keys(state: DataFrame, part: str = "", since=None) -> DataFrame:
    """The distinct keys behind ``state_check``, one row each (they may be many)."""
    return _state_rows(state, part, since).groupBy("state_key").agg(F.count("*").alias("key_rows"))


def _state_rows(state: DataFrame, part: str, since) -> DataFrame:
    rows = state.where(F.col("state_key").contains(part))
    return rows if since is None else rows.where(F.col(TS) >= since)


def table_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.min(TS).alias("earliest_event"),
        F.max(TS).alias("latest_event"),
    )


def table_stats(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and distinct ids per table; each table comes with its id column."""
    parts = [
        df.agg(F.count("*").alias("total_rows"), F.countDistinct(key).alias("unique_ids")).select(
            F.lit(name).alias("table_name"), "total_rows", "unique_ids"
        )
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def heart_rate_span(df: DataFrame) -> DataFrame:
    """Mean, lowest and highest heart rate and the time span in seconds."""
    return df.agg(
        F.avg("heart_rate").alias("mean_hr"),
        F.min("heart_rate").alias("min_hr"),
        F.max("heart_rate").alias("max_hr"),
        F.min(TS).alias("from_ts"),
        F.max(TS).alias("to_ts"),
        F.timestamp_diff("SECOND", F.min(TS), F.max(TS)).alias("span_seconds"),
    )


def describe(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles (linear) of each metric.

    The values at the wanted ranks are found by counting. Each pass counts the rows of the intervals that hold
    them in buckets, and goes on with the smallest and largest value of the buckets that hold them, until
    these are equal. So no task ever holds more than its counts, however close the values are. Buckets of the first
    pass are of equal width on a scale that is straight about the typical size of a value and
    logarithmic beyond, so an outlier or an infinity does not squeeze all others into one; later ones are
    straight. Passes run when this is called: two or three, more where values are very close. A metric without values has count 0.
    """
    names = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])).alias("_m")
    long = df.select(names).select("_m.metric", F.col("_m.value").cast("double").alias("value")).where("value is not null")
    base = long.groupBy("metric").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx(F.abs("value"), F.lit(0.5), F.lit(100)).alias("scale"),
    )
    found = {r["metric"]: r for r in base.collect()}  # one row a metric, and metrics are an argument
    ranks = {m: [(r["count"] - 1) * q for q in QUARTILES] for m, r in found.items()}
    wanted = {m: sorted({f(x) for x in at for f in (math.floor, math.ceil)}) for m, at in ranks.items()}
    values = _at_ranks(long, found, wanted)
    rows = []
    for m in dict.fromkeys(metrics):
        r = found.get(m)
        if r is None:
            rows.append((m, 0, *[None] * 7))
            continue
        between = [_between(values[m, math.floor(x)], values[m, math.ceil(x)], x - math.floor(x)) for x in ranks[m]]
        rows.append((m, r["count"], r["mean"], r["std"], r["min"], *between, r["max"]))
    kinds = ["count bigint", *(f"{c} double" for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))]
    return df.sparkSession.createDataFrame(rows, ", ".join(["metric string", *kinds]))


def _between(low: float, high: float, part: float) -> float:
    return low if low == high else low + (high - low) * part


def _at_ranks(long: DataFrame, found: dict, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """The values of ``long`` (metric, value) at the wanted ranks of each metric, in ascending order from 0."""
    values: dict[tuple[str, int], float] = {}
    # metric -> intervals (smallest, largest, rows before, ranks inside)
    open_ = {m: [(r["min"], r["max"], 0, wanted[m])] for m, r in found.items()}
    first = True
    while True:
        specs = []
        for m, intervals in open_.items():
            for i, (low, high, _, ranks) in enumerate(intervals):
                if low == high:
                    values.update({(m, k): low for k in ranks})
                else:
                    specs.append((m, i, low, high, found[m]["scale"] or 1.0))
        if not specs:
            return values
        counts = _bucket_counts(long, specs, first)
        # an interval whose values all fall in one bucket again is parted into its two ends and what is between
        stuck = [s for s in specs if len(counts[s[0], s[1]]) == 1]
        if stuck:
            counts |= _bucket_counts(long, stuck, first, ends=True)
        narrower: dict[str, list] = {}
        for m, i, *_ in specs:
            _, _, before, ranks = open_[m][i]
            for low, high, n in counts[m, i]:
                inside = [k for k in ranks if before <= k < before + n]
                if inside:
                    narrower.setdefault(m, []).append((low, high, before, inside))
                before += n
        open_, first = narrower, False


def _bucket_counts(long: DataFrame, specs: list[tuple], bent: bool, ends: bool = False) -> dict[tuple[str, int], list[tuple]]:
    """For each interval (metric, number, low, high, scale) its buckets in order: smallest and largest value, and rows."""
    table = long.sparkSession.createDataFrame(specs, "metric string, part int, low double, high double, scale double")
    rows = long.join(F.broadcast(table), "metric").where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))

    def place(name: str) -> Column:
        value = F.col(name)
        if not bent:
            return value
        unit = F.when(F.col("scale").between(1e-300, 1e300), F.col("scale")).otherwise(1.0)
        return F.greatest(F.lit(-BEYOND), F.least(F.lit(BEYOND), F.asinh(value / unit)))

    share = (place("value") - place("low")) / (place("high") - place("low"))
    bucket = F.least(F.floor(F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(0.0)) * QUANTILE_BUCKETS), F.lit(QUANTILE_BUCKETS - 1)).cast("bigint")
    bucket = F.when(place("high") > place("low"), bucket).otherwise(F.lit(0))
    if ends:
        bucket = F.when(F.col("value") == F.col("low"), 0).when(F.col("value") == F.col("high"), 2).otherwise(1).cast("bigint")
    sums = rows.groupBy("metric", "part", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    out: dict[tuple[str, int], list[tuple]] = {(m, i): [] for m, i, *_ in specs}
    # at most QUANTILE_BUCKETS rows an interval, and six intervals a metric
    for r in sums.orderBy("metric", "part", "bucket").collect():
        out[r["metric"], r["part"]].append((r["low"], r["high"], r["n"]))
    return out


def channel_counts(raw: DataFrame, pattern: str | None = None) -> DataFrame:
    """Messages per channel."""
    hits = raw.where(F.col("source_type") == "channel")
    if pattern is not None:
        hits = hits.where(glob_match(F.col("key"), pattern))
    return hits.groupBy("key").agg(F.count("*").alias("messages"))


def operation_counts(notifications: DataFrame) -> DataFrame:
    """Notifications per ``operation:key``, ordered by it."""
    event = F.concat_ws(":", "operation", "key").alias("event")
    return notifications.groupBy(event).agg(F.count("*").alias("times")).orderBy("event")


def key_categories(keys: DataFrame, categories: dict[str, str], samples: int = 3) -> DataFrame:
    """Distinct keys per named glob (0 where there are none) and the first few of them, in one text.

    Only ``samples`` keys per task and category reach the shuffle that picks them.
    """
    entries = F.array(
        *[F.when(glob_match(F.col("key"), glob), F.lit(name)) for name, glob in categories.items()]
    )
    named = (
        keys.select("key", F.explode(F.array_compact(entries)).alias("category"))
        .distinct()
    )
    counts = named.groupBy("category").agg(F.count("*").alias("key_count"))
    heads = first_n(named, ["category"], [F.col("key")], samples)
    examples = heads.groupBy("category").agg(
        F.array_join(F.sort_array(F.collect_list("key")), ",").alias("examples")
    )
    # one row per category, and categories are an argument
    every = _names(keys, list(categories), "category")
    found = counts.join(F.broadcast(examples), "category")
    return every.join(found, "category", "left").withColumn("key_count", F.coalesce("key_count", F.lit(0).cast("bigint")))


def _names(df: DataFrame, names: list[str], column: str) -> DataFrame:
    """A row for each name, so that names without rows are reported too."""
    return df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, names))).alias(column))


def channel_discovery(raw: DataFrame, excluded: list[str]) -> DataFrame:
    """Messages and channels seen, and messages held back by excluded parts."""
    held = any_part(F.col("key"), excluded)
    return raw.where(F.col("source_type") == "channel").agg(
        F.count_if(~held).alias("messages"),
        F.count_if(held).alias("filtered"),
        F.countDistinct(F.when(~held, F.col("key"))).alias("channels"),
    )


def discovered_channels(raw: DataFrame, excluded: list[str]) -> DataFrame:
    """The distinct channels that are not excluded, sorted."""
    seen = raw.where((F.col("source_type") == "channel") & ~any_part(F.col("key"), excluded))
    return seen.select(F.col("key").alias("channel")).distinct().orderBy("channel")


def prefix_counts(df: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Rows and distinct values per text prefix, 0 where there are none."""
    entries = F.array(*[F.when(F.col(column).startswith(p), F.lit(p)) for p in prefixes])
    named = df.select(F.col(column).alias("value"), F.explode(F.array_compact(entries)).alias("prefix"))
    found = named.groupBy("prefix").agg(
        F.count("*").alias("row_count"), F.countDistinct("value").alias("unique_values")
    )
    return _names(df, prefixes, "prefix").join(found, "prefix", "left").na.fill(0)


def resample_mean(df: DataFrame, column: str = "heart_rate") -> DataFrame:
    """Mean per minute from the first to the last event, empty minutes included as null.

    Minutes are laid out day by day, so no row holds the whole range.
    """
    minute = F.date_trunc("minute", F.col(TS))
    means = df.groupBy(minute.alias("minute")).agg(F.avg(column).alias("mean_value"))
    ends = df.agg(F.min(minute).alias("a"), F.max(minute).alias("b"))
    day, one = F.date_trunc("day", "a"), F.make_interval(days=F.lit(1))
    grid = (
        ends.where("a is not null")
        .select("a", "b", F.explode(F.sequence(day, F.col("b"), one)).alias("d"))
        .select("a", "b", "d", F.explode(F.sequence(F.lit(0), F.lit(1439))).alias("m"))
        .select("a", "b", (F.col("d") + F.make_interval(mins=F.col("m"))).alias("minute"))
        .where(F.col("minute").between(F.col("a"), F.col("b")))
        .select("minute")
    )
    return grid.join(means, "minute", "left")


def reconcile(expected: DataFrame, found: DataFrame, key: str = "key") -> DataFrame:
    """Distinct keys that are ``matched``, ``missed`` or ``wrong`` (found, not expected)."""
    both = expected.select(key, F.lit(1).alias("e"), F.lit(0).alias("f")).unionByName(
        found.select(key, F.lit(0).alias("e"), F.lit(1).alias("f"))
    )
    seen = both.groupBy(key).agg(F.max("e").alias("e"), F.max("f").alias("f"))
    return seen.select(
        key,
        F.when((F.col("e") == 1) & (F.col("f") == 1), "matched")
        .when(F.col("e") == 1, "missed")
        .otherwise("wrong")
        .alias("status"),
    )


def windowed_assembly(
    df: DataFrame, rules: dict[str, str], width: str = "5 seconds", watermark: str | None = None
) -> DataFrame:
    """Per device and time window, one value per column by its rule.

    Rules: ``average``, ``sum``, ``min``, ``max``, ``last``, ``first``. The same plan
    serves batch and stream (with a watermark).
    """

    def by(column: str, rule: str) -> Column:
        value = F.col(column)
        timed = F.when(value.isNotNull(), F.col(TS))
        return {
            "average": lambda: F.avg(value),
            "sum": lambda: F.sum(value),
            "min": lambda: F.min(value),
            "max": lambda: F.max(value),
            "last": lambda: F.max_by(value, timed),
            "first": lambda: F.min_by(value, timed),
        }[rule]().alias(column)

    if watermark:
        df = df.withWatermark(TS, watermark)
    return (
        df.groupBy(F.window(TS, width), "device_id")
        .agg(*[by(c, r) for c, r in rules.items()], F.count("*").alias("source_rows"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "device_id", *rules, "source_rows",
        )
    )
