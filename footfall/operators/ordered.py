"""Looking at the rows before and after, without one task per key.

``lag``/``lead``/``last`` over ``partitionBy(key)`` put a whole key into one task.
A key may hold a third of all rows, so above a size limit these operators cut the
ordered rows of *heavy* keys into slices:

1. count rows per key (map-side combined, key and position columns only), write the
   counts, and keep the heavy keys, null included, with the cut points that part their rows
   evenly (quantiles of the position); without heavy keys the plain window is safe and is used,
2. run the window inside (key, slice),
3. reduce every slice of a heavy key to its edge row, run the window over the edges
   and hand the result to the slice's outermost row.

The result equals the plain window. Light keys have one slice and no edges.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.session import plan_bytes, written

# Below this size the whole input fits one task, so no key can be too big.
WHOLE_INPUT_BYTES = 256 << 20
# Rows a slice of a heavy key should have.
SLICE_ROWS = 2_000_000
# A heavy key has more than 1/HEAVY_KEYS of all rows, so there are fewer than
# HEAVY_KEYS of them, whatever the size of the table.
HEAVY_KEYS = 50_000

# Quantiles that cut points are chosen from; a key has at most so many slices.
STEPS = 1024

# Up to this n Spark cuts each group before the shuffle; tasks per key beyond it.
GROUP_LIMIT, PARTS = 1_000, 64

PLAIN = 0


def choose_slicing(df: DataFrame, slice_rows: int | None) -> int:
    """Rows per slice, or PLAIN when the input is small enough for plain windows."""
    if slice_rows is not None:
        return slice_rows
    return PLAIN if plan_bytes(df) <= WHOLE_INPUT_BYTES else SLICE_ROWS


def settled(df: DataFrame, slice_rows: int, name: str) -> DataFrame:
    """Big intermediate results are written, as slicing reads its input several times."""
    return df if slice_rows == PLAIN else written(df, name)


def heavy_keys(df: DataFrame, keys: list[str], position: Column, slice_rows: int) -> DataFrame:
    """Heavy keys with the positions at which their slices begin (fewer than HEAVY_KEYS rows)."""
    counts = written(df.groupBy(*keys).agg(F.count("*").alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    many = counts.where((F.col("_n") > slice_rows) & (F.col("_n") > F.lit(total // HEAVY_KEYS)))
    if many.isEmpty():
        return many.select(*keys, F.lit(None).cast("array<long>").alias("_cuts"))
    fractions = F.array(*[F.lit(i / STEPS) for i in range(1, STEPS)])
    at = df.select(*keys, position.cast("long").alias("_at"))
    steps = _with_key(at, keys, many, "inner").groupBy(*keys, "_n").agg(
        F.percentile_approx("_at", fractions, F.lit(10 * STEPS)).alias("_q")
    )
    slices = F.least(F.lit(STEPS), F.ceil(F.col("_n") / F.lit(slice_rows))).cast("int")
    chosen = F.transform(
        F.sequence(F.lit(1), slices - 1), lambda i: F.get("_q", (i * STEPS / slices).cast("int") - 1)
    )
    cuts = F.when(slices > 1, F.array_distinct(chosen)).otherwise(F.array().cast("array<long>"))
    return written(steps.select(*keys, cuts.alias("_cuts")), "heavy-keys")


def _with_key(df: DataFrame, keys: list[str], side: DataFrame, how: str) -> DataFrame:
    """Joins a side of few rows, one per key, null keys included."""
    named = side.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(F.broadcast(named), same, how).drop(*[f"_key_{k}" for k in keys])


def with_slices(df: DataFrame, keys: list[str], position: Column, heavy: DataFrame) -> DataFrame:
    """Adds ``_slice``: null for light keys, else the slice number within the key."""
    at = position.cast("long")
    number = F.size(F.filter("_cuts", lambda c: c < at)).cast("long")
    joined = _with_key(df, keys, heavy, "left")
    return joined.withColumn("_slice", F.when(F.col("_cuts").isNotNull(), number)).drop("_cuts")


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    position: Column,
    prev: dict[str, str] | None = None,
    next: dict[str, str] | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Adds columns of the row before (``prev``) and after (``next``) within the key.

    ``prev`` and ``next`` map new column name to source column. ``order`` must be a
    total order and ``position`` a long that never falls along it. Rows whose key is
    null form one more key, as in a window.
    """
    prev, next = prev or {}, next or {}
    slice_rows = choose_slicing(df, slice_rows)
    heavy = None if slice_rows == PLAIN else heavy_keys(df, keys, position, slice_rows)
    if heavy is None or heavy.isEmpty():
        w = W.partitionBy(*keys).orderBy(*order)
        return df.select(
            "*",
            *[F.lag(c).over(w).alias(n) for n, c in prev.items()],
            *[F.lead(c).over(w).alias(n) for n, c in next.items()],
        )

    sliced = with_slices(df, keys, position, heavy)
    w = W.partitionBy(*keys, "_slice").orderBy(*order)
    sides = [s for s in (("prev", prev, F.lag, F.max_by), ("next", next, F.lead, F.min_by)) if s[1]]
    moved = []
    for side, columns, move, _ in sides:
        moved.append(move(F.lit(True)).over(w).alias(f"_{side}_here"))
        moved += [move(c).over(w).alias(n) for n, c in columns.items()]
    inner = sliced.select("*", *moved)

    # One row per slice of a heavy key: its last row (for lag) and first row (for lead).
    edges = (
        sliced.where(F.col("_slice").isNotNull())
        .groupBy(*keys, "_slice")
        .agg(*[pick(_row(cols), _row(order)).alias(f"_{s}_out") for s, cols, _, pick in sides])
    )
    across = W.partitionBy(*keys).orderBy("_slice")
    edges = edges.select(
        *keys,
        "_slice",
        *[move(f"_{s}_out").over(across).alias(f"_{s}_in") for s, _, move, _ in sides],
    )
    filled = [
        F.when(F.col(f"_{s}_here"), F.col(n)).otherwise(F.col(f"_{s}_in").getField(_field(i))).alias(n)
        for s, cols, _, _ in sides
        for i, n in enumerate(cols)
    ]
    return _with_key(inner, [*keys, "_slice"], edges, "left").select(*df.columns, *filled)


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    position: Column,
    value: str,
    out: str,
    slice_rows: int | None = None,
) -> DataFrame:
    """Adds the last non-null ``value`` at or before each row of the key."""
    slice_rows = choose_slicing(df, slice_rows)
    upto = (W.unboundedPreceding, W.currentRow)
    heavy = None if slice_rows == PLAIN else heavy_keys(df, keys, position, slice_rows)
    if heavy is None or heavy.isEmpty():
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(w))

    sliced = with_slices(df, keys, position, heavy)
    w = W.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(*upto)
    inner = sliced.withColumn(out, F.last(value, ignorenulls=True).over(w))
    ends = (
        sliced.where(F.col("_slice").isNotNull())
        .groupBy(*keys, "_slice")
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), _row(order))).alias("_end"))
    )
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(before).alias("_in"))
    joined = _with_key(inner, [*keys, "_slice"], ends, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("_in"))).select(*df.columns, out)


# Cut points that are compared at a time, so that a row looks at few of them.
BLOCK = 32


def even_slices(times: DataFrame, column: str, slice_rows: int) -> Callable[[str], Column]:
    """A function from a timestamp column's name to its slice number, which never falls with time.

    Up to ``STEPS`` cut points part the rows of ``times`` evenly, however bursty they come; where a slice would
    have more than ``slice_rows`` rows it is parted further into equal stretches of time. Equal times
    share a slice. Cut points are looked up when this is called: at most ``STEPS`` + 1 numbers.
    """
    fractions = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    found = times.agg(F.count(column).alias("n"), F.percentile_approx(F.unix_micros(column), fractions, F.lit(10 * STEPS)).alias("q")).first()
    cuts = sorted(set(found["q"] or []))
    more = max(1, -(-found["n"] // (STEPS * slice_rows)))

    def numbers(values: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(values)), kind)

    heads = numbers(cuts[::BLOCK], "array<bigint>")
    blocks = numbers([cuts[i : i + BLOCK] for i in range(0, len(cuts), BLOCK)], "array<array<bigint>>")
    flat = numbers(cuts, "array<bigint>")

    def number(name: str) -> Column:
        at = F.unix_micros(name)
        block = F.size(F.filter(heads, lambda c: c <= at))
        inside = F.size(F.filter(F.get(blocks, block - 1), lambda c: c <= at))
        passed = F.when(block > 0, (block - 1) * BLOCK + inside).otherwise(0)
        slice_no = passed.cast("bigint") * more
        if more == 1:
            return slice_no
        low, high = F.get(flat, passed - 1), F.get(flat, passed)
        return slice_no + F.coalesce(F.floor((at - low) * more / (high - low)).cast("bigint"), F.lit(0).cast("bigint"))

    return number


def latest_rows(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """All rows at the newest ``ts`` of their key (ties are kept).

    ``rank() = 1`` lets Spark drop all but the leading rows on the map side, so the
    shuffle carries about one row per key and task.
    """
    w = W.partitionBy(*keys).orderBy(F.col(ts).desc())
    return df.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key.

    Up to ``GROUP_LIMIT`` Spark drops all but n per task before the shuffle. For larger ``n``
    each key is first dealt to ``PARTS`` tasks, which keep n rows each.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    if n > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind]), F.lit(PARTS))
        by_part = W.partitionBy(*keys, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_rn", F.row_number().over(by_part)).where(F.col("_rn") <= n).drop("_part", "_rn")
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def _field(i: int) -> str:
    return f"f{i}"


def _row(cols) -> Column:
    """A struct of the columns named by a dict's values or a list, with plain field names."""
    names = list(cols.values()) if isinstance(cols, dict) else list(cols)
    return F.struct(*[F.col(c).alias(_field(i)) for i, c in enumerate(names)])
