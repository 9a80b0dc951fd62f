"""Sliced windows give what plain windows give, also when one key holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import bag
from footfall.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows, a third of them of one key; some null values; a null key."""
    rng = random.Random(5)
    rows = []
    for i in range(2000):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", "d", None])
        rows.append((i, key, rng.choice([None, rng.randrange(9)]), rng.randrange(5)))
    return spark.createDataFrame(rows, "seq bigint, key string, v int, w int").persist()


@pytest.mark.parametrize("slice_rows", [1, 7, 100, 5000])
def test_neighbours(skewed, slice_rows):
    def run(n):
        return ordered.neighbours(
            skewed, ["key"], ["seq"], F.col("seq"),
            prev={"pv": "v", "pw": "w"}, next={"nv": "v", "ns": "seq"}, slice_rows=n,
        )

    columns = ["seq", "key", "v", "w", "pv", "pw", "nv", "ns"]
    assert run(slice_rows).columns == columns
    assert bag(run(slice_rows).collect(), columns) == bag(run(ordered.PLAIN).collect(), columns)


@pytest.mark.parametrize("slice_rows", [1, 7, 100, 5000])
def test_carry_forward(skewed, slice_rows):
    def run(n):
        return ordered.carry_forward(skewed, ["key"], ["seq"], F.col("seq"), "v", "last_v", n)

    columns = ["seq", "key", "v", "w", "last_v"]
    assert bag(run(slice_rows).collect(), columns) == bag(run(ordered.PLAIN).collect(), columns)


def test_slices_are_small_and_only_for_heavy_keys(skewed):
    heavy = ordered.heavy_keys(skewed, ["key"], F.col("seq"), 300)
    assert [r["key"] for r in heavy.collect()] == ["hot"]
    assert None in [r["key"] for r in ordered.heavy_keys(skewed, ["key"], F.col("seq"), 100).collect()]
    sliced = ordered.with_slices(skewed, ["key"], F.col("seq"), heavy)
    sizes = {(r["key"], r["_slice"]): r["count"] for r in sliced.groupBy("key", "_slice").count().collect()}
    hot = [n for (key, number), n in sizes.items() if key == "hot"]
    assert len(hot) >= 3 and max(hot) < 400
    assert all(number is None for key, number in sizes if key != "hot")


def test_a_burst_is_cut_by_rows_not_by_time(spark):
    """Nearly all rows of a key, and of the null key, come within a moment of a long time."""
    rows = [(i * 1_000_000_000 if i % 100 == 0 else i, "k" if i % 2 else None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "seq bigint, key string").persist()
    heavy = ordered.heavy_keys(df, ["key"], F.col("seq"), 1000)
    sizes = ordered.with_slices(df, ["key"], F.col("seq"), heavy).groupBy("key", "_slice").count().collect()
    assert len(sizes) >= 18 and max(r["count"] for r in sizes) <= 2000 and all(r["_slice"] is not None for r in sizes)


def test_equal_positions_stay_in_one_slice(spark):
    rows = [(i // 50, i, "k") for i in range(1000)]
    df = spark.createDataFrame(rows, "t bigint, id bigint, key string")

    def run(n):
        return ordered.neighbours(df, ["key"], ["t", "id"], F.col("t"), prev={"p": "id"}, slice_rows=n)

    assert bag(run(60).collect(), ["id", "p"]) == bag(run(0).collect(), ["id", "p"])


def test_size_decides(spark, skewed):
    assert ordered.choose_slicing(spark.range(10), None) == ordered.PLAIN
    assert ordered.choose_slicing(spark.range(1 << 40), None) == ordered.SLICE_ROWS
    assert ordered.choose_slicing(spark.range(10), 5) == 5


def test_first_n_beyond_sparks_own_limit(spark):
    df = spark.range(9000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    got = ordered.first_n(df, ["k"], [F.desc("v")], 1500)
    assert sorted(r["v"] for r in got.collect()) == list(range(4500, 9000))


def test_latest_rows_keep_ties_and_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 5, 4)], "k string, t int, id int")
    latest = ordered.latest_rows(df, ["k"], "t")
    assert sorted(r["id"] for r in latest.collect()) == [2, 3, 4]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange"):]
