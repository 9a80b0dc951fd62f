"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import written


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and an order-free checksum: equal for equal edge sets."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.shiftright(F.xxhash64("a", "b"), 16)).alias("h")).first()
    return row.n, row.h or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node that it reaches.

    Every step maps each node's neighbours to the smallest of them; the per-node minimum is
    aggregated before the shuffle, so a node with very many links is no burden. The table of each
    round is written, which cuts the lineage. It ends when a round changes nothing: each node
    then links to its component's smallest node alone.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        )
        now = written(small, "links")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
