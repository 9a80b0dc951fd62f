"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``SLOTS`` places. Every shard has several virtual nodes on it; a key goes to the
first one clockwise from its own place (its home arc). A shard takes no more rows than its
bound; the keys of an arc that find their shard full continue clockwise to the next virtual
node whose shard has room. With load factor 1 the bounds add up to the number of rows, so every
shard is filled to its bound and the counts are at most one apart.

How many rows of each arc go where follows from the rows per arc alone, of which there are as
many as virtual nodes. Rows of an arc are ordered by a hash; within hash cells of bounded size
a window numbers them, and sums over the cells place the cells. So no task holds an arc.

* The key is the text, so equal texts share an arc and part only where a shard is full. Null
  and empty texts are keys like others. Rows without an id, and rows that repeat an id, are rows
  of their own; equal rows are told apart by their place in the input.
* An empty table gives an empty result; fewer rows than shards leave shards empty.
* Long texts are hashed, not moved.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import written

SLOTS = 1 << 16
VIRTUAL_NODES = 64
ROWS_PER_CELL = 1024


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(slot, shard) of every virtual node, clockwise. More shards leave the earlier ones' nodes where they are."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            slot = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8], "big") % SLOTS
            taken.setdefault(slot, shard)
    return sorted(taken.items())


def bounds(rows: int, shards: int, load_factor: float) -> list[int]:
    """Each shard's most rows; with factor 1 they add up to ``rows``."""
    if load_factor <= 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [math.ceil(load_factor * rows / shards)] * shards


def allot(loads: list[int], owners: list[int], room: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each arc the runs (first rank, one past the last, shard) of its rows.

    In round r every arc offers what it has left to the r-th virtual node clockwise; arcs are served in ring order.
    """
    left, runs, room = list(loads), [[] for _ in loads], list(room)
    for step in range(len(owners)):
        if not any(left):
            break
        for arc, rest in enumerate(left):
            shard = owners[(arc + step) % len(owners)]
            take = min(rest, room[shard])
            if take:
                done = loads[arc] - rest
                runs[arc].append((done, done + take, shard))
                left[arc] -= take
                room[shard] -= take
    return runs


def assign(
    docs: DataFrame, shards: int, key: Column, load_factor: float = 1.0, virtual_nodes: int = VIRTUAL_NODES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; ``key`` is over ``doc_id`` and ``text``."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    place = F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")
    nth = F.monotonically_increasing_id()
    keyed = rows.select(
        "doc_id", (F.octet_length(raw) + F.lit(16)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        place.alias("place"), F.xxhash64("doc_id", F.crc32(raw), nth).alias("turn"), nth.alias("nth"),
    )
    keyed = written(keyed, "ring-keys")

    nodes = ring(shards, virtual_nodes)
    at = [slot for slot, _ in nodes]
    # one row for each slot of the ring: a table of fixed size
    arcs = spark.createDataFrame([(p, bisect_left(at, p) % len(nodes)) for p in range(SLOTS)], "place int, arc int")
    loads = [0] * len(nodes)
    for r in keyed.join(F.broadcast(arcs), "place").groupBy("arc").agg(F.count("*").alias("n")).collect():
        loads[r.arc] = r.n
    # one row for each virtual node
    cells = spark.createDataFrame([(a, max(1, math.ceil(n / ROWS_PER_CELL))) for a, n in enumerate(loads)], "arc int, cells int")
    placed = keyed.join(F.broadcast(arcs.join(F.broadcast(cells), "arc")), "place")
    placed = placed.withColumn("cell", F.pmod("turn", F.col("cells")).cast("int"))
    sizes = written(placed.groupBy("arc", "cell").agg(F.count("*").alias("n")), "ring-cells")
    runs, filled, table = allot(loads, [s for _, s in nodes], bounds(sum(loads), shards, load_factor)), [0] * shards, []
    for arc, parts in enumerate(runs):
        for first, end, shard in parts:
            table.append((arc, first, end, shard, filled[shard]))
            filled[shard] += end - first
    runs_df = spark.createDataFrame(table, "arc int, first long, last long, shard int, base long")

    earlier = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("arc", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("arc", "cell").orderBy("turn", "nth")) - 1
    ranked = placed.withColumn("inner", inner).join(starts, ["arc", "cell"]).withColumn("rank", F.col("before") + F.col("inner"))
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    # at most one run for each virtual node and shard: bounded by the ring
    return ranked.join(F.broadcast(runs_df), "arc").filter(inside).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot")
    )
