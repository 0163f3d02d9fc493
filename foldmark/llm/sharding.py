"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A row's key hashes to a slot of the ring; the first virtual node at or after the slot names its shard. A shard takes
no more rows than its capacity: what overflows goes on clockwise to the next shard with room. With ``slack`` 0
the capacities are n/shards rounded down or up, so row counts differ by one at most; more slack moves fewer rows
when the number of shards changes.

The rows of a slot have a set order, so the ring is settled on counts alone: at most ``RING`` counts, whatever the
table's size, become intervals of ranks per slot, and a row finds its shard and its place there from its rank.
Equal rows are counted before any shuffle and are dealt out again at the end.

Defined results: a null text has size 16 and the checksum of no bytes; null keys hash like a value; equal
rows each get a place; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RING = 1 << 16
VIRTUAL_NODES = 128
ROW_BYTES = 16
#: Equal rows are dealt out again in runs of this many.
RUN = 1 << 16


def ring_points(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(slot, shard) of every virtual node, clockwise. A shard's nodes don't depend on how many shards there are."""
    points = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = int.from_bytes(hashlib.md5(f"{shard}:{node}".encode()).digest()[:8], "big")
            points.append((digest % RING, digest, shard))
    return [(slot, shard) for slot, _, shard in sorted(points)]


def capacities(n: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack > 0:
        return [int(-(-n * (1 + slack) // shards))] * shards
    return [n // shards + (s < n % shards) for s in range(shards)]


def settle_ring(counts: dict[int, int], shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES) -> dict[int, list[tuple[int, int, int]]]:
    """Per slot the intervals of its ranks: (first rank beyond, shard, place in the shard less rank).

    Rounds: all slots offer what they have left to the shard they point at, clockwise; a shard with too little room
    takes the first of it and the rest points at the next shard with room. A shard is filled by one interval
    only, so there are at most as many intervals as slots and shards together.
    """
    points = ring_points(shards, virtual_nodes)
    slots = [slot for slot, _ in points]
    room = capacities(sum(counts.values()), shards, slack)
    filled = [0] * shards
    intervals: dict[int, list[tuple[int, int, int]]] = {}
    waiting = [(slot, 0, bisect.bisect_left(slots, slot) % len(points)) for slot in sorted(counts)]
    while waiting:
        overflow = []
        for slot, done, at in waiting:
            shard = points[at][1]
            take = min(counts[slot] - done, room[shard])
            if take:
                intervals.setdefault(slot, []).append((done + take, shard, filled[shard] - done))
                filled[shard] += take
                room[shard] -= take
            if done + take < counts[slot]:
                overflow.append((slot, done + take, (at + 1) % len(points)))
        waiting = overflow
    return intervals


def shard_rows(rows: DataFrame, shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Adds ``shard`` and ``slot`` (the place in the shard, gapless from 0) to rows of hashable columns."""
    columns = rows.columns
    keyed = rows.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_hash", F.xxhash64(*columns))
    keyed = keyed.withColumn("_ring", F.pmod(F.shiftrightunsigned("_hash", 32), F.lit(RING)).cast("int"))
    counts = {r["_ring"]: r["n"] for r in keyed.groupBy("_ring").agg(F.sum("_n").alias("n")).collect()}
    plan = [(slot, found) for slot, found in settle_ring(counts, shards, slack, virtual_nodes).items()]
    intervals = rows.sparkSession.createDataFrame(plan, "_ring int, _parts array<struct<upto: long, shard: int, shift: long>>").coalesce(1)

    before = Window.partitionBy("_ring").orderBy("_hash", *columns).rowsBetween(Window.unboundedPreceding, -1)
    ranked = keyed.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # At most RING rows: the plan's size does not depend on the table's.
    placed = ranked.join(F.broadcast(intervals), "_ring")
    last = F.col("_first") + F.col("_n") - 1
    runs = placed.withColumn("_run", F.explode(F.sequence("_first", last, F.lit(RUN).cast("long"))))
    each = runs.withColumn("_rank", F.explode(F.sequence("_run", F.least(F.col("_run") + RUN - 1, last))))
    part = F.filter("_parts", lambda p: F.col("_rank") < p["upto"])[0]
    found = each.withColumn("_part", part)
    return found.select(*columns, F.col("_part.shard").alias("shard"), (F.col("_rank") + F.col("_part.shift")).alias("slot"))


def _utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(_utf8(F.col("text"))) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(_utf8(F.col("text"))).alias("text_crc32"),
    )
    placed = shard_rows(rows, shards)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)
