"""The trie of shared beginnings of conversations, from padded matrices of turn ids over range shards.

A turn's id is a hash of 128 bits of its role and text; a conversation's key is its turns' ids on end, so that keys in order
are the trie in preorder and every node is a stretch of rows.

1. ``rebuild`` gives every conversation its turns. Keys are dealt to shards by ranges of (key, conv_id), so that
   conversations that are equal throughout, however many, fall into several shards.
2. A shard goes through its rows in blocks of at most CELLS cells. A block's keys become a matrix of turn ids, padded with
   -1; ``lexsort`` orders its rows, the change mask of each column against the row before, OR-accumulated over the columns,
   marks where nodes start, and ``reduceat`` between the marks gives a depth's members, children, leaves and savings.
3. Nodes of a block's first or last row may go on in the next one: these give partial sums, under a hash of their
   beginning. All sums count what starts or ends in a row, taking a block's first row as all new and its last one as
   ending a leaf; where neighbouring blocks share a beginning, rows with the difference set that right. Between shards
   these come from the shards' first and last keys, a row a shard. Then partial sums are added.
4. A node inside a block has its parent's number at hand, or the hash of a parent that goes beyond the block: such rows join
   the added nodes, under salts, since the root and other large nodes have any number of children.

Defined results: rows without ``conv_id`` take no part; null role or text is empty; turns go by number, null first, and of
equal numbers by the hash of role and text; rows that are equal are separate turns; a conversation of any length is one row
of its shard and, if longer than CELLS, one block; an empty table has no nodes; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmark.llm import sql
from foldmark.llm.common import arrow_rows
from foldmark.session import cut_lineage

FAMILY, DONATED = 5, 9
CELLS = 1 << 20
SALTS = 32
ID_BYTES = 16

FOUND = (
    "kind int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, shard int, block int, ids binary, key binary, sizes binary"
)
#: Finished nodes, sums of parts of nodes, members of parts of nodes, ends of shards.
WHOLE, PART, IDS, EDGE = range(4)
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NOBODY = hashlib.sha256(b"").hexdigest()


def family_of(conv_id: Column, family: int = FAMILY) -> Column:
    return conv_id - conv_id % family


def donated_to(conv_id: Column, most: int = DONATED) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % most


def rebuild(conversations: DataFrame, family: int = FAMILY, most: int = DONATED) -> DataFrame:
    """(conv_id, key, sizes) of every conversation: its turns' ids on end and the UTF-8 bytes of their texts.

    One shuffle by family: numbering, giving and collecting all keep to it.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.octet_length(text).alias("size"),
    )
    dealt = turns.withColumn("base", family_of(F.col("conv_id"), family)).repartition("base")
    in_order = Window.partitionBy("base", "conv_id").orderBy(F.asc_nulls_first("turn"), "id")
    placed = dealt.withColumn("place", F.row_number().over(in_order) - 1)
    near = F.transform(F.sequence(F.lit(1 - family), F.lit(family - 1)), lambda i: F.col("base") + i)
    takers = F.filter(
        near,
        lambda c: (c == F.col("conv_id"))
        | ((family_of(c, family) == F.col("base")) & (F.col("place") < donated_to(c, most))),
    )
    given = placed.withColumn(
        "taker", F.explode(F.when(F.col("conv_id") == F.col("base"), takers).otherwise(F.array("conv_id")))
    )
    own = F.col("conv_id") == F.col("taker")
    kept = ~own | (F.col("taker") == F.col("base")) | (F.col("place") >= donated_to(F.col("taker"), most))
    grouped = given.groupBy("base", "taker").agg(
        F.max(own).alias("exists"), F.sort_array(F.collect_list(F.when(kept, F.struct("place", "id", "size")))).alias("turns")
    )
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    sizes = F.transform("turns", lambda t: t["size"])
    return grouped.where("exists").select(F.col("taker").alias("conv_id"), key.alias("key"), sizes.alias("sizes"))


def beginnings(key: bytes, depth: int) -> list[bytes]:
    """Hashes of the first 0, 1, ... turns."""
    state = hashlib.md5()
    out = [state.digest()]
    for d in range(depth):
        state.update(key[d * ID_BYTES : (d + 1) * ID_BYTES])
        out.append(state.copy().digest())
    return out


def shared_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // ID_BYTES
    x, y = (np.frombuffer(k[: n * ID_BYTES], "u1").reshape(n, ID_BYTES) for k in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def row(kind: int, **values) -> tuple:
    return tuple(kind if name == "kind" else values.get(name) for name in (c.split()[0] for c in FOUND.split(", ")))


def seam(last: bytes, key: bytes, sizes: np.ndarray) -> Iterator[tuple]:
    """What neighbouring blocks counted too much or too little of the nodes that both have: the last and the first key meet here."""
    shared = shared_turns(last, key)
    hashes = beginnings(key, shared)
    left_of = np.concatenate([np.cumsum(sizes[:shared][::-1], dtype="i8")[::-1], np.zeros(1, "i8")])
    ended = len(last) // ID_BYTES == shared
    for d in range(shared + 1):
        yield row(
            PART, node=hashes[d], parent=hashes[d - 1] if d else None, depth=d, n_convs=0, n_children=-int(d < shared),
            n_leaves=-int(ended), saved_tokens=int(left_of[max(d - 1, 0)]),
        )


class Block:
    """Rows of neighbouring keys as a padded matrix in order, with the marks of where nodes start."""

    def __init__(self, keys: pa.Array, convs: np.ndarray, sizes: pa.Array):
        keys = keys.to_pylist()
        depth = np.array([len(k) // ID_BYTES for k in keys], "i8")
        self.n, self.depths = len(keys), int(depth.max())
        at, column = np.repeat(np.arange(self.n), depth), np.arange(depth.sum()) - np.repeat(np.cumsum(depth) - depth, depth)
        halves = np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2).astype("u8")
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        ids = np.empty(len(order), "i8")
        ids[order] = np.cumsum(np.append(False, (halves[order][1:] != halves[order][:-1]).any(axis=1)))[: len(order)]
        turns = np.full((self.n, self.depths), -1, "i8")
        turns[at, column] = ids
        size = np.zeros((self.n, self.depths), "i8")
        size[at, column] = pc.list_flatten(sizes).to_numpy(zero_copy_only=False)

        order = np.lexsort((convs, *turns.T[::-1]))
        self.convs, self.depth, self.keys, self.turns = convs[order], depth[order], [keys[i] for i in order], turns[order]
        self.first_sizes = size[order[0], : self.depth[0]]
        change = np.ones((self.n, self.depths), bool)
        change[1:] = self.turns[1:] != self.turns[:-1]
        self.new = np.logical_or.accumulate(change, axis=1)
        self.start = self.new & (self.turns >= 0)
        repeated = np.where(self.start, 0, size[order])
        self.saved = np.cumsum(repeated[:, ::-1], axis=1)[:, ::-1]
        below = np.minimum(self.depth[:-1], 1) * self.new[np.arange(1, self.n), self.depth[:-1] - 1] if self.depths else np.zeros(self.n - 1)
        self.leaf = np.append(below, 1).astype("i8")

    def nodes(self, shard: int, block: int) -> Iterator[tuple]:
        first, last = (beginnings(self.keys[i], int(self.depth[i])) for i in (0, -1))
        at, least, edge = np.zeros(1, "i8"), None, None
        for d in range(self.depths + 1):
            above, above_least, above_edge = at, least, edge
            at = np.flatnonzero(self.new[:, d - 1]) if d else np.zeros(1, "i8")
            n = np.diff(np.append(at, self.n))
            least = np.minimum.reduceat(self.convs, at)
            children = np.add.reduceat(self.start[:, d].astype("i8"), at) if d < self.depths else np.zeros(len(at), "i8")
            leaves = np.add.reduceat(self.leaf, at)
            saved = np.add.reduceat(self.saved[:, max(d - 1, 0)], at) if self.depths else np.zeros(len(at), "i8")
            ends = np.add.reduceat((self.depth == d).astype("i8"), at)
            edge = [None] * len(at)  # the hash of a node that may go on beyond the block
            if d <= self.depth[0]:
                edge[0] = first[d]
            if d <= self.depth[-1]:
                edge[-1] = last[d]
            held = np.flatnonzero(self.turns[at, d - 1] >= 0) if d else np.arange(1)
            up = np.searchsorted(above, at, "right") - 1
            for k in held.tolist():
                ids = ",".join(map(str, self.convs[at[k] : at[k] + ends[k]].tolist())).encode() if ends[k] else b""
                sums = {
                    "conv_id": int(least[k]), "depth": d, "n_convs": int(n[k]), "n_children": int(children[k]),
                    "n_leaves": int(leaves[k]), "saved_tokens": int(saved[k]),
                }
                parent = above_edge[up[k]] if d else None
                if edge[k] is None:
                    known = None if parent is not None else int(above_least[up[k]])
                    digest = hashlib.sha256(ids).hexdigest() if ids else NOBODY
                    yield row(WHOLE, parent=parent, parent_conv_id=known, ends_sha256=digest, **sums)
                else:
                    yield row(PART, node=edge[k], parent=parent, **sums)
                    if ids:
                        yield row(IDS, node=edge[k], shard=shard, block=block, ids=ids)


def blocks_of(batch: pa.RecordBatch, cells: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose padded matrix has at most ``cells`` cells, and one row at least."""
    depth = np.maximum(pc.binary_length(batch.column("key")).to_numpy(zero_copy_only=False) // ID_BYTES, 1).astype("i8")
    at = 0
    while at < batch.num_rows:
        area = np.maximum.accumulate(depth[at:]) * np.arange(1, len(depth) - at + 1)
        n = max(1, int(np.searchsorted(area, cells, "right")))
        yield batch.slice(at, n)
        at += n


def shard_rows(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[list[tuple]]:
    """Nodes, parts of nodes and the ends of one shard, from its rows in order."""
    number, opening, last, shard = 0, None, None, None
    for batch in batches:
        for part in blocks_of(batch, cells):
            shard = part.column("shard")[0].as_py()
            block = Block(part.column("key"), part.column("conv_id").to_numpy(), part.column("sizes"))
            rows = list(block.nodes(shard, number))
            if last is None:
                opening = (block.keys[0], block.first_sizes.astype("<i8").tobytes())
            else:
                rows += seam(last, block.keys[0], block.first_sizes)
            number, last = number + 1, block.keys[-1]
            yield rows
    if last is not None:
        yield [row(EDGE, shard=shard, key=opening[0], sizes=opening[1], node=last)]


def ends_of_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(node, SHA-256 of its members) of rows in order: members go into the digest as they come."""
    node, digest = None, None
    for batch in batches:
        out = []
        for this, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if this != node:
                out += [(node, digest.hexdigest())] if node is not None else []
                node, digest = this, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        yield out
    if node is not None:
        yield [(node, digest.hexdigest())]


def shard_seams(found: DataFrame) -> DataFrame:
    """The seams between shards; the order of shards is over a row a shard."""
    by_shard = Window.orderBy("shard")
    edges = found.where(F.col("kind") == EDGE).select("shard", "key", "sizes", F.lag("node").over(by_shard).alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for last, key, sizes in zip(*(batch.column(c).to_pylist() for c in ("last", "key", "sizes")), strict=True):
                yield arrow_rows(list(seam(last, key, np.frombuffer(sizes, "<i8"))), FOUND)

    return edges.where("last is not null").mapInArrow(run, FOUND)


def trie_nodes(conversations: DataFrame, family: int = FAMILY, most: int = DONATED, cells: int = CELLS, salts: int = SALTS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    keyed = cut_lineage(rebuild(conversations, family, most))
    return trie_of(keyed, cells, salts)


def trie_of(keyed: DataFrame, cells: int = CELLS, salts: int = SALTS) -> DataFrame:
    """The nodes of (conv_id, key, sizes)."""
    sorted_ = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def to_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in shard_rows(batches, cells):
            yield arrow_rows(rows, FOUND)

    def to_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ends_of_nodes(batches):
            yield arrow_rows(rows, "node binary, ends_sha256 string")

    found = cut_lineage(sorted_.withColumn("shard", F.spark_partition_id()).mapInArrow(to_nodes, FOUND))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = found.where(F.col("kind") == PART).unionByName(shard_seams(found))
    added = parts.groupBy("node").agg(F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), *sums)
    ids = found.where(F.col("kind") == IDS).select("node", "shard", "block", "ids")
    ends = ids.repartition("node").sortWithinPartitions("node", "shard", "block").mapInArrow(to_ends, "node binary, ends_sha256 string")
    added = cut_lineage(added.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOBODY))))

    names = added.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = found.where(F.col("kind") == WHOLE)
    inner = whole.where("parent is null").select(*COLUMNS)
    salted = whole.where("parent is not null").drop("parent_conv_id").withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(salts)))
    held = salted.join(names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>"))), ["parent", "salt"])
    return inner.unionByName(held.select(*COLUMNS)).unionByName(added.join(names, "parent", "left").select(*COLUMNS))


_ID = "md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))"

ORACLE_SQL = f"""
WITH {sql.CRC_TABLE},
turns AS (
  SELECT conv_id, {_ID} AS id, octet_length(encode(coalesce(text, ''))) AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_ID}) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {sql.crc32("conv_id::VARCHAR")} % {DONATED} AS h
  FROM (SELECT DISTINCT conv_id FROM turns) AS c, crc_table),
rebuilt AS (
  SELECT convs.conv_id, place, id, size FROM convs JOIN turns ON turns.conv_id = convs.base WHERE place < h
  UNION ALL SELECT conv_id, place, id, size FROM convs JOIN turns USING (conv_id) WHERE place >= h),
paths AS (
  SELECT conv_id, row_number() OVER in_order AS depth, string_agg(id, '') OVER in_order AS key, size FROM rebuilt
  WINDOW in_order AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
ends AS (SELECT conv_id, arg_max(key, depth) AS key FROM paths GROUP BY conv_id),
members AS (SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM ends GROUP BY key),
nodes AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM paths GROUP BY key, depth),
children AS (SELECT substr(key, 1, len(key) - 32) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (key)),
below AS (
  SELECT paths.key, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.size)::BIGINT AS saved_tokens
  FROM counted AS n JOIN paths ON paths.conv_id = n.conv_id AND paths.depth <= n.depth GROUP BY paths.key)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM counted AS n JOIN below USING (key) LEFT JOIN members USING (key)
LEFT JOIN nodes AS up ON n.depth > 0 AND up.key = substr(n.key, 1, len(n.key) - 32)
"""
