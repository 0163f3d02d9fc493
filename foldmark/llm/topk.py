"""Exact top-k inner products by the three-phase uniform threshold.

A vector's dimensions are cut into parts; a score is the sum of the parts' scores, and each part with each block of
vectors is a local list. Phase 1 gathers every local list's best entries and scores them in full: the k-th best
of a query, t, is met by k vectors at least. Phase 2 sends each query's cutoff out and collects every entry whose
part reaches t / parts: a vector with no such entry has a score below t. Phase 3 adds up what was collected,
leaves out who cannot reach t even if each missing part is just below the cutoff, and scores the rest exactly.

Equal vectors are one, named by its k + 1 smallest ids: no more of them can be among k results of a query,
its own id aside. Queries and vectors meet in blocks, dealt over a grid: a block of vectors goes to each block
of queries, each block of queries to each of a fixed number of lanes.

Defined results: components become floor(256 x) of x as double; vectors that are null, or hold null or non-finite
components, and rows with a null id take no part; vectors of different lengths are not compared; ties go to the smaller id; an
id's other rows are no candidates of its own query; queries with fewer candidates return all; an empty table
gives an empty one; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows
from foldmark.session import cut_lineage

SCALE = 256
PARTS = 2
ROW_BLOCK = 4096
QUERY_BLOCK = 1024
#: Blocks of vectors are dealt over this many lanes.
LANES = 48

BLOCK = "size int, dims int, ids binary, cutoffs binary, vectors binary"
ENTRY = "query long, node long, part int, score long"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): components as integers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE))
    return vectors.where(x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(node, v, ids, asks): each different vector once, its k + 1 smallest ids, whether a query has it."""
    w = Window.partitionBy("v", "q").orderBy("vec_id")
    few = rows.distinct().withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
    one = few.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"), F.max("q").alias("asks"))
    # A written table's row keeps its number.
    return cut_lineage(one.withColumn("node", F.monotonically_increasing_id()))


def in_blocks(nodes: DataFrame, block: int) -> DataFrame:
    """Rows (node, v[, cutoff]) packed into blocks of vectors of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, int, list[int]]]] = {}

        def packed(dims: int) -> pa.RecordBatch:
            ids, cutoffs, vectors = zip(*held.pop(dims), strict=True)
            arrays = (np.array(x, "i8").tobytes() for x in (ids, cutoffs, vectors))
            return arrow_rows([(len(ids), dims, *arrays)], BLOCK)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("node", "cutoff", "v")), strict=True):
                held.setdefault(len(row[2]), []).append(row)
                if len(held[len(row[2])]) == block:
                    yield packed(len(row[2]))
        for dims in list(held):
            yield packed(dims)

    return nodes.select("node", "cutoff", "v").mapInArrow(pack, BLOCK)


def met(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Every block of vectors beside every block of queries of the same length."""
    rows = cut_lineage(rows.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(LANES))))
    queries = cut_lineage(queries.withColumn("qb", F.monotonically_increasing_id()))
    # One row per thousand queries.
    numbers = queries.groupBy("dims").agg(F.collect_list("qb").alias("qbs"))
    dealt = rows.join(numbers, "dims").withColumn("qb", F.explode("qbs")).drop("qbs", "cutoffs")
    asked = queries.select("qb", "cutoffs", F.col("size").alias("q_size"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    asked = asked.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(LANES - 1).cast("long"))))
    return dealt.join(asked.hint("shuffle_hash"), ["qb", "lane"])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 1 << 53:
        return (a.astype("f8") @ b.astype("f8").T).astype("i8")
    if bound < 1 << 63:
        return a @ b.T
    raise ValueError("scores beyond 64 bits")


def local_lists(blocks: DataFrame, k: int | None) -> DataFrame:
    """With k: of each query and part the k best of a block, scored in full. Without: the entries that reach the cutoff."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids, q_ids = np.frombuffer(row["ids"], "i8"), np.frombuffer(row["q_ids"], "i8")
                v = np.frombuffer(row["vectors"], "i8").reshape(len(ids), row["dims"])
                q = np.frombuffer(row["q_vectors"], "i8").reshape(len(q_ids), row["dims"])
                cutoff = np.frombuffer(row["cutoffs"], "i8")[:, None]
                cuts = np.linspace(0, row["dims"], PARTS + 1).astype(int)
                parts = [_products(q[:, a:b], v[:, a:b]) for a, b in zip(cuts, cuts[1:])]
                full = sum(parts)
                for p, part in enumerate(parts):
                    if k is None:
                        at, to = np.nonzero(part * PARTS >= cutoff)
                        score = part[at, to]
                    else:
                        few = min(k, len(ids))
                        to = np.argpartition(-part, few - 1, axis=1)[:, :few].ravel()
                        at = np.repeat(np.arange(len(q_ids)), few)
                        score = full[at, to]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[at]), pa.array(ids[to]), pa.array(np.full(len(at), p, "i4")), pa.array(score)],
                        names=["query", "node", "part", "score"],
                    )

    return blocks.mapInArrow(entries, ENTRY)


def _dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def top_products(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each row whose id is divisible by ``every``, among all other rows."""
    rows = whole_vectors(vectors).withColumn("q", F.pmod("vec_id", F.lit(every)) == 0)
    nodes = distinct_vectors(rows, k)
    asking = nodes.where("asks").withColumn("cutoff", F.lit(0).cast("long"))
    row_blocks = in_blocks(nodes.withColumn("cutoff", F.lit(0).cast("long")), ROW_BLOCK)
    best = k + 1  # a query's own vector may have no id but its own

    # Phase 1: a safe cutoff per query; none where there are too few vectors.
    seen = local_lists(met(row_blocks, in_blocks(asking, QUERY_BLOCK)), best).select("query", "node", "score").distinct()
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    kth = seen.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= best).groupBy("query").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    lowest = -(1 << 62)
    cut = cut_lineage(kth.select(F.col("query").alias("node"), F.when(F.col("n") == best, F.col("kth")).otherwise(F.lit(lowest)).alias("cutoff")))

    # Phase 2: every entry that reaches its share of the cutoff.
    asking = nodes.where("asks").join(cut, "node")
    entries = local_lists(met(row_blocks, in_blocks(asking, QUERY_BLOCK)), None)
    found = entries.groupBy("query", "node").agg(F.sum("score").alias("some"), F.count("*").alias("parts"))

    # Phase 3: who can still reach the cutoff is scored in full.
    cutoff = cut.select(F.col("node").alias("query"), "cutoff")
    below = F.expr(f"(cutoff - 1 - pmod(cutoff - 1, {PARTS})) div {PARTS}")
    able = found.join(cutoff, "query").where(F.col("some") + (PARTS - F.col("parts")) * below >= F.col("cutoff"))
    q = nodes.select(F.col("node").alias("query"), F.col("v").alias("_a"))
    scored = able.join(q, "query").join(nodes.select("node", F.col("v").alias("_b"), "ids"), "node")
    scored = scored.withColumn("score", F.when(F.col("parts") == PARTS, F.col("some")).otherwise(_dot("_a", "_b"))).where("score >= cutoff")

    # Vectors become ids again, queries too.
    candidates = scored.select("query", "score", F.explode("ids").alias("vec_id"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = candidates.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
    askers = rows.where("q").join(nodes.where("asks").select("v", F.col("node").alias("query")), "v").select(F.col("vec_id").alias("query_id"), "query")
    answers = askers.distinct().join(lists, "query").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
