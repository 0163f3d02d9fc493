"""SimHash near-duplicates by multi-index hashing, and the components of the links.

A fingerprint of 64 bits is cut into two segments of 32. If two fingerprints differ in at most 3 bits, they differ in at
most one bit in one of the segments. So each distinct fingerprint lies in a table under each segment's value,
and asks that table for each value within one bit of its own: a ball of 33. Of two values one bit apart only the
one with the bit set asks for the other, which halves the asking. Every answer is checked on all 64 bits.

``near_copies`` serves a Jaccard similarity of ``SIMILARITY`` between sets of five words, far beyond a ball of a few bits:
0.8 is 15 of 100 bits. Each set's fingerprint (every shingle once, however often the text has it) takes ``WIDE`` bits in
segments of 16; candidates have one bit of difference in any segment and ``WIDE_DISTANCE`` in all. One of a segment's two
halves is then equal, so texts meet under (segment, half, value) and the ball is enumerated over the other half, inside the
meeting. A meeting reports each local group as a star, not as pairs; one of more than ``MEETING`` fingerprints is a
grid of smaller ones. Candidates are only where to look: the sets of each component of candidates are compared exactly, and
only links of ``SIMILARITY`` count. Sets of at most ``FEW`` shingles need no fingerprint: two similar ones share one of
their smallest hashes, under which they meet. Equal sets are one node.

In ``simhash_components`` equal fingerprints are one node, however many documents have them. Components: rounds of large-star and
small-star over the links, each round written to the checkpoint folder.

Defined results: null and empty texts have fingerprint zero and link like any other; equal rows have one
component; an empty table gives an empty one; a null ``doc_id`` links but names no component (null if there
is no other); other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, quoted, spread_texts
from foldmark.session import cut_lineage

BITS = 64
SEGMENTS = 2
SEGMENT_BITS = BITS // SEGMENTS
#: With two segments, a ball of one bit finds everything up to this distance.
DISTANCE = 3
SEED = 42
#: Shingles whose bits are counted at a time.
SLICE = 1 << 18
FINGERPRINTS = "doc_id long, fingerprint long"


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """XXH64 of each shingle of k words (fewer words: of all of them), words cut at ASCII white space, A-Z lowered."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, "u8")
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - k + 1)
    starts, stops = (ends - lengths)[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), "u8", n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as a signed 64-bit integer."""
    ones = np.zeros(BITS, "i8")
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE].astype(">u8").view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype="i8")
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t, k)) for t in batch.column("text").to_pylist()]
            yield arrow_rows(list(zip(batch.column("doc_id").to_pylist(), found, strict=True)), FINGERPRINTS)

    return spread_texts(docs).mapInArrow(of_batch, FINGERPRINTS)


def segment(value: Column, number: int) -> Column:
    return F.shiftrightunsigned(value, SEGMENT_BITS * number).bitwiseAND((1 << SEGMENT_BITS) - 1)


def near_fingerprints(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: all pairs of different values of the column ``fingerprint`` that differ in at most ``distance`` bits."""
    if distance > DISTANCE:
        raise ValueError(f"two segments find distances up to {DISTANCE}")
    known = prints.select("fingerprint").distinct()
    segments = F.array(*[F.struct(F.lit(i).alias("s"), segment(F.col("fingerprint"), i).alias("v")) for i in range(SEGMENTS)])
    table = known.select(F.col("fingerprint").alias("b"), F.inline(segments))
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(SEGMENT_BITS)])
    set_bits = F.filter(bits, lambda bit: F.col("v").bitwiseAND(bit) != 0)
    ball = F.concat(F.array("v"), F.transform(set_bits, lambda bit: F.col("v").bitwiseXOR(bit)))
    asked = table.select(F.col("b").alias("a"), "s", F.col("v").alias("own"), F.explode(ball).alias("v"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # Equal segments meet from both sides: one is enough. Values one bit apart meet once already.
    once = (F.col("own") != F.col("v")) | (F.col("a") < F.col("b"))
    pairs = asked.join(table, ["s", "v"]).where(near & once & (F.col("a") != F.col("b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


#: A key with at least 2 / HUBS of all rows is a hub: there are at most half as many.
HUBS = 4096


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of the links (a, b), a != b, the smallest node that it can reach."""
    edges, before = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        before = state
        edges = cut_lineage(_small_star(_large_star(edges)))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).where("u != v").distinct()


def hub_size(rows: int) -> int:
    return max(1, -(-2 * rows // HUBS))


def _meet(rows: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """Rows (u, v) with the ``m`` of their ``u``, which has ``n`` rows. Where these are ``hub`` or more, of HUBS keys at most, ``m`` comes to the rows; the others are shuffled."""
    large = least.where(F.col("n") >= hub).select("u", "m", F.lit(1).alias("large"))
    marked = rows.join(F.broadcast(large), "u", "left")
    rest = marked.where(F.col("large").isNull()).select("u", "v").join(least.where(F.col("n") < hub).select("u", "m"), "u")
    return marked.where(F.col("large").isNotNull()).select("u", "v", "m").union(rest.select("u", "v", "m"))


def simhash_components(docs: DataFrame, k: int = 3, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of every document."""
    prints = cut_lineage(fingerprints(docs, k))
    first = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    roots = components(near_fingerprints(first, distance))
    of_print = first.join(roots, first["fingerprint"] == roots["node"], "left")
    of_print = cut_lineage(of_print.select("fingerprint", "first_id", "n", F.coalesce("root", "fingerprint").alias("root")))
    names = of_print.groupBy(F.col("root").alias("u")).agg(F.min("first_id").alias("m"), F.count("*").alias("n"))
    n_prints, n_rows = of_print.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    named = _meet(of_print.select(F.col("root").alias("u"), F.struct("fingerprint", "n").alias("v")), names, hub_size(n_prints))
    named = named.select(F.col("v.fingerprint").alias("u"), "m", "v.n")
    found = _meet(prints.select(F.col("fingerprint").alias("u"), F.col("doc_id").alias("v")), named, hub_size(n_rows))
    hexed = F.lower(F.lpad(F.hex("u"), 16, "0")).alias("fingerprint")
    return found.select(F.col("v").alias("doc_id"), hexed, F.col("m").alias("component_id"))


#: For similar sets: bits, bits of a segment, and the bits by which complete fingerprints of candidates may differ. A similarity of
#: 0.8 means 39 bits on average with a deviation of 6: the limit is four deviations above, five below unrelated sets.
WIDE = 256
NARROW = 16
WIDE_DISTANCE = 64
SIMILARITY = 0.8
#: Sets of at most so many shingles meet without fingerprints.
FEW = 40
SHINGLE = 5
MEETING = 8192
WORDS = [f"w{i}" for i in range(WIDE // BITS)]


def wide_fingerprint(hashes: np.ndarray) -> list[int]:
    """One fingerprint for each of several hashes derived from a shingle's."""
    out = []
    for i in range(len(WORDS)):
        x = (hashes + np.uint64((i * 0x9E3779B97F4A7C15) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(fingerprint((x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) if i else hashes))
    return out


def least_shared(n: int | np.ndarray) -> np.ndarray:
    """How many of a set's n shingles a similar set holds at least."""
    return np.ceil(SIMILARITY * np.asarray(n) - 1e-9).astype("i8")


def wide_fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, k1, k2, s1, s2, n, least, w0, w1, ...): a row's own hashes, its set's and its size, some of its least hashes, its fingerprint.

    Of two similar sets of at most FEW shingles, each has one of the other's ``least``. Larger sets have none.
    """
    keys = ["doc_id long", "k1 long", "k2 long", "s1 long", "s2 long", "n long", "least array<long>"]
    schema = ", ".join([*keys, *[f"{w} long" for w in WORDS]])

    def of_text(text: str) -> tuple:
        shingles = np.unique(shingle_hashes(text, k))
        one, two = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), ">i8").tolist()
        n = len(shingles)
        least = shingles[: n - int(least_shared(n)) + 1].view("i8").tolist() if 0 < n <= FEW else []
        return one, two, n, least, *wide_fingerprint(shingles)

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [of_text(t) for t in batch.column("text").to_pylist()]
            keys = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "k1", "k2")), strict=True)
            yield arrow_rows([(*key, *w) for key, w in zip(keys, found, strict=True)], schema)

    return spread_texts(docs).select("*", *_row_hashes()).mapInArrow(of_batch, schema)


def _row_hashes() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(F.col("doc_id").cast("long"), text).alias("k1"), F.crc32(text.cast("binary")).alias("k2")]


def _stars(left: np.ndarray, nodes: np.ndarray, words: np.ndarray, side: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(node, smallest node of its group) for the links between fingerprints of a meeting.

    ``left``: the values of the segment's other half. With two sides, only links between them are looked for.
    """
    root = np.arange(len(nodes))
    order = np.argsort(left, kind="stable")
    cuts = np.searchsorted(left[order], np.arange(257))
    both = bool(side.any()) and not side.all()
    for value in range(256):
        mine = order[cuts[value] : cuts[value + 1]]
        if not len(mine):
            continue
        balls = [value, *[value ^ (1 << b) for b in range(8) if value >> b & 1]]
        near = np.concatenate([order[cuts[v] : cuts[v + 1]] for v in balls])
        for i in mine.tolist():
            bits = np.bitwise_count(words[near] ^ words[i]).sum(axis=1)
            linked = near[(bits <= distance) & (side[near] != side[i])] if both else near[bits <= distance]
            roots = np.unique(np.append(root[linked], root[i]))
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    return _to_least(root, nodes)


def _to_least(root: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node of its group) for groups given by their roots."""
    sizes = np.bincount(root, minlength=len(root))
    member = np.flatnonzero(sizes[root] > 1)
    least = np.full(len(root), np.iinfo("i8").max)
    np.minimum.at(least, root[member], nodes[member])
    found = zip(nodes[member].tolist(), least[root[member]].tolist(), strict=True)
    return [(a, b) for a, b in found if a != b]


def _similar_sets(nodes: np.ndarray, sizes: np.ndarray, shingles: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node of its group) for the links of SIMILARITY between sets, one after the other in ``shingles``.

    Two similar sets share one of their rarest shingles here, as many as a similar set can lack and one more. Sets that are
    linked already aren't compared. With two sides, only links between them are looked for.
    """
    both = bool(side.any()) and not side.all()
    owner = np.repeat(np.arange(len(nodes)), sizes)
    _, inverse, counts = np.unique(shingles, return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), "i8")
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    order = np.lexsort((rank[inverse], owner))
    ranks, cuts = rank[inverse][order], np.cumsum(np.append(0, sizes))
    rare = np.arange(len(ranks)) - cuts[owner] < (sizes - least_shared(sizes) + 1)[owner]
    by_rank = np.argsort(ranks[rare], kind="stable")
    posted, holders = ranks[rare][by_rank], owner[rare][by_rank]
    root = np.arange(len(nodes))
    for i in range(1, len(nodes)):
        mine = ranks[cuts[i] : cuts[i + 1]]
        first = mine[: sizes[i] - int(least_shared(sizes[i])) + 1]
        low, high = np.searchsorted(posted, first), np.searchsorted(posted, first, side="right")
        near = [holders[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True) if b > a + 1]
        if not near:
            continue
        met = np.concatenate(near)
        met = np.unique(met[(met < i) & (root[met] != root[i])])
        if both:
            met = met[side[met] != side[i]]
        for j in met.tolist():
            if root[j] == root[i]:
                continue
            shared = len(np.intersect1d(mine, ranks[cuts[j] : cuts[j + 1]], assume_unique=True))
            if shared >= SIMILARITY * (sizes[i] + sizes[j] - shared) - 1e-9:
                root[root == root[i]] = root[j]
    return _to_least(root, nodes)


def similar_fingerprints(nodes: DataFrame, distance: int = WIDE_DISTANCE, meeting: int = MEETING) -> DataFrame:
    """(a, b): links that connect what the pairs of nodes (node, w0, ...) within the distance connect."""
    halves = []
    for word in WORDS:
        for at in range(0, BITS, NARROW):
            low, high = (F.shiftrightunsigned(word, at + 8 * h).bitwiseAND(255).cast("int") for h in (0, 1))
            for one, other in ((low, high), (high, low)):
                halves.append(F.struct((F.lit(256 * len(halves)) + one).alias("key"), other.alias("other")))
    rows = nodes.select("node", *WORDS, F.inline(F.array(*halves)))
    sizes = nodes.select(F.inline(F.array(*halves))).groupBy("key").agg((F.floor(F.count("*") / meeting) + 1).cast("int").alias("blocks"))
    # One row per meeting place: 256 for each half of a segment, whatever the table's size.
    rows = rows.join(F.broadcast(sizes), "key")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = rows.withColumn("own", block).withColumn("with", F.explode(others))
    rows = rows.withColumn("x", F.least("own", "with")).withColumn("y", F.greatest("own", "with"))

    def meet(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_numpy() for c in table.column_names}
        words = np.stack([columns[w] for w in WORDS], axis=1).view("u8")
        found = _stars(columns["other"], columns["node"], words, columns["own"] != columns["x"], distance)
        return pa.Table.from_batches([arrow_rows(found, "a long, b long")])

    return rows.groupBy("key", "x", "y").applyInArrow(meet, "a long, b long").distinct()


def similar_sets(docs: DataFrame, nodes: DataFrame, candidates: DataFrame, k: int = SHINGLE, meeting: int = MEETING) -> DataFrame:
    """(a, b): links that connect what the nodes with sets of SIMILARITY connect, among those that meet.

    Nodes meet in their component of candidates (node, root), and under each of their least hashes. ``nodes`` names
    a row of ``docs`` for each by its hashes.
    """
    of_root = F.array(F.struct(F.lit(0).alias("kind"), F.col("root").alias("key")))
    of_root = F.when(F.col("root").isNotNull(), of_root).otherwise(F.array_except(of_root, of_root))
    of_least = F.transform("least", lambda h: F.struct(F.lit(1).alias("kind"), h.alias("key")))
    met = nodes.join(candidates, "node", "left").select("node", "best.k1", "best.k2", F.inline(F.concat(of_root, of_least)))
    met = cut_lineage(met)
    sizes = met.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select("kind", "key", (F.floor(F.col("n") / meeting) + 1).cast("int").alias("blocks"))
    place = F.struct("kind", "key", "blocks")
    places = met.join(sizes, ["kind", "key"]).groupBy("node", "k1", "k2").agg(F.collect_list(place).alias("places"))
    rows = docs.select("text", *_row_hashes()).join(places, ["k1", "k2"]).dropDuplicates(["k1", "k2", "node"]).select("node", "places", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(t or "", k)).view("i8") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("places"), pa.array(found, pa.list_(pa.int64()))], ["node", "places", "shingles"]
            )

    rows = rows.mapInArrow(sets, "node long, places array<struct<kind:int,key:long,blocks:int>>, shingles array<long>")
    rows = rows.select("node", "shingles", F.inline("places"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("x", F.least("own", "with")).withColumn("y", F.greatest("own", "with"))

    def compare(table: pa.Table) -> pa.Table:
        lists = table.column("shingles").combine_chunks()
        sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False).astype("i8"), lists.flatten().to_numpy()
        nodes, own, x = (table.column(c).to_numpy() for c in ("node", "own", "x"))
        return pa.Table.from_batches([arrow_rows(_similar_sets(nodes, sizes, flat, own != x), "a long, b long")])

    return rows.groupBy("kind", "key", "x", "y").applyInArrow(compare, "a long, b long").distinct()


def near_copies(docs: DataFrame, k: int = SHINGLE, distance: int = WIDE_DISTANCE) -> DataFrame:
    """The documents, with all their columns, one of each group of near copies: that with the smallest id (nulls last).

    Near copies: links of SIMILARITY between their sets of shingles, and what these connect. Rows of the same id and equal texts
    are one. Texts without words are copies of each other.
    """
    prints = cut_lineage(wide_fingerprints(docs, k))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("best")
    same = [F.min(c).alias(c) for c in ("n", "least", *WORDS)]
    nodes = prints.groupBy("s1", "s2").agg(best, *same).withColumn("node", F.monotonically_increasing_id())
    nodes = cut_lineage(nodes)
    candidates = components(similar_fingerprints(nodes.where("n > 0"), distance))
    roots = components(similar_sets(docs, nodes, candidates, k))
    grouped = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    kept = grouped.select(F.col("best.k1").alias("_k1"), F.col("best.k2").alias("_k2"))
    k1, k2 = _row_hashes()
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("_row"), k1.alias("_k1"), k2.alias("_k2"))
    return rows.join(kept, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"]).select("_row.*")
