"""Importance resampling of documents towards a target distribution, by hashed n-gram features.

Words and pairs of neighbouring words of a text are its features, each in one of ``BUCKETS`` buckets by its checksum. A
bucket's gain tells how much more frequent it is in the target than in the corpus; a document weighs the mean gain of its
features. Scores are weights plus a seeded Gumbel draw, so the highest scores are a sample by weight without replacement.

1. Each Arrow batch is lower-cased, split and flattened by Arrow's kernels and its words dictionary-encoded. Shifted indices
   give the pairs of neighbours; each distinct word and pair of a batch gets its checksum once, that of a pair from those of
   its words. Counts per bucket are added up per task, then over tasks: BUCKETS rows a task at most.
2. The gains, BUCKETS numbers, go back with the second pass over the texts, which takes them by index and reduces them by
   document.
3. Scores are whole numbers within some 150 000 (``ln`` of 64-bit counts, times 1000), so rows per score give every score's
   place in the order by one small table, and rows of one score are numbered among themselves.

Defined results: a null or empty text has no features, weight 0, and no place in the draw (it has fewer than MIN_WORDS words);
with no benchmark rows, or none with words, T is 0; equal rows are drawn each on its own; a null ``doc_id`` counts as larger
than all others and its draw is that of an empty id; an empty table gives an empty one; other columns are left out. A
worker holds the words of BATCH_BYTES of text, or of one text if that is longer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmark.llm import sql
from foldmark.llm.common import bounded_batches, spread_texts, texts
from foldmark.session import cut_lineage

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
#: Gains and draws are thousandths.
SCALE = 1000
#: Arrays over a slice's words and pairs take some 20 times its text, Arrow's beside them as much again: two workers stay far below an executor's memory.
BATCH_BYTES = 1 << 20

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COUNTED = "bucket int, n long"
WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(indices, distinct words, first word of each text and the end) of lower-cased texts; nulls have no words."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
    flat = pc.list_flatten(lists)
    kept = pc.greater(pc.binary_length(flat), 0)  # a separator at either end leaves an empty word
    parents = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[kept.to_numpy(zero_copy_only=False)]
    encoded = pc.dictionary_encode(flat.filter(kept))
    indices = encoded.indices.to_numpy(zero_copy_only=False).astype("i8")
    return indices, encoded.dictionary, np.searchsorted(parents, np.arange(len(texts) + 1))


@lru_cache(maxsize=512)
def _after_zeros(length: int) -> np.ndarray:
    """Four tables that turn a checksum, byte by byte, into its part in the checksum of ``length`` more bytes.

    The part is linear in the checksum's bits, so that of each bit, taken from the checksum of ``length`` zero bytes, is enough.
    """
    zeros = bytes(length)
    bits = np.array([zlib.crc32(zeros, 1 << b) ^ zlib.crc32(zeros, 0) for b in range(32)], "u4")
    values = np.arange(256)
    tables = np.zeros((4, 256), "u4")
    for b in range(32):
        tables[b // 8] ^= np.where(values >> (b % 8) & 1, bits[b], 0).astype("u4")
    return tables


def pair_checksums(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC32 of two strings on end, from the CRC32 of each and the second's length."""
    out = np.empty(len(first), "u4")
    order = np.argsort(length, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
        if len(places):
            t, crc = _after_zeros(int(length[places[0]])), first[places]
            out[places] = t[0][crc & 255] ^ t[1][crc >> 8 & 255] ^ t[2][crc >> 16 & 255] ^ t[3][crc >> 24] ^ second[places]
    return out


def features_of(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every word then of every pair, its text's row, words of each text)."""
    indices, words, starts = words_of(texts)
    n_words = np.diff(starts)
    row = np.repeat(np.arange(len(texts)), n_words)
    spelled = words.cast(pa.binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, spelled), "u4", len(spelled))
    # A pair is its first word and a space, then the second word.
    led = pair_checksums(crc, np.full(len(crc), zlib.crc32(b" "), "u4"), np.ones(len(crc), "i8"))
    length = np.fromiter(map(len, spelled), "i8", len(spelled))
    near = np.flatnonzero(row[1:] == row[:-1])
    pair = pc.dictionary_encode(pa.array(indices[near] * len(words) + indices[near + 1]))
    left, right = np.divmod(pair.dictionary.to_numpy(), max(1, len(words)))
    pairs = pair_checksums(led[left], crc[right], length[right])
    bucket = np.concatenate([(crc % buckets).astype("i8")[indices], (pairs % buckets).astype("i8")[pair.indices.to_numpy()]])
    return bucket, np.concatenate([row, row[near]]), n_words


def counted_batches(batches: Iterator[pa.RecordBatch], buckets: int = BUCKETS) -> Iterator[pa.RecordBatch]:
    """COUNTED of a task's texts."""
    total = np.zeros(buckets, "i8")
    for batch in bounded_batches(batches, "text", BATCH_BYTES):
        total += np.bincount(features_of(batch.column("text"), buckets)[0], minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])


def feature_counts(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts of a table with a column ``text``; buckets without any have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted_batches(batches, buckets)

    return table.select("text").mapInArrow(run, COUNTED).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, from counts over all texts of both tables."""
    sides = feature_counts(corpus, buckets).withColumn("side", F.lit(0))
    sides = sides.unionByName(feature_counts(target, buckets).withColumn("side", F.lit(1)))
    counts = np.zeros((2, buckets))
    for r in sides.collect():  # 2 * buckets rows at most
        counts[r["side"], r["bucket"]] = r["n"]
    (s, t), (all_s, all_t) = counts, counts.sum(axis=1)
    return np.floor(SCALE * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype("i8")


def weighed_batches(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    """WEIGHED of a task's documents."""
    for batch in bounded_batches(batches, "text", BATCH_BYTES):
        bucket, row, n_words = features_of(batch.column("text"), len(gains))
        order = np.argsort(row, kind="stable")
        n = np.bincount(row, minlength=batch.num_rows)
        total = np.zeros(batch.num_rows, "i8")
        if len(order):
            total[n > 0] = np.add.reduceat(gains[bucket[order]], (np.cumsum(n) - n)[n > 0])
        weight = np.where(n > 0, total // np.maximum(n, 1), 0)
        ids = batch.column("doc_id").cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(x.astype("i8")) for x in (n_words, n, weight))], names=[c.split()[0] for c in WEIGHED.split(", ")]
        )


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return weighed_batches(batches, gains)

    return docs.select("doc_id", "text").mapInArrow(run, WEIGHED)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A document's draw, in thousandths: a function of its id and the seed alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw_highest(scored: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """Adds ``rank``: 1, 2, ... of the ``percent`` highest scores of the eligible rows, null for all others."""
    rows = scored.withColumn("_in", eligible)
    in_order = Window.orderBy(F.desc("score"))  # over one row per score
    held = rows.where("_in").groupBy("score").agg(F.count("*").alias("_n"))
    before = held.select(
        F.col("score").alias("_score"),
        (F.sum("_n").over(in_order) - F.col("_n")).alias("_before"),
        F.floor(F.lit(percent) * F.sum("_n").over(Window.partitionBy()) / 100).alias("_drawn"),
    )
    ties = Window.partitionBy("_in", "score").orderBy(F.asc_nulls_last("doc_id"), "n_features")
    placed = rows.withColumn("_row", F.row_number().over(ties)).join(F.broadcast(before), F.col("score") == F.col("_score"), "left")
    rank = F.col("_before") + F.col("_row")
    return placed.select(*scored.columns, F.when(F.col("_in") & (rank <= F.col("_drawn")), rank).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; drawn documents have a rank."""
    rows = spread_texts(docs)
    gains = bucket_gains(rows, target.select(F.coalesce("text", F.lit("")).alias("text")))
    scored = weigh(rows, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    ranked = draw_highest(cut_lineage(scored), F.col("n_words") >= min_words, percent)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def keep_drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, rank) of the drawn documents, for a ``doc_id`` that tells rows apart."""
    ranked = resample(docs, target, percent, seed, min_words).where("rank is not null").select("doc_id", "rank")
    return texts(docs).join(ranked, "doc_id")


ORACLE_SQL = f"""
WITH {sql.CRC_TABLE},
texts AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
worded AS (SELECT side, r, doc_id, regexp_extract_all({sql.lower_ascii("coalesce(text, '')")}, '{sql.ASCII_WORD}') AS w FROM texts),
features AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM worded),
buckets AS (SELECT f, {sql.crc32("f")} % {BUCKETS} AS bucket FROM (SELECT DISTINCT f FROM features) AS d, crc_table),
placed AS (SELECT side, r, bucket FROM features JOIN buckets USING (f)),
counts AS (
  SELECT bucket, count(*) FILTER (side = 0)::DOUBLE AS s, count(*) FILTER (side = 1)::DOUBLE AS t FROM placed GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
gains AS (
  SELECT bucket, floor({SCALE} * ln((t + 1) * (all_s + {BUCKETS}) / ((s + 1) * (all_t + {BUCKETS})))) AS gain FROM counts, sums),
weighed AS (
  SELECT r, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-{SCALE} * ln(-ln(
           (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded LEFT JOIN weighed USING (r) WHERE side = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS eligible
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {MIN_WORDS} AND place <= {PERCENT} * eligible // 100 THEN place END AS rank
FROM ranked
"""
