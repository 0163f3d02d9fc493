"""Token files: blocks of ids under a static range asymmetric numeral system (rANS), written and read in parallel.

A file set is a folder of Parquet files, one row per block. A block holds whole documents and decodes alone: its
row gives the checkpoint (position of its first id among all ids, documents and their lengths) and the
payload. Payload: header (magic, ids, lanes, words, CRC-32 of the ids as 32-bit integers), the lanes'
final states, then the 32-bit words in the order in which a decoder takes them. Lane i holds the ids i, i + LANES,
...; all lanes step together. One frequency table of all ids, scaled to 2^20, serves every block and is stored beside them.

Order: documents ascend by ``doc_id`` (nulls first); ties by a hash of the text. Defined results: a null or
empty text is the end id alone; equal rows are each written; an empty table gives an empty file set; other
columns are left out. A text longer than a block makes a larger block of its own.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, bounded_batches, texts
from foldmark.llm.vocab import ID, SLICE_BYTES, ColumnEncoder, Encoder, public_path
from foldmark.session import cut_lineage, ensure_checkpoint_dir

END_ID = 0
SCALE_BITS = 20
LANES = 4096
BLOCK_IDS = 1 << 19
#: States stay in [LOW, LOW << 32).
LOW = np.uint64(1 << 31)
MAGIC = b"fmr1"
HEADER = "<4sQIQI"

#: Packs of documents, and after a partition's last one a row with its counts of ids.
PACKS = "part int, pack int, first long, doc_ids array<long>, lengths array<int>, ids binary, counts binary"
BLOCKS = "first long, n_ids long, doc_ids array<long>, lengths array<int>, payload binary"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Integer frequencies that sum to 2^SCALE_BITS, one at least for every id that occurs."""
    total, size = int(counts.sum()), 1 << SCALE_BITS
    if not total:
        return np.zeros(len(counts), "uint32")
    if np.count_nonzero(counts) > size:
        raise ValueError("more distinct ids than frequency slots")
    exact = counts * (size / total)
    freq = np.where(counts > 0, np.maximum(1, np.floor(exact)), 0).astype("int64")
    rest = size - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if rest > 0:
        freq[order[0]] += rest
    for i in order:  # what rounding up to one has taken comes from the largest
        if rest >= 0:
            break
        give = min(-rest, max(0, int(freq[i]) - 1))
        freq[i] -= give
        rest += give
    return freq.astype("uint32")


class Coder:
    """Encodes and decodes one block under a shared frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype("uint64")
        self.start = np.concatenate([[0], np.cumsum(freq, dtype="uint64")[:-1]]).astype("uint64")
        self.owner = np.repeat(np.arange(len(freq), dtype="i4"), freq)

    def encode(self, ids: np.ndarray) -> bytes:
        n, lanes = len(ids), min(LANES, len(ids))
        state, words = np.full(lanes, LOW, "uint64"), []
        shift = np.uint64(63 - SCALE_BITS)
        numbers = ids.astype("intp")
        for at in range((n - 1) // lanes * lanes if n else 0, -1, -lanes) if n else ():
            symbols = numbers[at : at + lanes]
            x, f = state[: len(symbols)], self.freq[symbols]
            full = x >= (f << shift)
            words.append(x[full].astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
            q = x // f
            state[: len(symbols)] = (q << np.uint64(SCALE_BITS)) + (x - q * f) + self.start[symbols]
        stream = np.concatenate(words[::-1]) if words else np.empty(0, "<u4")
        crc = zlib.crc32(ids.astype(ID).tobytes())
        return struct.pack(HEADER, MAGIC, n, lanes, len(stream), crc) + state.astype("<u8").tobytes() + stream.tobytes()

    def decode(self, payload: bytes) -> np.ndarray:
        magic, n, lanes, n_words, crc = struct.unpack_from(HEADER, payload)
        if magic != MAGIC or len(payload) != struct.calcsize(HEADER) + 8 * lanes + 4 * n_words:
            raise ValueError("not a block of this format")
        state = np.frombuffer(payload, "<u8", lanes, struct.calcsize(HEADER)).astype("uint64")
        words = np.frombuffer(payload, "<u4", n_words, struct.calcsize(HEADER) + 8 * lanes).astype("uint64")
        out, at = np.empty(n, ID), 0
        mask = np.uint64((1 << SCALE_BITS) - 1)
        for i in range(0, n, lanes or 1):
            x = state[: min(lanes, n - i)]
            slot = x & mask
            symbols = self.owner[slot.view("i8")]
            out[i : i + len(x)] = symbols
            x = self.freq[symbols] * (x >> np.uint64(SCALE_BITS)) + slot - self.start[symbols]
            low = x < LOW
            taken = int(np.count_nonzero(low))
            x[low] = (x[low] << np.uint64(32)) | words[at : at + taken]
            at += taken
            state[: len(x)] = x
        if at != n_words or np.any(state != LOW) or zlib.crc32(out.tobytes()) != crc:
            raise ValueError("block checksum does not match")
        return out


def token_packs(docs: DataFrame, path: str, keeps_spaces: bool = True, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Whole documents' ids in ascending order, in packs of about ``block_ids`` ids; ``first`` counts within the partition."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """(ids of documents, their token ids on end, the number of each)."""
        end = np.array([end_id], ID)
        encoder = ColumnEncoder(path) if keeps_spaces else Encoder(path, keeps_spaces)
        for batch in bounded_batches(batches, "text", SLICE_BYTES):
            if keeps_spaces:
                found, lengths = encoder.encode_column(batch.column("text"), end_id)
            else:
                each = [np.concatenate([np.frombuffer(x, ID), end]) for x in encoder.encode(batch.column("text").to_pylist())]
                found, lengths = np.concatenate(each), np.array([len(x) for x in each])
            yield batch.column("doc_id").to_pylist(), found, lengths

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number = first = held = 0
        counts = np.zeros(0, "int64")
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        for keys, found, lengths in slices(batches):
            seen = np.bincount(found, minlength=len(counts))
            seen[: len(counts)] += counts
            counts, ends, at, start = seen, np.cumsum(lengths), 0, 0
            while at < len(keys):
                # Documents up to the one that fills the pack.
                to = min(len(keys), int(np.searchsorted(ends, start + block_ids - held)) + 1)
                stop = int(ends[to - 1])
                ids.append(found[start:stop])
                doc_ids += keys[at:to]
                sizes += lengths[at:to].tolist()
                held, at, start = held + stop - start, to, stop
                if held >= block_ids:
                    yield arrow_rows([(part, number, first, doc_ids, sizes, np.concatenate(ids).tobytes(), None)], PACKS)
                    number, first, held, ids, doc_ids, sizes = number + 1, first + held, 0, [], [], []
        if ids:
            yield arrow_rows([(part, number, first, doc_ids, sizes, np.concatenate(ids).tobytes(), None)], PACKS)
        if len(counts):
            yield arrow_rows([(part, None, None, None, None, None, counts.astype("<i8").tobytes())], PACKS)

    ordered = texts(docs).withColumn("_tie", F.xxhash64("text"))
    return ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").mapInArrow(packs, PACKS)


def id_counts(packs: DataFrame) -> np.ndarray:
    """How often each id occurs in all packs, from the partitions' counts; the table is as long as the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column("counts"):
                counts = np.frombuffer(counts.as_buffer(), "<i8")
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])

    held = packs.where("counts is not null").select("counts")
    rows = held.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, "int64")
    counts[rows["id"].to_numpy("int64")] = rows["n"].to_numpy("int64")
    return counts


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, keeps_spaces: bool = True, end_id: int = END_ID) -> None:
    """Writes ``folder``/blocks and ``folder``/frequencies."""
    spark = docs.sparkSession
    packs = cut_lineage(token_packs(docs, path or public_path("byte_bpe_50k.json"), keeps_spaces, end_id))
    freq = scaled_frequencies(id_counts(packs))
    packs = packs.where("counts is null").drop("counts")
    sizes = packs.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    offsets, total = {}, 0  # one number per partition
    for row in sizes.orderBy("part").collect():
        offsets[row["part"]] = total
        total += row["n"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                part, first, doc_ids, lengths = (batch.column(c)[i].as_py() for c in ("part", "first", "doc_ids", "lengths"))
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), ID)
                yield arrow_rows([(offsets[part] + first, len(ids), doc_ids, lengths, coder.encode(ids))], BLOCKS)

    packs.mapInArrow(encode, BLOCKS).write.parquet(f"{folder}/blocks")
    table = spark.createDataFrame(pd.DataFrame({"id": np.flatnonzero(freq), "freq": freq[freq > 0].astype("int64")}), "id long, freq long")
    table.coalesce(1).write.parquet(f"{folder}/frequencies")


def _frequencies(spark: SparkSession, folder: str) -> np.ndarray:
    rows = spark.read.parquet(f"{folder}/frequencies").toPandas()
    freq = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, "uint32")
    freq[rows["id"].to_numpy("int64")] = rows["freq"].to_numpy()
    return freq


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document in a file set; every block is checked against its checksum."""
    return _decoded(spark, folder, "doc_id long, start long, ids array<long>", lambda key, start, ids: (key, start, ids.tolist()))


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded ids."""
    return _decoded(spark, folder, ROWS, lambda key, start, ids: (key, start, len(ids), zlib.crc32(ids.tobytes())))


def _decoded(spark: SparkSession, folder: str, schema: str, of) -> DataFrame:
    freq = _frequencies(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                first, doc_ids, lengths, payload = (batch.column(c)[i].as_py() for c in ("first", "doc_ids", "lengths", "payload"))
                ids, ends = coder.decode(payload), np.cumsum(lengths, dtype="int64")
                starts = (first + ends - lengths).tolist()
                parts = np.split(ids, ends[:-1])
                yield arrow_rows([of(*row) for row in zip(doc_ids, starts, parts, strict=True)], schema)

    return spark.read.parquet(f"{folder}/blocks").mapInArrow(decode, schema)


def token_file_rows(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes a file set below the checkpoint folder, reads it back: (doc_id, start, n_tokens, ids_crc32)."""
    folder = f"{ensure_checkpoint_dir(docs.sparkSession)}/{uuid.uuid4().hex}"
    write_token_files(docs, folder, path)
    return token_digests(docs.sparkSession, folder)
