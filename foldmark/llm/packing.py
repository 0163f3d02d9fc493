"""Best-fit packing of token pieces into sequences of a fixed capacity, with a fixed number of open bins.

Each text is tokenized once, where it is read; what goes on is a short row per piece. Pieces are dealt to chunks of
bounded size by a hash of where they lie in the written table, so equal rows spread like any others. Inside a
chunk the open bins are keyed by free space: a bitset says which amounts of free space occur, so the tightest bin
that holds a piece is one shift and one lowest bit away. When a bin more than allowed would be open, the
fullest one closes.

Defined results: a null or empty text is the end id alone, so each document has a piece; equal rows are packed
like different ones; only texts longer than the capacity are cut; an empty table gives an empty one; a null
``doc_id`` stays null; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, spread_texts
from foldmark.llm.vocab import ID, Encoder, public_path
from foldmark.session import cut_lineage

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 1024
#: A chunk holds about this many tokens, and about this many pieces at most.
CHUNK_TOKENS = 8 << 20
CHUNK_PIECES = 200_000
#: Bins of a chunk are numbered below this.
BINS_PER_CHUNK = 1 << 32

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


def token_pieces(docs: DataFrame, path: str, keeps_spaces: bool = False, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each text: its place in the document's ids, its length, the checksum of its ids."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = Encoder(path, keeps_spaces), capacity * ID.itemsize
        end = np.array([end_id], ID).tobytes()
        for batch in batches:
            out = []
            keys = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(keys, encoder.encode(batch.column("text").to_pylist()), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    out.append((doc_id, n, at // ID.itemsize, len(part) // ID.itemsize, zlib.crc32(part)))
            yield arrow_rows(out, PIECES)

    return spread_texts(docs).mapInArrow(pieces, PIECES)


class OpenBins:
    """At most ``most`` open bins of one capacity. ``place`` gives (bin, offset)."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0  # bit f is set if an open bin has f free
        self.by_free: dict[int, list[tuple[int, int]]] = {}
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number, _ = bins.pop()
        if not bins:
            self.free &= ~(1 << free)
        self.n_open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.free >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            number, free = self.n_bins, self.capacity
            self.n_bins += 1
        if left := free - size:
            self.by_free.setdefault(left, []).append((number, left))
            self.free |= 1 << left
            self.n_open += 1
        return number, self.capacity - free


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces that has been written to files."""
    total = pieces.agg(F.sum("length").alias("tokens"), F.count("*").alias("n")).first()
    chunks = max(1, -(-(total["tokens"] or 0) // chunk_tokens), -(-total["n"] // CHUNK_PIECES))
    # A row's place in its file is its own and the same in every attempt.
    place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    dealt = pieces.withColumn("_chunk", F.pmod(place, F.lit(chunks)))

    def pack(chunk: pa.Table) -> pa.Table:
        bins = OpenBins(capacity, open_bins)
        # A set order; by a checksum, so that sizes arrive mixed.
        chunk = chunk.sort_by([(c, "ascending") for c in ("ids_crc32", "doc_id", "piece")])
        base = chunk.column("_chunk")[0].as_py() * BINS_PER_CHUNK
        placed = [bins.place(n) for n in chunk.column("length").to_pylist()]
        chunk = chunk.drop_columns("_chunk").append_column("sequence_id", pa.array([base + n for n, _ in placed], pa.int64()))
        return chunk.append_column("offset", pa.array([at for _, at in placed], pa.int64()))

    return dealt.groupBy("_chunk").applyInArrow(pack, PLACED)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    pieces = cut_lineage(token_pieces(docs, path or public_path("word_bpe_49k.json"), capacity=capacity))
    return place_pieces(pieces, capacity, open_bins)
