"""Repeated passages of words between documents, found from anchors on a difference cover.

A word goes if a window of ``WINDOW`` words covers it whose words also start in a document with a smaller id. Of a text's
places only those in COVER modulo PERIOD are anchors. For any two places there is a shift below PERIOD that takes both
into the cover, so two equal windows always hold anchors at one and the same distance from their starts, and the
``ANCHOR`` = WINDOW - PERIOD + 1 words from there on are equal. Equal windows therefore meet under an anchor's hash:

1. Anchors are hashed, and with each its reach: all words that a window holding the anchor can have. In a batch, an
   anchor whose reach occurs in a smaller document is settled: each of its windows starts there too. The other anchors of
   one reach send one document's places to a bin by the anchor's hash; anchors that the batch has with several reaches
   send one mark there and ask for their windows. No bin gets more than a batch's one entry per anchor and document.
2. A bin settles anchors of one reach by the smallest document and lets those of several reaches ask. Anchors that no
   other document has are done.
3. The anchors that asked are extended: the windows that hold them are hashed, the smallest document of a part sends
   its own to a bin by the window's hash, and the smallest document of a bin keeps its own.

Anchors and reaches have hashes of 64 bits, windows of 128; an anchor is a candidate only, while a reach or a window that
is equal by hash is taken as equal. Texts are dealt to parts by a hash of the row; one shuffle serves 3 and the end.

Defined results: a null or empty text, or one below WINDOW words, loses nothing; equal rows (same id) take nothing from
each other; a null ``doc_id`` counts as larger than all others; rows with the same id and different texts are told apart
by a checksum; an empty table gives an empty one; other columns are left out. A worker holds the words of BATCH_BYTES of
text, or of one text if that is longer, and hashes SLICE words at a time.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, bounded_batches, texts
from foldmark.llm.repeats import LAST, groups, joined, mixed, pack
from foldmark.session import cut_lineage

WINDOW = 50
#: A perfect difference set; the differences of its members give every residue of PERIOD.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
#: Words before and after an anchor that a window holding it can have.
REACH = PERIOD - 1

BIN_BYTES = 16 << 20
PART_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
SLICE = 1 << 20

BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)

ROWS = "doc_id long, n_words long, n_removed long, kept_sha256 string"
#: To a bin, or through it to a part.
BLOB = "bin int, blob binary"
PART_BLOB = "part int, kind int, blob binary"
SPANS, ASKED = 0, 1


def distinct_rows(docs: pa.RecordBatch | pa.Table) -> tuple[pa.RecordBatch | pa.Table, np.ndarray]:
    """The rows that differ in id or checksum, and which of them each row equals."""
    found: dict[tuple, int] = {}
    keys = zip(docs.column("doc_id").to_pylist(), docs.column("crc").to_pylist(), strict=True)
    same = np.array([found.setdefault(key, len(found)) for key in keys], "i8")
    first = np.unique(same, return_index=True)[1]
    return docs if len(first) == len(same) else docs.take(pa.array(first)), same


class Words:
    """The words of some texts on end, as two 64-bit values each."""

    def __init__(self, batch: pa.RecordBatch | pa.Table):
        self.n_docs = batch.num_rows
        column = batch.column("text")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        lists = pc.ascii_split_whitespace(column)  # space and \x09 to \x0D
        flat = pc.list_flatten(lists)
        kept = pc.greater(pc.binary_length(flat), 0)  # white space at either end leaves an empty word
        self.flat = flat.filter(kept)
        parents = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[kept.to_numpy(zero_copy_only=False)]
        self.starts = np.searchsorted(parents, np.arange(self.n_docs + 1))
        self.n = np.diff(self.starts)
        encoded = pc.dictionary_encode(self.flat)
        digests = b"".join(xxhash.xxh3_128_digest(w) for w in encoded.dictionary.cast(pa.binary()).to_pylist())
        values = np.frombuffer(digests, "<u8").reshape(-1, 2)
        indices = encoded.indices.to_numpy(zero_copy_only=False)
        self.values = (values[:, 0][indices], values[:, 1][indices]) if len(indices) else (np.empty(0, "u8"), np.empty(0, "u8"))
        self.ids = np.array([LAST if i is None else i for i in batch.column("doc_id").to_pylist()], "i8")
        self.crc = np.array(batch.column("crc").to_pylist(), "i8").astype("u4")

    def hashes(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """Polynomial hashes, modulo 2^64, of the words from ``start`` to before ``end`` (both ascending), a slice at a time."""
        out, values = np.empty(len(start), "u8"), self.values[which]
        at = 0
        while at < len(start):
            low = int(start[at])
            upto = max(at + 1, int(np.searchsorted(start, low + SLICE)))
            n = int(end[at:upto].max()) - low
            power = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, BASES[which], "u8")]), dtype="u8")
            back = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, INVERSES[which], "u8")]), dtype="u8")
            sums = np.zeros(n + 1, "u8")
            np.cumsum(values[low : low + n] * power[:n], out=sums[1:])
            a, b = start[at:upto] - low, end[at:upto] - low
            out[at:upto] = (sums[b] - sums[a]) * back[a]
            at = upto
        return mixed(out)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, place in it) of all anchors, in order."""
        n = np.where(self.n >= WINDOW, self.n - ANCHOR + 1, 0)
        docs = np.repeat(np.arange(self.n_docs), n)
        place = np.arange(len(docs)) - np.repeat(np.cumsum(n) - n, n)
        chosen = np.isin(np.arange(PERIOD), COVER)[place % PERIOD]
        return docs[chosen], place[chosen]


def held_windows(place: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of the windows of a text of n words that hold the anchor at a place."""
    first = np.maximum(place - REACH, 0)
    return first, np.minimum(place, n_words - WINDOW) - first + 1


def span_rows(part: np.ndarray, ids: np.ndarray, crc: np.ndarray, first: np.ndarray, n: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Windows to remove, by part."""
    return [(p, SPANS, pack(id=ids[at], crc=crc[at], first=first[at].astype("u4"), n=n[at].astype("u4"))) for p, at in groups(part)]


def ask_rows(part: np.ndarray, ids: np.ndarray, crc: np.ndarray, place: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Anchors to extend, by part."""
    return [(p, ASKED, pack(id=ids[at], crc=crc[at], place=place[at].astype("u4"))) for p, at in groups(part)]


def through(rows: list[tuple[int, int, bytes]], bins: int) -> list[tuple[int, bytes]]:
    """Rows to parts on their way through the bins' shuffle, dealt by part."""
    return [(part % bins, pickle.dumps(("part", part, kind, blob))) for part, kind, blob in rows]


def to_bins(bin_: np.ndarray, **columns: np.ndarray) -> list[tuple[int, bytes]]:
    return [(b, pickle.dumps(("bin", pack(**{k: v[at] for k, v in columns.items()})))) for b, at in groups(bin_)]


def arrived(table: pa.Table) -> tuple[dict[str, np.ndarray], list[tuple[int, int, bytes]]]:
    """A bin's own entries, and the rows that go on to parts."""
    found = [pickle.loads(b) for b in table.column("blob").to_pylist()]
    return joined([f[1] for f in found if f[0] == "bin"]), [f[1:] for f in found if f[0] == "part"]


def runs_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, number) of each run of equal rows in sorted columns: the run of a row is ``number[row]``."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def anchor_rows(batch: pa.RecordBatch, bins: int) -> list[tuple[int, bytes]]:
    """A batch's anchors: settled ones and those that ask, to parts; one document's places of every other one, to bins."""
    batch, _ = distinct_rows(batch)
    words, part = Words(batch), np.array(batch.column("part").to_pylist(), "i8")
    doc, place = words.anchors()
    if not len(doc):
        return []
    start, n = words.starts[doc] + place, words.n[doc]
    anchor = words.hashes(start, start + ANCHOR)
    left, right = np.minimum(place, REACH), np.minimum(n - place, ANCHOR + REACH)
    reach = words.hashes(start - left, start + right) + (left * 64 + right).astype("u8")  # the cut at a text's ends tells reaches apart
    order = np.lexsort((words.ids[doc], reach, anchor))
    anchor, reach, doc, place = (x[order] for x in (anchor, reach, doc, place))
    ids = words.ids[doc]
    first, run = runs_of(anchor, reach)
    anchors, anchor_run = runs_of(anchor)
    smallest = ids[first][run]
    several = np.bincount(anchor_run[first]) > 1  # reaches of one anchor
    shared = np.minimum.reduceat(ids, anchors) != np.maximum.reduceat(ids, anchors)
    marked = (several & shared)[anchor_run]
    settled = ids > smallest
    ask = marked & ~settled
    sent = np.flatnonzero(~marked & ~settled)

    def of(rows):
        return part[doc[rows]], ids[rows], words.crc[doc[rows]]

    rows = np.flatnonzero(settled)
    out = through(span_rows(*of(rows), *held_windows(place[rows], words.n[doc[rows]])), bins)
    rows = np.flatnonzero(ask)
    out += through(ask_rows(*of(rows), place[rows]), bins)
    marks = anchors[several & shared]
    entries = np.concatenate([sent, marks])
    mark = np.arange(len(entries)) >= len(sent)
    by_id = np.lexsort((place[entries], ids[entries]))
    entries, mark = entries[by_id], mark[by_id]
    p, i, c = of(entries)
    return out + to_bins(
        (anchor[entries] % np.uint64(bins)).astype("i8"), anchor=anchor[entries], reach=reach[entries], id=i, crc=c,
        part=p.astype("u4"), place=place[entries].astype("u4"), n=words.n[doc[entries]].astype("u4"), mark=mark.astype("u1"),
    )


def settle_anchors(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """A bin's anchors: those of one reach are settled by the smallest document, those of several ask."""
    r, out = arrived(table)
    if not r:
        return out
    order = np.lexsort((r["id"], r["anchor"]))
    r = {k: v[order] for k, v in r.items()}
    first, run = runs_of(r["anchor"])
    lowest, highest = np.minimum.reduceat(r["id"], first), np.maximum.reduceat(r["id"], first)
    one_reach = np.minimum.reduceat(r["reach"], first) == np.maximum.reduceat(r["reach"], first)
    marked = np.maximum.reduceat(r["mark"], first) > 0
    several = marked | ((lowest != highest) & ~one_reach)
    rows = np.flatnonzero((~several)[run] & (r["id"] > lowest[run]))
    windows = held_windows(r["place"][rows].astype("i8"), r["n"][rows].astype("i8"))
    out += span_rows(r["part"][rows].astype("i8"), r["id"][rows], r["crc"][rows], *windows)
    rows = np.flatnonzero(several[run] & (r["mark"] == 0))
    return out + ask_rows(r["part"][rows].astype("i8"), r["id"][rows], r["crc"][rows], r["place"][rows])


def docs_in(words: Words, r: dict[str, np.ndarray]) -> np.ndarray:
    """The row of each (id, checksum) of a part's entries."""
    known = {key: row for row, key in enumerate(zip(words.ids.tolist(), words.crc.tolist(), strict=True))}
    keys = r["id"].astype("u8") * np.uint64(BASES[0]) + r["crc"]
    out = np.empty(len(keys), "i8")
    for _, at in groups(keys.view("i8")):
        out[at] = known[int(r["id"][at[0]]), int(r["crc"][at[0]])]
    return out


def covered(size: int, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in any stretch of n from ``first`` on."""
    depth = np.bincount(first, minlength=size + 1) - np.bincount(first + n, minlength=size + 1)
    return np.cumsum(depth[:size]) > 0


def window_rows(docs: pa.Table, asked: pa.Table, bins: int) -> list[tuple[int, bytes]]:
    """The windows of a part that hold an anchor that asked: settled ones to their part, one document's places to bins."""
    r = joined(asked.column("blob").to_pylist())
    if not r:
        return []
    words, part = Words(distinct_rows(docs)[0]), int(docs.column("part")[0].as_py())
    row = docs_in(words, r)
    first, n = held_windows(r["place"].astype("i8"), words.n[row])
    start = np.flatnonzero(covered(len(words.flat), words.starts[row] + first, n))
    doc = np.searchsorted(words.starts, start, "right") - 1
    high, low = words.hashes(start, start + WINDOW), words.hashes(start, start + WINDOW, 1)
    order = np.lexsort((words.ids[doc], low, high))
    start, doc, high, low = (x[order] for x in (start, doc, high, low))
    ids, place = words.ids[doc], start - words.starts[doc]
    at, run = runs_of(high, low)
    settled = ids > ids[at][run]
    rows = np.flatnonzero(settled)
    out = through(span_rows(np.full(len(rows), part), ids[rows], words.crc[doc[rows]], place[rows], np.ones(len(rows), "i8")), bins)
    rows = np.flatnonzero(~settled)
    rows = rows[np.lexsort((place[rows], ids[rows]))]
    return out + to_bins(
        (high[rows] % np.uint64(bins)).astype("i8"), high=high[rows], low=low[rows], id=ids[rows], crc=words.crc[doc[rows]],
        place=place[rows].astype("u4"), part=np.full(len(rows), part, "u4"),
    )


def settle_windows(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """A bin's windows: the smallest document keeps its own."""
    r, out = arrived(table)
    if not r:
        return out
    order = np.lexsort((r["id"], r["low"], r["high"]))
    r = {k: v[order] for k, v in r.items()}
    first, run = runs_of(r["high"], r["low"])
    rows = np.flatnonzero(r["id"] > r["id"][first][run])
    return out + span_rows(r["part"][rows].astype("i8"), r["id"][rows], r["crc"][rows], r["place"][rows], np.ones(len(rows), "i8"))


def removed_words(words: Words, spans: pa.Table) -> np.ndarray:
    """Which words of a part lie under the windows to remove."""
    r = joined(spans.column("blob").to_pylist())
    if not r:
        return np.zeros(len(words.flat), bool)
    first, n = words.starts[docs_in(words, r)] + r["first"], r["n"].astype("i8")
    return covered(len(words.flat), first, n + WINDOW - 1)


def cut_part(docs: pa.Table, spans: pa.Table) -> pa.Table:
    """(doc_id, its kept words with one space between, words, removed words) of a part's rows."""
    docs, same = distinct_rows(docs)
    words = Words(docs)
    gone = removed_words(words, spans)
    upto = np.concatenate([np.zeros(1, "i8"), np.cumsum(gone)])[words.starts]
    n_removed = np.diff(upto)
    kept = words.flat.filter(pa.array(~gone))
    offsets = pa.array((words.starts - upto).astype("i4"))
    text = pc.binary_join(pa.ListArray.from_arrays(offsets, kept), " ")
    found = pa.table({"doc_id": docs.column("doc_id").cast(pa.int64()), "kept": text, "n_words": words.n, "n_removed": n_removed})
    return found if len(same) == len(found) else found.take(pa.array(same))


def removed_passages(docs: DataFrame, digest: bool, bin_bytes: int, part_bytes: int, batch_bytes: int) -> DataFrame:
    size = texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins, parts = max(1, -(-size // bin_bytes)), max(1, -(-size // part_bytes))
    rows = texts(docs).withColumn("crc", F.crc32(F.col("text").cast("binary")))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "crc"), F.lit(parts)).cast("int"))

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_batches(batches, "text", batch_bytes):
            yield arrow_rows(anchor_rows(batch, bins), BLOB)

    def settle(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([arrow_rows(settle_anchors(table), PART_BLOB)])

    def extend(docs: pa.Table, asked: pa.Table) -> pa.Table:
        return pa.Table.from_batches([arrow_rows(window_rows(docs, asked, bins), BLOB)])

    def compare(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([arrow_rows(settle_windows(table), PART_BLOB)])

    def cut(docs: pa.Table, spans: pa.Table) -> pa.Table:
        found = cut_part(docs, spans)
        if not digest:
            return found
        digests = pa.array([hashlib.sha256(t).hexdigest() for t in found.column("kept").cast(pa.binary()).to_pylist()], pa.string())
        return found.drop_columns("kept").append_column("kept_sha256", digests)

    settled = cut_lineage(rows.mapInArrow(anchor, BLOB).groupBy("bin").applyInArrow(settle, PART_BLOB))
    dealt = rows.repartition(parts, "part").groupBy("part")
    asked = settled.where(F.col("kind") == ASKED).drop("kind").groupBy("part")
    extended = dealt.cogroup(asked).applyInArrow(extend, BLOB).groupBy("bin").applyInArrow(compare, PART_BLOB)
    spans = settled.where(F.col("kind") == SPANS).union(extended).drop("kind").groupBy("part")
    return dealt.cogroup(spans).applyInArrow(cut, ROWS if digest else "doc_id long, kept string, n_words long, n_removed long")


def remove_passages(
    docs: DataFrame, bin_bytes: int = BIN_BYTES, part_bytes: int = PART_BYTES, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) of every document: its words without repeated passages.

    A batch sends at most one blob to each bin, so both sizes grow with the corpus: some 256 MB each at 100 TB.
    """
    return removed_passages(docs, False, bin_bytes, part_bytes, batch_bytes)


def passage_digests(
    docs: DataFrame, bin_bytes: int = BIN_BYTES, part_bytes: int = PART_BYTES, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``remove_passages`` with the SHA-256 of the kept words in place of them."""
    return removed_passages(docs, True, bin_bytes, part_bytes, batch_bytes)


ORACLE_SQL = f"""
WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, p, md5(array_to_string(w[p : p + {WINDOW - 1}], ' ')) AS held
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM worded WHERE len(w) >= {WINDOW}) AS placed),
least AS (SELECT held, min(doc_id) AS doc_id FROM windows GROUP BY held),
gone AS (
  SELECT DISTINCT r, unnest(range(p, p + {WINDOW})) AS q
  FROM windows JOIN least USING (held) WHERE windows.doc_id > least.doc_id),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM worded),
kept AS (
  SELECT words.r, count(gone.q) AS n_removed, string_agg(word, ' ' ORDER BY words.q) FILTER (gone.q IS NULL) AS k
  FROM words LEFT JOIN gone ON words.r = gone.r AND words.q = gone.q GROUP BY words.r)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (r)
"""
