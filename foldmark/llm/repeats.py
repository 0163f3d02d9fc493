"""Repeated byte strings between documents, by a sparse suffix sort compared through polynomial hashes.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with a smaller id. Windows of LENGTH bytes
are taken together in runs: neighbouring windows whose least-hashed gram of ``GRAM`` bytes, the anchor, is the same one.
Equal windows have equal anchors at equal places, so they meet under their anchor's hash:

1. Every run sends its anchor's hash, the hash of all its bytes and its place, packed, to a bin by anchor. A run whose whole
   bytes occur in a smaller document is settled, many of them before the shuffle, which then go to bins by document. Runs
   whose anchor occurs in no other document are done.
2. The rest fetch their bytes, less than 2 LENGTH each. Under each anchor the suffixes that start at it are sorted by
   merging. Two suffixes are compared by the length of their common extension, found by binary search over prefix
   polynomial hashes, and the byte after it. Neighbours' extensions are verified byte by byte.
3. For each distance of the anchor from a window's start, runs of neighbours with long enough extensions and equal bytes
   before the anchor are groups of equal windows; the smallest document keeps its own.

Texts are dealt once by a hash of the row, and both the fetch and the end read that one shuffle.

Defined results: a null or empty text, or one below LENGTH bytes, loses nothing; equal rows (same id) take nothing from each
other; a null ``doc_id`` counts as larger than all others; rows with the same id and different texts are told
apart by a checksum; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, texts
from foldmark.session import cut_lineage

LENGTH = 50
GRAM = 20
GRAMS = LENGTH - GRAM + 1
#: Bytes of text per bin of anchors, and per part of the documents.
BIN_BYTES = 8 << 20
PART_BYTES = 4 << 20
#: Bytes of text that a task holds runs of at a time.
BATCH_BYTES = 4 << 20
#: Windows of a text that are hashed at a time.
SLICE = 1 << 20
LAST = np.iinfo("i8").max  # stands for a null id

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
VALUES = np.frombuffer(b"".join(hashlib.sha256(bytes([b])).digest()[:8] for b in range(256)), "<u8")

BLOB = "bin int, blob binary"
PART_BLOB = "part int, kind int, blob binary"
SPANS, ASKED = 0, 1
ROWS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as bytes; the bytes of equal rank lie together, which is what a compressor likes."""
    planes = {k: (a.dtype.str, a.view("u1").reshape(len(a), a.dtype.itemsize).T.tobytes()) for k, a in arrays.items()}
    raw = pickle.dumps(planes, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    out = {}
    for k, (kind, planes) in pickle.loads(raw).items():
        kind = np.dtype(kind)
        out[k] = np.ascontiguousarray(np.frombuffer(planes, "u1").reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    return out


def joined(blobs: list[bytes]) -> dict[str, np.ndarray]:
    parts = [unpack(b) for b in blobs]
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key with the places that hold it, in order."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(keys[places[0]]), places


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Prefixes:
    """Prefix polynomial hashes of bytes: the hash of any substring in a few operations. Arithmetic is modulo 2^64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, BASE, "u8")]), dtype="u8")
        self.inverse = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, INVERSE, "u8")]), dtype="u8")
        self.sums = np.zeros(n + 1, "u8")
        np.cumsum(VALUES[data] * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def _leftmost_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each stretch of ``width`` values, and the first place that holds it, by doubling."""
    place, step = np.arange(len(values), dtype="i4"), 1
    while step < width:
        shift = min(step, width - step)
        right = values[shift:] < values[:-shift]
        place = np.where(right, place[shift:], place[:-shift])
        values = np.minimum(values[shift:], values[:-shift])
        step += shift
    return values, place


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, hash of all bytes, first window, windows) of each run of a text."""
    found = []
    for at in range(0, len(data) - LENGTH + 1, SLICE):
        part = data[at : at + SLICE + LENGTH - 1]
        hashes = Prefixes(part)
        starts = np.arange(len(part) - GRAM + 1)
        anchor, place = _leftmost_least(mixed(hashes.of(starts, starts + GRAM)), GRAMS)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        n = np.diff(np.append(first, len(place)))
        found.append((anchor[first], hashes.of(first, first + n + LENGTH - 1), first + at, n))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else tuple(np.empty(0, t) for t in ("u8", "u8", "i8", "i8"))


def utf8(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), "u1")


def _fewer_bytes(values: np.ndarray, n: int) -> np.ndarray:
    """The n highest bytes of 64-bit values, as an array of n-byte items."""
    return np.ascontiguousarray(values.astype(">u8").view("u1").reshape(-1, 8)[:, :n]).reshape(-1).view(f"V{n}")


def _widened(values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), 8), "u1")
    out[:, : values.dtype.itemsize] = values.view("u1").reshape(len(values), -1)
    return out.reshape(-1).view(">u8").astype("u8")


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about BATCH_BYTES of text."""
    size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = int(size[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + BATCH_BYTES)))
        yield batch.slice(at, end - at)
        at = end


def anchored_runs(batch: pa.RecordBatch, bins: int) -> list[tuple[int, bytes]]:
    """A batch's runs by the bin of their anchor. Those settled by a smaller document of the batch are spans already: without hashes,
    they go to as many bins again, by their documents' part, so an anchor's bin gets one run of equal ones from a batch."""
    ids = [LAST if i is None else i for i in batch.column("doc_id").to_pylist()]
    docs = sorted(range(len(ids)), key=ids.__getitem__)  # so that runs come in the order of ids
    column = batch.column("text")
    per_doc = [runs(utf8(column[i].as_py())) for i in docs]
    counts = np.array([len(r[0]) for r in per_doc], "i8")
    if not counts.sum():
        return []
    anchor, whole, first, n = (np.concatenate(x) for x in zip(*per_doc))
    doc = np.repeat(np.arange(len(docs)), counts)
    doc_id = np.array([ids[i] for i in docs], "i8")
    crc = np.array(batch.column("crc").to_pylist(), "i8").astype("u4")[docs]
    part = np.array(batch.column("part").to_pylist(), "u4")[docs]

    anchor = mixed(anchor)  # least hashes are not even; these are
    order = np.argsort(anchor ^ mixed(whole), kind="stable")
    a, w = anchor[order], whole[order]
    new = np.append(True, (a[1:] != a[:-1]) | (w[1:] != w[:-1]))
    leader = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    settled = np.empty(len(order), bool)
    settled[order] = doc_id[doc[order]] > doc_id[doc[leader]]

    out = []
    by_part = bins + part[doc].astype("i8") % bins
    for number, places in groups(np.where(settled, by_part, (anchor % np.uint64(bins)).astype("i8"))):
        held = doc[places]
        fresh = np.append(True, held[1:] != held[:-1])
        own = held[fresh]
        blob = {"ids": np.diff(doc_id[own], prepend=0), "crc": crc[own], "part": part[own]}
        run = {"fresh": fresh.astype("u1"), "first": np.diff(first[places], prepend=0).astype("i4"), "n": n[places].astype("u4")}
        hashes = {} if number >= bins else {"anchor": _fewer_bytes(anchor[places], 5), "whole": _fewer_bytes(whole[places], 7)}
        out.append((number, pickle.dumps((pack(**blob), pack(**run, **hashes)))))
    return out


def _unpacked_runs(blob: bytes) -> dict[str, np.ndarray]:
    docs, run = (unpack(b) for b in pickle.loads(blob))
    doc = np.cumsum(run["fresh"].astype("i8")) - 1
    out = {"id": np.cumsum(docs["ids"])[doc], "crc": docs["crc"][doc], "part": docs["part"][doc]}
    out |= {"first": np.cumsum(run["first"].astype("i8")), "n": run["n"]}
    return out | {k: _widened(run[k]) for k in ("anchor", "whole") if k in run}


def _by_part(kind: int, rows: dict[str, np.ndarray]) -> list[tuple[int, int, bytes]]:
    return [(part, kind, pack(**{k: v[places] for k, v in rows.items() if k != "part"})) for part, places in groups(rows["part"].astype("i8"))]


def settle_bin(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """A bin's settled runs as spans, and the runs whose bytes must be seen."""
    found = [_unpacked_runs(b) for b in table.column("blob").to_pylist()]
    done = [r for r in found if "anchor" not in r]
    open_ = [r for r in found if "anchor" in r]
    out = []
    if open_:
        r = {k: np.concatenate([x[k] for x in open_]) for k in open_[0]}
        order = np.lexsort((r["id"], r["whole"], r["anchor"]))
        r = {k: v[order] for k, v in r.items()}
        new_anchor = np.append(True, r["anchor"][1:] != r["anchor"][:-1])
        new_whole = new_anchor | np.append(True, r["whole"][1:] != r["whole"][:-1])
        at, whole_at = np.cumsum(new_anchor) - 1, np.cumsum(new_whole) - 1
        starts = np.flatnonzero(new_anchor)
        shared = np.minimum.reduceat(r["id"], starts) != np.maximum.reduceat(r["id"], starts)
        several = np.bincount(at[new_whole]) > 1
        smallest = r["id"] == r["id"][np.flatnonzero(new_whole)][whole_at]
        ask = smallest & (shared & several)[at]
        done.append({k: v[~smallest] for k, v in r.items()})
        asked = {k: r[k][ask] for k in ("id", "crc", "part", "first", "n", "anchor")}
        asked["bin"] = np.full(len(asked["id"]), table.column("bin")[0].as_py(), "i4")
        out += _by_part(ASKED, asked)
    spans = {k: np.concatenate([x[k] for x in done]) for k in ("id", "crc", "part", "first", "n")}
    return out + _by_part(SPANS, spans)


def _keyed(docs: pa.Table) -> dict[tuple[int, int], int]:
    ids = [LAST if i is None else i for i in docs.column("doc_id").to_pylist()]
    return {key: row for row, key in enumerate(zip(ids, docs.column("crc").to_pylist(), strict=True))}


def fetch_bytes(docs: pa.Table, asked: pa.Table) -> list[tuple[int, bytes]]:
    """The bytes of the runs that asked, by bin."""
    r = joined(asked.column("blob").to_pylist())
    if not r:
        return []
    rows, column = _keyed(docs), docs.column("text")
    part = np.full(len(r["id"]), asked.column("part")[0].as_py(), "u4")
    length = r["n"].astype("i8") + LENGTH - 1
    pieces: list[bytes] = [b""] * len(length)
    key = r["id"].astype("u8") * np.uint64(BASE) + r["crc"]
    for _, places in groups(key.view("i8")):
        data = column[rows[int(r["id"][places[0]]), int(r["crc"][places[0]])]].as_py().encode()
        for p in places.tolist():
            at = int(r["first"][p])
            pieces[p] = data[at : at + int(length[p])]
    out = []
    for number, places in groups(r["bin"].astype("i8")):
        own = {k: r[k][places] for k in ("id", "crc", "first", "n", "anchor")} | {"part": part[places]}
        text = np.frombuffer(b"".join(pieces[p] for p in places.tolist()), "u1")
        out.append((number, pickle.dumps((pack(**own), pack(text=text)))))
    return out


class Suffixes:
    """Suffixes of pieces of one buffer, each from its start to its piece's end, sorted within groups."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.end = np.append(data, np.uint8(0)), start, end
        self.hashes = Prefixes(data)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The length of the common extension, by binary search over hashes of equal lengths."""
        low, high = np.zeros(len(x), "i8"), np.minimum(self.end[x] - self.start[x], self.end[y] - self.start[y])
        while np.any(low < high):
            middle = (low + high + 1) >> 1
            a, b = self.start[x], self.start[y]
            equal = self.hashes.of(a, a + middle) == self.hashes.of(b, b + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(x, y)
        a, b = self.start[x] + n, self.start[y] + n
        x_ends, y_ends = a == self.end[x], b == self.end[y]
        return np.where(x_ends, ~y_ends | or_equal, ~y_ends & (self.data[a] < self.data[b]))

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Mergesort of all groups side by side: each item's place is its own in its half and its rank in the other."""
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
        size = np.diff(np.append(first, len(order)))
        base, size = np.repeat(first, size), np.repeat(size, size)
        width = 1
        while len(order) and width < size.max():
            at = np.flatnonzero(size > width)
            own = (at - base[at]) // width
            low = base[at] + (own ^ 1) * width
            other = np.minimum(low, base[at] + size[at])
            high = np.minimum(other + width, base[at] + size[at])
            low, later = other.copy(), own % 2 == 1
            while True:
                todo = np.flatnonzero(low < high)
                if not len(todo):
                    break
                middle = (low[todo] + high[todo]) >> 1
                before = self.less(order[middle], order[at[todo]], later[todo])
                low[todo] = np.where(before, middle + 1, low[todo])
                high[todo] = np.where(before, high[todo], middle)
            place = base[at] + (own // 2) * 2 * width + (at - base[at]) % width + low - other
            moved = order.copy()
            moved[place] = order[at]
            order, width = moved, width * 2
        return order

    def same_bytes(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bool:
        """Whether n bytes from each place a and b are equal."""
        for i in range(int(n.max(initial=0))):
            far = np.flatnonzero(n > i)
            if np.any(self.data[a[far] + i] != self.data[b[far] + i]):
                return False
        return True


def _windows_by_hash(data: np.ndarray, r: dict[str, np.ndarray], base: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(run, window) of every window that a smaller document has; None if a hash collided."""
    n = r["n"].astype("i8")
    hashes = Prefixes(data)
    gram = base[:, None] + np.arange(GRAMS)
    offset = mixed(hashes.of(gram, gram + GRAM)).argmin(axis=1)
    suffixes = Suffixes(data, base + offset, base + n + LENGTH - 1)
    order = suffixes.sort(r["anchor"].view("i8"))
    anchor = r["anchor"][order]
    near = np.flatnonzero(anchor[1:] == anchor[:-1]) + 1
    extension = np.full(len(order), -1, "i8")
    extension[near] = suffixes.common(order[near - 1], order[near])
    if not suffixes.same_bytes(suffixes.start[order[near - 1]], suffixes.start[order[near]], extension[near]):
        return None
    run, window = [], []
    ids = r["id"][order]
    for left in range(GRAMS):
        j = offset[order] - left
        held = np.flatnonzero((j >= 0) & (j < n[order]))
        if not len(held):
            continue
        stretch = np.cumsum(extension < LENGTH - left)[held]
        start = suffixes.start[order[held]] - left
        before = suffixes.hashes.of(start, start + left)
        by = np.lexsort((ids[held], before, stretch))
        new = np.append(True, (np.diff(stretch[by]) != 0) | (before[by][1:] != before[by][:-1]))
        leader = by[np.flatnonzero(new)][np.cumsum(new) - 1]
        if not suffixes.same_bytes(start[by], start[leader], np.full(len(by), left)):
            return None
        gone = by[ids[held][by] > ids[held][leader]]
        run.append(order[held[gone]])
        window.append(j[held[gone]])
    return np.concatenate(run) if run else np.empty(0, "i8"), np.concatenate(window) if window else np.empty(0, "i8")


def _windows_by_bytes(data: np.ndarray, r: dict[str, np.ndarray], base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    text, least = data.tobytes(), {}
    every = [(i, j, text[b + j : b + j + LENGTH]) for i, (b, n) in enumerate(zip(base.tolist(), r["n"].tolist(), strict=True)) for j in range(n)]
    for i, _, w in every:
        least[w] = min(int(r["id"][i]), least.get(w, LAST))
    gone = [(i, j) for i, j, w in every if r["id"][i] > least[w]]
    return np.array([i for i, _ in gone], "i8"), np.array([j for _, j in gone], "i8")


def sort_bin(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """The spans of a bin's runs that hold windows of smaller documents."""
    blobs = [pickle.loads(b) for b in table.column("blob").to_pylist()]
    r = joined([b[0] for b in blobs])
    data = joined([b[1] for b in blobs])["text"]
    length = r["n"].astype("i8") + LENGTH - 1
    base = np.cumsum(length) - length
    found = _windows_by_hash(data, r, base)
    run, window = found if found is not None else _windows_by_bytes(data, r, base)
    order = np.lexsort((window, run))
    run, window = run[order], window[order]
    new = np.append(True, (np.diff(run) != 0) | (np.diff(window) != 1))[: len(run)]
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(run)))
    spans = {k: r[k][run[at]] for k in ("id", "crc", "part")} | {"first": r["first"][run[at]] + window[at], "n": n.astype("u4")}
    return _by_part(SPANS, spans)


def covered(first: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """The maximal stretches of bytes under windows that start at ``first`` to ``first + n - 1``."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate((first + n + LENGTH - 1)[order])
    new = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return list(zip(start[new].tolist(), np.append(end[new[1:] - 1], end[-1]).tolist(), strict=True))


def cut_documents(docs: pa.Table, spans: pa.Table) -> list[tuple]:
    r = joined(spans.column("blob").to_pylist())
    gone: dict[tuple[int, int], list[tuple[int, int]]] = {}
    if r and len(r["id"]):
        key = r["id"].astype("u8") * np.uint64(BASE) + r["crc"]
        for _, places in groups(key.view("i8")):
            gone[int(r["id"][places[0]]), int(r["crc"][places[0]])] = covered(r["first"][places], r["n"][places].astype("i8"))
    out, column = [], docs.column("text")
    for row, (doc_id, crc) in enumerate(zip(docs.column("doc_id").to_pylist(), docs.column("crc").to_pylist(), strict=True)):
        data, stretches = column[row].as_py().encode(), gone.get((LAST if doc_id is None else doc_id, crc), [])
        digest, at = hashlib.sha256(), 0
        for start, end in stretches:
            digest.update(data[at:start])
            at = end
        digest.update(data[at:])
        out.append((doc_id, len(data), sum(e - s for s, e in stretches), len(stretches), digest.hexdigest()))
    return out


def remove_repeats(docs: DataFrame, bin_bytes: int = BIN_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    size = texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins, parts = max(1, -(-size // bin_bytes)), max(1, -(-size // part_bytes))
    rows = texts(docs).withColumn("crc", F.crc32(F.col("text").cast("binary")))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "crc"), F.lit(parts)).cast("int"))

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded(batch):
                yield arrow_rows(anchored_runs(part, bins), BLOB)

    def settle(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([arrow_rows(settle_bin(table), PART_BLOB)])

    def fetch(docs: pa.Table, asked: pa.Table) -> pa.Table:
        return pa.Table.from_batches([arrow_rows(fetch_bytes(docs, asked), BLOB)])

    def compare(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([arrow_rows(sort_bin(table), PART_BLOB)])

    def cut(docs: pa.Table, spans: pa.Table) -> pa.Table:
        return pa.Table.from_batches([arrow_rows(cut_documents(docs, spans), ROWS)])

    settled = cut_lineage(rows.mapInArrow(to_bins, BLOB).groupBy("bin").applyInArrow(settle, PART_BLOB))
    dealt = rows.repartition(parts, "part").groupBy("part")
    asked = settled.where(F.col("kind") == ASKED).drop("kind").groupBy("part")
    sorted_ = dealt.cogroup(asked).applyInArrow(fetch, BLOB).groupBy("bin").applyInArrow(compare, PART_BLOB)
    spans = settled.where(F.col("kind") == SPANS).union(sorted_).drop("kind").groupBy("part")
    return dealt.cogroup(spans).applyInArrow(cut, ROWS)
