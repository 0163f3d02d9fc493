import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from foldmark.llm import repeats as r
from tests.llm.brute import docs_of, rows_of

L = r.LENGTH


def plain(rows):
    big = 1 << 70
    least = {}
    data = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - L + 1):
            w = b[p : p + L]
            least[w] = min(i, least.get(w, big))
    out = []
    for (key, _), (i, b) in zip(rows, data):
        gone = bytearray(len(b))
        for p in range(len(b) - L + 1):
            if least[b[p : p + L]] < i:
                gone[p : p + L] = b"\1" * L
        kept = bytes(c for c, g in zip(b, gone) if not g)
        n_spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((str(key), len(b), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def check(spark, rows, partitions=3, **sizes):
    got = rows_of(r.remove_repeats(docs_of(spark, rows, partitions), **sizes))
    assert sorted((str(x["doc_id"]), x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got) == plain(rows)


def test_documents(spark):
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    check(spark, list(zip(t["doc_id"], t["text"])), bin_bytes=300_000, part_bytes=200_000)


def passages(rng, n, letters, length):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(n)]


@pytest.mark.parametrize("letters", ["ab", "abcdefghij é", "a"])
def test_shared_passages(spark, letters):
    rng = random.Random(7)
    common = passages(rng, 12, letters, (30, 160))
    rows = []
    for i in range(70):
        parts = [rng.choice(common) if rng.random() < 0.5 else passages(rng, 1, letters, (0, 60))[0] for _ in range(rng.randint(0, 6))]
        rows.append((rng.randint(0, 55), "".join(parts)))
    check(spark, rows, 5, bin_bytes=2000, part_bytes=1500)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(r, "SLICE", 37)
    long = "".join(chr(97 + (i * i // 7) % 26) for i in range(400))
    rows = [(1, None), (2, ""), (3, long[:L]), (4, long[: L - 1]), (5, long), (5, long), (None, long), (None, "x" + long[100:]), (6, long + long), (5, long[200:])]
    check(spark, rows + [(7, "z" * 300), (8, "z" * 299), (-1, "y" * 10 + long[60:130])])
    assert r.remove_repeats(docs_of(spark, [])).collect() == []


def test_collisions_are_found_and_resolved(spark, monkeypatch):
    """With few hash values, windows differ where hashes agree: bytes decide."""
    whole = r.Prefixes.of
    seen = []
    by_bytes = r._windows_by_bytes
    monkeypatch.setattr(r.Prefixes, "of", lambda self, a, b: whole(self, a, b) % np.uint64(3))
    monkeypatch.setattr(r, "_windows_by_bytes", lambda *a: seen.append(1) or by_bytes(*a))
    rng = np.random.default_rng(2)
    n = rng.integers(1, 6, 40)
    text = rng.integers(97, 99, int((n + L - 1).sum())).astype("u1")
    base = np.cumsum(n + L - 1) - (n + L - 1)
    runs = {"n": n.astype("u4"), "id": rng.integers(0, 9, 40), "anchor": np.zeros(40, "u8")}
    assert r._windows_by_hash(text, runs, base) is None
    blob = [r.pickle.dumps((r.pack(**runs, crc=n.astype("u4"), part=n.astype("u4"), first=base), r.pack(text=text)))]
    r.sort_bin(r.pa.table({"bin": [0], "blob": blob}))
    assert seen


def test_sort_is_by_suffix():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 99, 3000).astype("u1")
    start = rng.integers(0, 2900, 500)
    end = np.minimum(start + rng.integers(0, 90, 500), 3000)
    group = rng.integers(0, 20, 500)
    raw = text.tobytes()
    want = sorted(range(500), key=lambda i: (group[i], raw[start[i] : end[i]]))
    suffixes = r.Suffixes(text, start, end)
    got = suffixes.sort(group).tolist()
    assert [(group[i], raw[start[i] : end[i]]) for i in got] == [(group[i], raw[start[i] : end[i]]) for i in want]


def test_packing():
    arrays = {"a": np.arange(5, dtype="i8"), "b": np.empty(0, "u4"), "c": np.frombuffer(b"abcdefghij", "V5")}
    back = r.unpack(r.pack(**arrays))
    assert all(back[k].tobytes() == v.tobytes() and back[k].dtype == v.dtype for k, v in arrays.items())


def test_settled_runs_go_by_document_and_one_of_equals_by_anchor():
    import pyarrow as pa

    passage = "".join(chr(97 + (i * i + 3 * i) % 26) for i in range(200))
    n, bins = 40, 4
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": [passage] * n, "crc": [7] * n, "part": list(range(n))})
    found = r.anchored_runs(batch, bins)
    by_anchor = [r._unpacked_runs(b) for number, b in found if number < bins]
    by_part = {number: r._unpacked_runs(b) for number, b in found if number >= bins}
    assert all("anchor" in x and set(x["id"].tolist()) == {0} for x in by_anchor)
    assert set(by_part) == {bins + i for i in range(bins)} and all("anchor" not in x for x in by_part.values())
    assert sum(len(x["id"]) for x in by_part.values()) == (n - 1) * sum(len(x["id"]) for x in by_anchor)
    for number, x in by_part.items():
        assert set((x["part"] % bins).tolist()) == {number - bins}
