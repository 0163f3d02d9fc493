import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from foldmark.llm import sharding
from tests.llm.brute import docs_of, rows_of


def check(got, rows, shards):
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) <= set(range(shards))
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))


def test_documents(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    rows = list(zip(t["doc_id"], t["text"]))
    check(rows_of(sharding.shard_documents(docs_of(spark, rows))), rows, 40)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    rows = [(1, "same")] * 60 + [(None, None)] * 25 + [(None, "x")] + [(2, None), (3, ""), (4, "é" * 5000)]
    got = rows_of(sharding.shard_documents(docs_of(spark, rows), 7))
    check(got, rows, 7)
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    again = rows_of(sharding.shard_documents(docs_of(spark, rows[::-1], 5), 7))
    key = lambda r: sorted((str(k), str(v)) for k, v in r.items())
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty_and_fewer_rows_than_shards(spark):
    assert sharding.shard_documents(docs_of(spark, [])).collect() == []
    check(rows_of(sharding.shard_documents(docs_of(spark, [(1, "a"), (2, "b")]))), [(1, "a"), (2, "b")], 40)


def place(counts, shards, slack):
    """The ring row by row: each slot's shards with how many of its rows."""
    points = sharding.ring_points(shards)
    room = sharding.capacities(sum(counts.values()), shards, slack)
    rows = [[slot, next((i for i, p in enumerate(points) if p[0] >= slot), 0)] for slot in sorted(counts) for _ in range(counts[slot])]
    got = Counter()
    while rows:
        left = []
        for slot, at in rows:
            shard = points[at][1]
            if room[shard]:
                room[shard] -= 1
                got[slot, shard] += 1
            else:
                left.append([slot, (at + 1) % len(points)])
        rows = left
    return got


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_ring_against_row_by_row(slack):
    counts = {(i * i * 7919) % sharding.RING: 1 + i % 9 for i in range(200)} | {77: 600}
    got = Counter()
    for slot, parts in sharding.settle_ring(counts, 5, slack).items():
        before = 0
        for upto, shard, _ in parts:
            got[slot, shard] += upto - before
            before = upto
        assert before == counts[slot]
    assert got == place(counts, 5, slack)


def test_one_more_shard_moves_few_rows():
    counts = {s: 3 for s in range(0, sharding.RING, 4)}

    def owners(shards, slack):
        found = {}
        for slot, parts in sharding.settle_ring(counts, shards, slack).items():
            before = 0
            for upto, shard, _ in parts:
                found |= {(slot, r): shard for r in range(before, upto)}
                before = upto
        return found

    for slack, most in ((0.25, 0.1), (0.0, 0.5)):
        a, b = owners(40, slack), owners(41, slack)
        assert sum(a[k] != b[k] for k in a) / len(a) < most
