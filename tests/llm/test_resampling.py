import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from foldmark.llm import queries as q
from foldmark.llm import resampling as r
from tests.llm.brute import docs_of, rows_of
from tests.oracle import compare, connect

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_of(text, buckets=r.BUCKETS):
    w = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]], len(w)


def plain(rows, target, percent=r.PERCENT, min_words=r.MIN_WORDS, buckets=r.BUCKETS):
    found = [buckets_of(t, buckets) for _, t in rows]
    s, t = Counter(b for f, _ in found for b in f), Counter(b for x in target for b in buckets_of(x, buckets)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    out = []
    for (i, _), (f, n) in zip(rows, found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    order = sorted((x for x in out if x[5] >= min_words), key=lambda x: (-x[3], math.inf if x[0] is None else x[0], x[1]))
    for rank, x in enumerate(order[: percent * len(order) // 100], 1):
        x[4] = rank
    return sorted(map(repr, (x[:5] for x in out)))


def got(df):
    return sorted(repr([x["doc_id"], x["n_features"], x["weight"], x["score"], x["rank"]]) for x in rows_of(df))


def target_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def some_rows(n=120, seed=3):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "é1", "x", "漢字", "LONGWORD" * 9]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n\t", "\x7f", "__"]) for _ in range(rng.randint(0, k)))
    return [(rng.randint(0, 90), text(60)) for _ in range(n)]


def test_whole_tables_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(q.op11_target_resampling(spark, sf), connect(sf), r.ORACLE_SQL) is None


def test_odd_rows(spark):
    rows = some_rows()
    rows += [(7, None), (7, ""), (None, "alpha " * 30), (None, None), (200, " .,;\x00 "), (201, "alpha beta " * 40000), (7, rows[0][1])]
    rows += [(5, "gamma x " * 15)] * 4  # repeated rows tie in everything
    target = ["alpha beta gamma", None, "", "x x x"]
    for partitions in (1, 5):
        assert got(r.resample(docs_of(spark, rows, partitions), target_of(spark, target))) == plain(rows, target)


def test_small_slices_and_few_buckets(spark, monkeypatch):
    rows, target = some_rows(60, 5), ["alpha beta"]
    gains = r.bucket_gains(docs_of(spark, rows), target_of(spark, target), 13)
    assert len(gains) == 13
    text = pa.array([t for _, t in rows])
    whole = r.features_of(text)
    parts = [b.column(0) for b in r.bounded_batches(iter([pa.record_batch([text], names=["text"])]), "text", 100)]
    assert len(parts) > 10 and sum(map(len, parts)) == len(rows)
    assert sorted(np.concatenate([r.features_of(p)[0] for p in parts])) == sorted(whole[0])


def test_empty_tables(spark):
    rows = some_rows(30, 9)
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(r.resample(docs_of(spark, rows), none)) == plain(rows, [])
    assert r.resample(docs_of(spark, rows).limit(0), target_of(spark, ["alpha"])).count() == 0


def test_checksums_of_pairs():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (bytes(rng.randrange(256) for _ in range(rng.randrange(n))) for n in (12, 90))
        found = r.pair_checksums(np.array([zlib.crc32(a)], "u4"), np.array([zlib.crc32(b)], "u4"), np.array([len(b)]))
        assert found[0] == zlib.crc32(a + b)


def test_drawn_texts(spark):
    rows = [(i, f"alpha beta {i} " * 10) for i in range(40)]
    drawn = rows_of(r.keep_drawn(docs_of(spark, rows), target_of(spark, ["alpha"])))
    assert sorted(x["rank"] for x in drawn) == list(range(1, 11)) and all(x["text"] == dict(rows)[x["doc_id"]] for x in drawn)


def test_draw_prefers_the_target(spark):
    rows = [(i, ("alpha beta gamma " if i % 2 else "delta epsilon zeta ") * 10) for i in range(400)]
    ranked = rows_of(r.resample(docs_of(spark, rows), target_of(spark, ["alpha beta gamma " * 50])))
    drawn = [x["doc_id"] for x in ranked if x["rank"]]
    assert len(drawn) == 100 and sum(i % 2 for i in drawn) > 95


def test_worker_memory_does_not_grow_with_a_batch():
    """The arrays over words and pairs are those of a slice of a batch, and the slices give what the whole batch does."""
    rng = random.Random(4)
    rows = [" ".join(rng.choice("abcdefghijkl") * rng.randint(1, 4) + str(rng.randint(0, 400)) for _ in range(20_000)) for _ in range(80)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows)], names=["doc_id", "text"])
    whole = np.bincount(r.features_of(batch.column("text"))[0], minlength=r.BUCKETS)
    gains = np.arange(r.BUCKETS)
    tracemalloc.start()
    counted, weighed = list(r.counted_batches(iter([batch]))), list(r.weighed_batches(iter([batch]), gains))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    (counts,) = counted
    assert counts.column("bucket").to_pylist() == np.flatnonzero(whole).tolist() and counts.column("n").to_pylist() == whole[whole > 0].tolist()
    held = pa.Table.from_batches(weighed)
    assert held["doc_id"].to_pylist() == list(range(len(rows))) and held["n_features"].to_pylist() == [2 * 20_000 - 1] * len(rows)
    for i in (0, 41, 79):
        mine = r.features_of(batch.column("text").slice(i, 1))[0]
        assert held["weight"][i].as_py() == gains[mine].sum() // len(mine)
