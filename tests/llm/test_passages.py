import hashlib
import random
import re

import pytest

from foldmark.llm import passages as p
from foldmark.llm import queries as q
from tests.llm.brute import docs_of, rows_of
from tests.oracle import compare, connect

BIG = 1 << 70


def plain(rows):
    data = [(BIG if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in data:
        for k in range(len(w) - p.WINDOW + 1):
            window = tuple(w[k : k + p.WINDOW])
            least[window] = min(i, least.get(window, BIG))
    out = []
    for (key, _), (i, w) in zip(rows, data):
        gone = [False] * len(w)
        for k in range(len(w) - p.WINDOW + 1):
            if least[tuple(w[k : k + p.WINDOW])] < i:
                gone[k : k + p.WINDOW] = [True] * p.WINDOW
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(key), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(x["doc_id"]), x["n_words"], x["n_removed"], x["kept_sha256"]) for x in rows_of(df))


def passage(rng, low, high, vocabulary):
    return [rng.choice(vocabulary) for _ in range(rng.randint(low, high))]


def mixed_rows(seed, n=80, vocabulary=None):
    """Passages of about a window's length among other words, cut and joined at random, and copies of whole texts."""
    rng = random.Random(seed)
    vocabulary = vocabulary or [f"w{i}" for i in range(5000)]
    common = [passage(rng, 30, 150, vocabulary) for _ in range(12)]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            c = rng.choice(common)
            a = rng.randint(0, 20)
            words += rng.choice([c, c[a:], c[: len(c) - a], passage(rng, 0, 90, vocabulary)])
        space = rng.choice([" ", "  ", "\n", "\t \x0b"])
        rows.append((rng.randint(0, 60), space.join(words) + rng.choice(["", " "])))
    return rows + [(rng.randint(0, 90), rng.choice(rows)[1]) for _ in range(25)]


def test_cover():
    differences = {(a - b) % p.PERIOD for a in p.COVER for b in p.COVER}
    assert differences == set(range(p.PERIOD))


def test_whole_table_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(q.op12_anchored_passages(spark, sf), connect(sf), p.ORACLE_SQL) is None


@pytest.mark.parametrize("vocabulary", [None, ["a", "b", "é"], ["a"]])
@pytest.mark.parametrize("batch_bytes", [600, 1 << 20])
def test_shared_passages(spark, vocabulary, batch_bytes):
    rows = mixed_rows(11, vocabulary=vocabulary)
    found = p.passage_digests(docs_of(spark, rows, 5), bin_bytes=8000, part_bytes=4000, batch_bytes=batch_bytes)
    assert got(found) == plain(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(p, "SLICE", 61)
    rng = random.Random(2)
    line = " ".join(passage(rng, 55, 55, [f"x{i}" for i in range(900)]))
    long = " ".join(passage(rng, 3000, 3000, [f"y{i}" for i in range(400)]))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (None, line), (None, line), (None, None), (5, line), (5, line), (5, "z " + line)]
    rows += [(6, long + " " + line), (7, long), (8, line + " " + long), (9, "a " * 5000), (10, "a " * 49), (11, "a " * 50), (0, " ".join(line.split()[:49]))]
    rows += [(i, line) for i in range(100, 160)] + [(i, f"{i} {line} {i + 1}") for i in range(200, 260)]
    for partitions in (1, 7):
        assert got(p.passage_digests(docs_of(spark, rows, partitions), bin_bytes=9000, part_bytes=9000)) == plain(rows)


def test_kept_texts(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, line), (2, f"before {line} after"), (3, "other  words\n")]
    kept = {x["doc_id"]: x["kept"] for x in rows_of(p.remove_passages(docs_of(spark, rows)))}
    assert kept == {1: line, 2: "before after", 3: "other words"}


def test_empty_table(spark):
    assert p.passage_digests(docs_of(spark, [(1, "a")]).limit(0)).count() == 0
