import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from foldmark.llm import decontamination as d
from tests.llm.brute import docs_of, rows_of

SF = "/root/testdata/sf0.001"


def plain_score(item, words):
    """Smith-Waterman cell by cell over the whole text."""
    above, best = [0] * (len(words) + 1), 0
    for w in item:
        row = [0]
        for j, v in enumerate(words):
            row.append(max(0, above[j] + (d.MATCH if v == w else d.MISS), above[j + 1] + d.GAP, row[j] + d.GAP))
        best, above = max(best, *row), row
    return best / (d.MATCH * len(item))


def words(text):
    return d.WORD.findall((text or "").lower())


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, doc_id int, score string")


@pytest.fixture(scope="module")
def tables():
    docs = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    return list(zip(docs["doc_id"], docs["text"])), list(zip(bench["item_id"], bench["text"]))


def test_documents_against_alignment_of_everything(spark, tables):
    docs, items = tables
    docs = [r for r in docs if len(words(r[1])) < 400][:60] + [r for r in docs if any(t in r[1] for _, t in items)]
    got = rows_of(d.find_leaks(docs_of(spark, docs), items_of(spark, items)))
    want = sorted((i, j) for i, t in docs for j, x in items if plain_score(words(x), words(t)) >= d.THRESHOLD)
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == want and want


def test_edited_copies(spark, tables):
    docs, items = tables
    rng = random.Random(2)
    rows, want = [], set()
    for i, (item_id, text) in enumerate(items):
        w = words(text)
        for k in range(0, len(w), 9):  # every ninth word is changed, lost or doubled
            w[k] = rng.choice(["other", "", w[k] + " " + w[k]])
        rows.append((1000 + i, " ".join(["before it"] * 30 + w + ["after it"] * 30)))
        want.add((1000 + i, item_id))
    got = rows_of(d.find_leaks(docs_of(spark, rows), items_of(spark, items)))
    assert {(r["doc_id"], r["item_id"]) for r in got} >= want
    for r in got:
        assert r["first_word"] >= 55 and r["first_word"] < r["last_word"]


def test_alignment_by_cells():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 25))
        assert d.align(a, b)[0] / (d.MATCH * len(a)) == plain_score(a.tolist(), b.tolist())


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "alpha beta gamma delta epsilon zeta eta theta"), (3, "two words"), (4, None), (None, "one two three four five")]
ROWS = [(1, None), (2, ""), (3, "so ALPHA beta, gamma delta epsilon zeta eta theta!"), (3, "so ALPHA beta, gamma delta epsilon zeta eta theta!")]
ROWS += [(None, "one two three four five"), (4, "two words"), (5, "x " * 5000 + "one two three four five " * 300), (6, "alpha beta gamma only")]


def test_odd_rows(spark):
    got = sorted(str((r["doc_id"], r["item_id"], r["score"])) for r in rows_of(d.find_leaks(docs_of(spark, ROWS), items_of(spark, ITEMS))))
    assert got == sorted(map(str, [(3, 1, 1.0), (3, 2, 1.0), (3, 1, 1.0), (3, 2, 1.0), (None, None, 1.0), (5, None, 1.0)]))


def test_slices_change_nothing(spark, monkeypatch, tables):
    docs, items = tables
    run = lambda: sorted(map(str, rows_of(d.find_leaks(docs_of(spark, docs[:80]), items_of(spark, items)))))
    whole = run()
    monkeypatch.setattr(d, "SLICE_BYTES", 2000)
    assert [x.split("'score'")[0] for x in run()] == [x.split("'score'")[0] for x in whole]


def test_dropping(spark):
    left = rows_of(d.drop_leaks(docs_of(spark, ROWS), items_of(spark, ITEMS)))
    assert sorted(str(r["doc_id"]) for r in left) == ["1", "2", "4", "6"]
    assert {r["_chunk"] for r in left} == {"c"} and {r["part"] for r in left} == {7}
    assert len(rows_of(d.drop_leaks(docs_of(spark, ROWS), items_of(spark, [])))) == len(ROWS)
    assert d.find_leaks(docs_of(spark, []), items_of(spark, ITEMS)).collect() == []
    assert d.drop_leaks(docs_of(spark, []), items_of(spark, ITEMS)).collect() == []


@pytest.mark.parametrize("every", [4, 5, 6])
def test_regular_edits_against_alignment_of_everything(spark, tables, every):
    items, rng = tables[1], random.Random(every)
    rows = []
    for i, (_, text) in enumerate(items):
        w = words(text)
        w[every - 1 :: every] = [f"other{rng.randrange(9)}" for _ in w[every - 1 :: every]]
        rows.append((1000 + i, " ".join(["before it"] * 30 + w + ["after it"] * 30)))
    got = rows_of(d.find_leaks(docs_of(spark, rows), items_of(spark, items)))
    full = {(i, j): plain_score(words(x), words(t)) for i, t in rows for j, x in items}
    want = {k: s for k, s in full.items() if s >= d.THRESHOLD}
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == want and len(want) >= len(items)


def test_words_put_in_and_left_out(spark):
    item = [f"w{i}" for i in range(30)]
    long = [x for i, w in enumerate(item) for x in ([w] if i % 3 or not i else ["more", w])]
    late = [x for w in item[:15] for x in ("so", w)] + item[15:]
    rows = [(1, " ".join(long)), (2, " ".join(item[:8] + item[12:])), (3, " ".join(late)), (4, " ".join(item[:8]))]
    got = rows_of(d.find_leaks(docs_of(spark, rows), items_of(spark, [(7, " ".join(item))])))
    want = {i: plain_score(item, words(t)) for i, t in rows if plain_score(item, words(t)) >= d.THRESHOLD}
    assert {r["doc_id"]: r["score"] for r in got} == want and set(want) == {1, 2, 3}


def test_more_words_than_numbers_of_ngrams(monkeypatch):
    """Beyond two million words the numbers of n-grams wrap: seeds may be too many, never too few."""
    text = "one two three four five six"
    index = d.Index.of([(1, text)])
    want = index.leaks("so " + text)
    index.words |= {f"x{i}": 7 + i for i in range(3 << 20)}
    index.add_seeds()
    assert index.leaks("so " + text) == want and want[0][:2] == (1, 1.0)
    assert (index.codes(index.items[0][1]) >= 0).all() and (index.codes(index.numbers("x5 x2000000 x3000000")) >= 0).all()
    assert (index.codes(index.numbers("x5 unheard x3")) == -1).all()


def test_dropping_by_slices(spark, monkeypatch):
    monkeypatch.setattr(d, "SLICE_BYTES", 20)
    left = rows_of(d.drop_leaks(docs_of(spark, ROWS).withColumnRenamed("_tie", "a.b`c"), items_of(spark, ITEMS)))
    assert sorted(str(r["doc_id"]) for r in left) == ["1", "2", "4", "6"] and {r["a.b`c"] for r in left} == {"t"}
