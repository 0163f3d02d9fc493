import math
import random

import pyarrow.parquet as pq

from foldmark.llm import topk
from tests.llm.brute import rows_of


def plain(rows, k=5, every=50):
    whole = [(i, [math.floor(x * 256) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, list(v)) for i, v in {(i, tuple(v)) for i, v in whole}]
    out = []
    for q, a in whole:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def table(spark, rows):
    data = [(i, v, 1, 2, "x") for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, node int, v string").repartition(3)


def check(spark, rows):
    got = rows_of(topk.top_products(table(spark, rows)))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == plain(rows)


def test_embeddings(spark):
    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pydict()
    check(spark, list(zip(t["vec_id"], t["embedding"])))


def test_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-2, 2)) / 4 for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(120)] + [(1000, [1.0, 1.0, 1.0, 1.0])] * 3
    rows += [(2000, None), (2050, [None, 1.0, 0.0, 0.0]), (2100, [float("nan"), 0.0, 0.0, 0.0]), (2101, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [9.0, 9.0, 9.0, 9.0]), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3050, []), (3051, []), (4000, [5.0]), (5000, [-3.0, -3.0, -3.0, -3.0])]
    check(spark, rows)


def test_few_rows_and_none(spark):
    check(spark, [(0, [1.0, 2.0]), (7, [0.5, 0.25]), (50, [1.0, 2.0])])
    check(spark, [(0, [1.0, 2.0])])
    check(spark, [])


def test_large_components_stay_exact(spark):
    check(spark, [(0, [3e5, 1.0]), (1, [3e5, -1.0]), (2, [-3e5, 7.0]), (50, [4e6, 4e6])])
