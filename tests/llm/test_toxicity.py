import numpy as np
import pytest

from foldmark.llm import toxicity
from tests.llm.brute import docs_of, rows_of

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    known = {r["doc_id"]: r for r in labels.collect()}
    seen = labels.where("doc_id % 3 > 0")
    scored = toxicity.score_toxicity(docs, seen).where("doc_id % 3 = 0").collect()
    pairs = [(known[r["doc_id"]]["toxic"], r["toxic"], known[r["doc_id"]]["quality"], r["p_junk"]) for r in scored if r["doc_id"] in known]
    toxic = sum(t for t, *_ in pairs)
    # One label in twenty is on a text without any telling word.
    assert toxic > 50 and sum(t and p for t, p, *_ in pairs) >= 0.9 * toxic
    assert sum(p and not t for t, p, *_ in pairs) <= 0.01 * len(pairs)
    # Junk is told by its form more than by its words: the probability need only be right on the whole.
    assert abs(sum(p for *_, p in pairs) - sum(q == 0 for _, _, q, _ in pairs)) <= 0.03 * len(pairs)


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, quality int, toxic int, text string")


TEXTS = [(i, ("vile scum here " if i % 3 == 0 else "a calm day ") + f"word{i % 7}") for i in range(40)]
LABELS = [(i, 1, int(i % 3 == 0)) for i in range(0, 40)] + [(0, 1, 0), (90, 1, 1), (None, 1, 1), (3, None, 1)]


def test_odd_rows_and_columns(spark):
    rows = TEXTS + [(100, None), (101, ""), (None, "vile scum here"), (102, "scum vile " * 5000), (5, TEXTS[5][1])]
    docs, labels = docs_of(spark, rows), labels_of(spark, LABELS)
    got = rows_of(toxicity.score_toxicity(docs, labels))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    assert {r["doc_id"] for r in got if r["toxic"]} == {i for i, _ in TEXTS if i % 3 == 0} | {None, 102}
    assert all(0 <= r["p_junk"] <= 1 and 0 <= r["p_toxic"] <= 1 for r in got)
    left = rows_of(toxicity.keep_clean(docs, labels))
    assert sorted(str(r["doc_id"]) for r in left) == sorted(str(r["doc_id"]) for r in got if not r["toxic"])
    assert {r["_chunk"] for r in left} == {"c"} and any(r["text"] is None for r in left)


def test_without_labels_or_rows(spark):
    docs = docs_of(spark, TEXTS)
    assert {(r["p_junk"], r["p_toxic"], r["toxic"]) for r in rows_of(toxicity.score_toxicity(docs, labels_of(spark, [])))} == {(0.0, 0.0, 0)}
    assert toxicity.score_toxicity(docs_of(spark, []), labels_of(spark, LABELS)).collect() == []
    same = rows_of(toxicity.score_toxicity(docs, labels_of(spark, [(i, 1, 0) for i in range(40)])))
    assert {r["p_toxic"] for r in same} == {0.0}


def test_sample_is_bounded_and_later_models_learn_from_unseen_rows(spark):
    docs, labels = docs_of(spark, TEXTS), labels_of(spark, LABELS)
    assert toxicity.labelled_sample(docs, labels, toxicity.CHAIN, 7).count() == 7
    model = toxicity.fit_chain(docs, labels_of(spark, [(i, i % 2, int(i % 3 == 0)) for i in range(40)]))
    assert len(model.models["toxic"].before) == 1 and model.models["junk"].before == []


def test_penalised_fit_is_a_minimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6))
    y = (x[:, 0] - 2 * x[:, 1] + rng.normal(size=300) > 0).astype(float)
    b, w = toxicity.fit_penalised(x, y, 0.02, 3000)
    scale = x.std(axis=0)

    def loss(b, w):
        m = b + x @ w
        return np.mean(np.logaddexp(0, m) - y * m) + 0.02 * np.abs(w * scale).sum()

    best = loss(b, w)
    assert (w[2:] == 0).sum() >= 2 and w[0] > 0 > w[1]
    for i in range(6):
        for d in (-1e-3, 1e-3):
            assert loss(b, w + d * (np.arange(6) == i)) >= best - 1e-9


def test_junk_is_told_row_by_row(spark, corpus):
    docs, labels = corpus
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    scored = toxicity.score_toxicity(docs, labels.where("doc_id % 3 > 0")).where("doc_id % 3 = 0").collect()
    pairs = [(quality[r["doc_id"]] == 0, r["p_junk"] >= 0.5) for r in scored if r["doc_id"] in quality]
    assert sum(a == b for a, b in pairs) >= 0.97 * len(pairs)


def test_dotted_names_are_kept(spark):
    docs, labels = docs_of(spark, TEXTS), labels_of(spark, LABELS)
    left, dotted = toxicity.keep_clean(docs, labels), toxicity.keep_clean(docs.withColumnRenamed("_tie", "a.b"), labels)
    assert dotted.columns == docs.withColumnRenamed("_tie", "a.b").columns
    assert sorted(str(r["doc_id"]) for r in rows_of(dotted)) == sorted(str(r["doc_id"]) for r in rows_of(left))
