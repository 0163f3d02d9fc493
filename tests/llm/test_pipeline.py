import re

import pytest

import corpus_pipeline
from foldmark.llm import simhash
from foldmark.session import cut_lineage
from tests.llm.brute import docs_of, rows_of

SF = "/root/testdata/sf0.01"


def shingles(text, k=5):
    words = text.encode().lower().split()
    return frozenset(b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def similar_pairs(rows, least=0.8):
    sets, holders = {i: shingles(t or "") for i, t in rows}, {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    met = {(a, b) for found in holders.values() for a in found for b in found if a < b}
    return {(a, b) for a, b in met if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = cut_lineage(stage(spark, docs, SF))
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_return_documents(stages):
    names = list(stages)
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes
    ids = [set(by_id(stages[n])) for n in names[:-1]]
    for before, after in zip(ids, ids[1:]):
        assert after <= before and len(after) > 0.7 * len(before)


def test_toxicity(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = set(by_id(stages["toxicity"]))
    toxic = [i for i, t in labels.items() if t]
    assert sum(i not in left for i in toxic) >= 0.85 * len(toxic)
    assert sum(i in left for i, t in labels.items() if not t) >= 0.99 * (len(labels) - len(toxic))


def test_near_duplicates(stages):
    before = {i: r["text"] for i, r in by_id(stages["toxicity"]).items()}
    left = set(by_id(stages["near_duplicates"]))
    pairs = similar_pairs(before.items())
    assert sum(not (a in left and b in left) for a, b in pairs) >= 0.95 * len(pairs)
    loose = {i for p in similar_pairs(before.items(), 0.4) for i in p}
    assert set(before) - left <= loose  # nothing goes that has no likeness


def test_near_copies_recall_on_the_larger_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    left = {r["doc_id"] for r in simhash.near_copies(docs).select("doc_id").collect()}
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t, i)
    assert left <= set(first.values())
    pairs = similar_pairs([(i, t) for t, i in first.items()])
    assert len(pairs) > 10 and sum(not (a in left and b in left) for a, b in pairs) >= 0.95 * len(pairs)


def test_decontamination(spark, stages):
    items = [re.findall(r"\w+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = [" " + " ".join(w) + " " for w in items]
    norm = lambda r: " " + " ".join(re.findall(r"\w+", r["text"].lower())) + " "
    before, left = by_id(stages["near_duplicates"]), set(by_id(stages["decontamination"]))
    leaks = {i for i, r in before.items() if any(h in norm(r) for h in held)}
    assert leaks and not leaks & left and len(set(before) - left) <= 1.2 * len(leaks)


def test_personal_data(stages):
    before, after = by_id(stages["decontamination"]), by_id(stages["personal_data"])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r["text"])
        assert r["n_chars"] == len(r["text"])
    assert any(before[i]["text"] != after[i]["text"] for i in after)


def test_packing_and_run(spark, stages):
    pieces = stages["packing"].collect()
    assert {r["doc_id"] for r in pieces} == set(by_id(stages["personal_data"]))
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, pieces))


def test_near_copies_of_odd_rows(spark):
    a, b = " ".join(f"w{i}" for i in range(300)), " ".join(f"v{i}" for i in range(300))
    rows = [(4, a), (3, a + " more"), (None, a), (9, b), (9, b), (8, None), (7, ""), (5, " \n"), (1, "short"), (2, "Short")]
    got = rows_of(simhash.near_copies(docs_of(spark, rows)))
    assert sorted(r["doc_id"] for r in got) == [1, 3, 5, 9] and {r["_chunk"] for r in got} == {"c"}
    assert simhash.near_copies(docs_of(spark, [])).collect() == []


def test_a_crowded_meeting_is_split(spark):
    data = [(i, *[(i * 7919 + w) & 255 if i % 2 else (1 << i % 60) for w in range(4)]) for i in range(120)]
    nodes = spark.createDataFrame(data, "node long, w0 long, w1 long, w2 long, w3 long")
    roots = [
        {r["node"]: r["root"] for r in simhash.components(simhash.similar_fingerprints(nodes, 12, size)).collect()} for size in (8192, 10)
    ]
    assert roots[0] == roots[1] and roots[0]
    words = {d[0]: d[1:] for d in data}
    link = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(words[a], words[b])) <= 12
    near = {(a, b) for a in words for b in words if a < b and link(a, b)}
    for a, b in near:  # each such pair shares a segment up to one bit here
        assert roots[0].get(a, a) == roots[0].get(b, b)


def test_near_duplicates_are_of_the_similarity(stages):
    before = {i: r["text"] for i, r in by_id(stages["toxicity"]).items()}
    left = set(by_id(stages["near_duplicates"]))
    linked = {i for p in similar_pairs(before.items()) for i in p}
    assert set(before) - left <= linked | {i for i, t in before.items() if not shingles(t or "")}


def test_columns_of_any_name_go_through(spark):
    docs = docs_of(spark, [(1, "mail a@b.org now"), (2, None), (3, "plain words")]).withColumnRenamed("_tie", "a.b")
    masked = corpus_pipeline.mask_personal_data(spark, docs, SF)
    assert masked.columns == docs.columns and {r["a.b"] for r in rows_of(masked)} == {"t"}
