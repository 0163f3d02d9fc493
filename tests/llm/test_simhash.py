import random

import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from foldmark.llm import simhash
from tests.llm.brute import docs_of, rows_of

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_print(text, k=3):
    words = [w for w in text.translate(LOWER).translate({i: 32 for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, distance=3):
    values, root = sorted(values), {}
    for v in values:
        root[v] = v
    find = lambda v: v if root[v] == v else find(root[v])
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def check(spark, rows):
    got = rows_of(simhash.simhash_components(docs_of(spark, rows)))
    prints = [plain_print(t or "") for _, t in rows]
    roots = plain_roots(set(prints))
    names = {}
    for (key, _), p in zip(rows, prints):
        if key is not None:
            names[roots[p]] = min(key, names.get(roots[p], key))
    want = [(str(key), f"{p:016x}", str(names.get(roots[p]))) for (key, _), p in zip(rows, prints)]
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == sorted(want)
    return len(set(names))


def test_documents(spark):
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    check(spark, list(zip(t["doc_id"], t["text"])))


def test_odd_texts(spark):
    rows = [(9, None), (8, ""), (7, " \t"), (None, "lone words here now"), (3, "A b"), (4, "a\x0bB"), (5, "a\xa0b c"), (6, "w " * 20000)]
    check(spark, rows + [(3, "A b")] * 3)
    assert simhash.simhash_components(docs_of(spark, [])).collect() == []


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_links_and_components_of_given_fingerprints(spark):
    rng = random.Random(5)
    values = {0, (1 << 64) - 1}
    for _ in range(12):  # chains in which each value is 0 to 3 bits from the one before
        v = rng.getrandbits(64)
        for _ in range(25):
            values.add(v)
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
    table = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    links = simhash.near_fingerprints(table)
    want = {(min(a, b), max(a, b)) for x in values for y in values if 0 < (x ^ y).bit_count() <= 3 for a, b in [(signed(x), signed(y))]}
    got = [(r["a"], r["b"]) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    for v, root in plain_roots_signed(values).items():
        assert roots.get(v, v) == root


def plain_roots_signed(values):
    groups = {}
    for v, root in plain_roots(values).items():
        groups.setdefault(root, []).append(signed(v))
    return {v: min(g) for g in groups.values() for v in g}


def test_long_path_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert roots == {i: 0 for i in range(201)} | {500: 500, 501: 500}


@given(st.text(alphabet="aB \t\x0b\xa0é", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_by_rule(text):
    assert simhash.fingerprint(simhash.shingle_hashes(text, 3)) % (1 << 64) == plain_print(text)


def test_larger_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_fingerprints(spark.createDataFrame([(1,)], "fingerprint long"), 4)


def near(spark, texts):
    return {r["doc_id"] for r in simhash.near_copies(docs_of(spark, list(enumerate(texts)))).select("doc_id").collect()}


def test_a_repeated_line_makes_no_copy(spark):
    rng = random.Random(3)
    line = " ".join(f"menu{i}" for i in range(12))
    texts = [" ".join([line] * 20 + [f"v{rng.randrange(10**9)}" for _ in range(300)]) for _ in range(12)]
    assert near(spark, texts) == set(range(12))


def changed(rng, words, shared):
    """A text of as many shingles, of which exactly so many are the same: the beginning stays."""
    return words[: shared + 4] + [f"x{rng.randrange(10**9)}" for _ in words[shared + 4 :]]


def test_links_are_of_the_similarity(spark):
    rng, texts, want = random.Random(4), [], set()
    for shared in (225, 231, 240, 255, 264, 267, 270, 285):  # of 300: similarities from 0.60 to 0.90
        for _ in range(8):
            words = [f"v{rng.randrange(10**9)}" for _ in range(304)]
            want |= {len(texts)} | ({len(texts) + 1} if shared < 0.8 * (600 - shared) else set())
            texts += [" ".join(words), " ".join(changed(rng, words, shared))]
    assert near(spark, texts) == want


@pytest.mark.parametrize("size", [4, 5, 9, 20, 40])
def test_short_texts_are_compared_exactly(spark, size):
    rng, texts, want = random.Random(size), [], set()
    for _ in range(25):
        words = [f"v{rng.randrange(10**9)}" for _ in range(size + 4)]
        for cut in (size // 5, size // 5 + 1):  # the longest beginning that is similar, and the next shorter one
            own = [w + str(cut) for w in words]
            want |= {len(texts)} | ({len(texts) + 1} if size - cut < 0.8 * size else set())
            texts += [" ".join(own), " ".join(own[: size + 4 - cut])]
    assert near(spark, texts) == want


def test_similar_sets_in_a_crowd_and_in_blocks(spark, monkeypatch):
    rng, base = random.Random(6), [f"v{i}" for i in range(104)]
    texts = [" ".join(changed(rng, base, 82)) for _ in range(60)] + [" ".join(changed(rng, base, 96)) for _ in range(60)]
    want = set(range(61))  # 82 of 118 are too few; 96 and more of 104 are enough
    assert near(spark, texts) == want
    monkeypatch.setattr(simhash.similar_sets, "__defaults__", (simhash.SHINGLE, 16))
    assert near(spark, texts) == want


def test_components_of_stars_and_chains(spark):
    """Stars, chains and both at once."""
    rng = random.Random(8)
    links = [(1, i) for i in range(2, 60)] + [(i, i + 1) for i in range(100, 130)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    links += [(500, i) for i in range(300, 340)] + [(500, 59)]
    links = [x for x in links if x[0] != x[1]]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for x in parent}
    got = simhash.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(want) and {r["node"]: r["root"] for r in got} == want


def test_rows_of_frequent_prints(spark, monkeypatch):
    rows = [(i, "same words here") for i in range(30)] + [(None, None), (None, "same words here"), (50, "other words there"), (51, "")]
    want = sorted(map(str, rows_of(simhash.simhash_components(docs_of(spark, rows)))))
    monkeypatch.setattr(simhash, "HUBS", 2)
    assert sorted(map(str, rows_of(simhash.simhash_components(docs_of(spark, rows))))) == want and len(want) == len(rows)


def test_dotted_names_are_kept(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None)]
    left = rows_of(simhash.near_copies(docs_of(spark, rows).withColumnRenamed("_tie", "a.b")))
    assert sorted((r["doc_id"], r["a.b"]) for r in left) == [(1, "t"), (3, "t")]
