import hashlib
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foldmark.llm import pii
from tests.llm.brute import docs_of, rows_of

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 13 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0
    return True


def plain(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if passes(k, m[0])] for k, p in PATTERNS.items()}


@given(st.text(alphabet="a1 2.@-+()_\n9", max_size=60))
@settings(max_examples=500, deadline=None)
def test_base_spans_by_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


ODD = ["a@b.co_x@d.com", "1.2.3.4.5.6.7.8 256.1.1.1 0000000255.1.1.1", "4111 1111 1111 1111-", "+1 (709) 555-6652 27.189.188.194", "@a.b x@@y.z", "0" * 6000 + ".1.1.1", "x" * 50000, "1" * 50000, "+1 " * 3000]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    if len(text) < 5000:
        assert pii.base_spans(text) == plain(text)
    field = pii.Field()
    pii.all_spans(text, field)


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit_field(spark.read.parquet(f"{SF}/documents.parquet"))


def test_query_rows(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    rows = list(zip(t["doc_id"], t["text"])) + [(None, "mail a@b.org"), (-1, None), (-2, ""), (-3, ODD[3]), (-3, ODD[3]), (-4, "word " * 9000 + "1.2.3.4")]
    got = {}
    for r in rows_of(pii.find_personal_data(docs_of(spark, rows))):
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for key, text in rows:
        base = plain(text)
        listed = pii.listed(base)
        for r in got[key]:
            assert [r[f"n_{k}"] for k in PATTERNS] == [len(base[k]) for k in PATTERNS]
            assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
            assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))
    assert pii.find_personal_data(docs_of(spark, [])).collect() == []


def test_field_relearns_the_rules_on_other_texts(spark, field):
    """Held out: regions of the larger table, without the base spans as a help."""
    right = wrong = missed = 0
    for row in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 4 = 1").select("text").collect():
        base = pii.base_spans(row["text"])
        for chunks in pii.regions(row["text"]):
            truth = pii.labelled(row["text"], chunks, base)
            if truth is None:
                continue
            want = {t for t in truth if t[2]}
            found = {t for t in field.best(row["text"], chunks) if t[2]}
            right, wrong, missed = right + len(want & found), wrong + len(found - want), missed + len(want - found)
    assert right > 100 and right >= 0.97 * (right + missed) and right >= 0.97 * (right + wrong)


def test_field_adds_what_the_rules_miss(field):
    text = "Call 1 (709) 555-6652 or mail a.b@c.org today, version 3 of 2021."
    base, every = pii.all_spans(text, field)
    assert base["phone"] == [] and [text[s:e] for s, e in every["phone"]] == ["1 (709) 555-6652"]
    assert pii.masked(text, every) == "Call <PHONE> or mail <EMAIL> today, version 3 of 2021."


def brute_best(field, text, chunks):
    segments, n = field._segments(text, chunks), len(chunks)

    def ways(i, before, score, path):
        if i == n:
            yield score, path
        for j in range(i + 1, min(n, i + pii.MAX_CHUNKS) + 1):
            for kind in range(field.n):
                own = segments[i, j][1][kind]
                if np.isfinite(own):
                    yield from ways(j, kind, score + own + field.after[before, kind], [*path, (i, j, kind)])

    return list(ways(0, field.n, 0.0, []))


def test_dynamic_program_and_gradient_against_all_segmentations():
    rng = np.random.default_rng(1)
    text = "1 a@b.co 22 3"
    chunks = next(pii.regions(text))
    field = pii.Field()
    field.after = rng.normal(size=field.after.shape)
    for found, _ in field._segments(text, chunks).values():
        for f in found:
            field.weights.setdefault(f, rng.normal(size=field.n))
    ways = brute_best(field, text, chunks)
    assert field.best(text, chunks) == max(ways, key=lambda w: w[0])[1]
    truth = ways[5][1]
    whole = np.logaddexp.reduce([s for s, _ in ways])
    before = {k: v.copy() for k, v in field.weights.items()}
    after = field.after.copy()
    assert field.step(text, chunks, truth, 1e-6) == pytest.approx(ways[5][0] - whole)
    f = "digits 1"
    for kind in range(field.n):
        copy = pii.Field()
        copy.after, copy.weights = after.copy(), {k: v.copy() for k, v in before.items()}
        copy.weights[f][kind] += 1e-5
        moved = brute_best(copy, text, chunks)
        value = next(s for s, p in moved if p == truth) - np.logaddexp.reduce([s for s, _ in moved])
        slope = (value - (ways[5][0] - whole)) / 1e-5
        step = (field.weights[f][kind] - before[f][kind] * (1 - 1e-4)) / 1e-6
        assert step == pytest.approx(slope, abs=1e-3)


def test_masking_keeps_other_columns(spark):
    rows = [(1, "a@b.org x"), (2, None), (3, "")]
    got = {r["doc_id"]: r for r in rows_of(pii.mask_personal_data(docs_of(spark, rows)))}
    assert got[1]["text"] == "<EMAIL> x" and got[2]["text"] is None and got[3]["text"] == "" and got[1]["_chunk"] == "c"


def plain_best(field, text, chunks):
    """The dynamic program with all segments held at once."""
    segments, n = field._segments(text, chunks), len(chunks)
    score, back = np.full((n + 1, field.n + 1), -np.inf), {}
    score[0, field.n] = 0
    for j in range(1, n + 1):
        for i in range(max(0, j - pii.MAX_CHUNKS), j):
            enter = score[i][:, None] + field.after
            total = enter.max(axis=0) + segments[i, j][1]
            for kind in np.flatnonzero(total > score[j, : field.n]):
                score[j, kind], back[j, int(kind)] = total[kind], (i, int(enter[:, kind].argmax()))
    out, j, kind = [], n, int(score[n, : field.n].argmax())
    while j:
        i, before = back[j, kind]
        out.append((i, j, kind))
        j, kind = i, before
    return out[::-1]


def test_long_regions_by_a_window(field):
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 60, 400):
        text = " ".join(rng.choice(["1", "555", "a@b.co", "+1", "(709)", "6652-11", "4111"], size))
        for chunks in pii.regions(text):
            assert field.best(text, chunks) == plain_best(field, text, chunks)


def test_memory_of_a_long_region(field):
    import tracemalloc

    text = "17 " * 5000
    chunks = next(pii.regions(text))
    tracemalloc.start()
    assert [s[1] for s in field.best(text, chunks)][-1] == len(chunks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 * len(chunks)


def test_the_whole_shape_counts():
    start = "1a" * 30
    assert pii.features(start + "2", 1) != pii.features(start + "2b", 1)


def test_masking_odd_tables(spark):
    rows = [(1, "a@b.org x"), (1, "a@b.org x"), (2, "7 " * 3000 + "1.2.3.4")]
    got = rows_of(pii.mask_personal_data(docs_of(spark, rows).withColumnRenamed("_tie", "a.b")))
    # The field of such a table knows little: what it adds to the long text is its own matter, the base spans stay.
    assert [r["text"] for r in got if r["doc_id"] == 1] == ["<EMAIL> x"] * 2 and all(r["a.b"] == "t" for r in got)
    assert [r["text"][-4:] for r in got if r["doc_id"] == 2] == ["<IP>"]
    assert pii.mask_personal_data(docs_of(spark, [])).collect() == []
