import random
import re

import pyarrow.parquet as pq

from foldmark.llm import licenses
from tests.llm.brute import docs_of, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows):
    lists = [WORD.findall((t or "").translate(LOWER)) for _, t in rows]
    vocabulary = {w for t in licenses.TEMPLATES for w in t.words}
    idf = licenses.rarities(len(rows), {w: sum(w in x for x in map(set, lists)) for w in vocabulary})
    out = []
    for (key, _), words in zip(rows, lists):
        places, base, labels, score = [], set(), set(), 0.0
        for t in licenses.TEMPLATES:
            n = len(t.key_words)
            for s in range(len(words) - n + 1):
                if words[s : s + n] == t.key_words:
                    labels.add(t.label)
                    if t.base:
                        base.add(t.label)
                        places.append(s)
                    d = s - t.key_at
                    weights = [max(idf[w], 1e-9) for w in t.words]
                    met = sum(x for j, (w, x) in enumerate(zip(t.words, weights)) if 0 <= d + j < len(words) and words[d + j] == w)
                    score = max(score, met / sum(weights))
        first, last = (min(places), max(places)) if places else (None, None)
        out.append((str(key), len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), round(min(1.0, score), 5)))
    return sorted(out, key=str)


def check(spark, rows):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    got = [(str(r["doc_id"]), *(r[c] for c in names), round(r["score"], 5)) for r in rows_of(licenses.scan_licenses(docs_of(spark, rows)))]
    assert sorted(got, key=str) == plain(rows)
    return got


def test_documents(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    assert any(r[6] for r in check(spark, list(zip(t["doc_id"], t["text"]))))


def test_odd_texts(spark):
    line = "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0!"
    rows = [(1, None), (2, ""), (3, "..."), (4, line), (4, line), (None, line), (5, line * 500), (6, "under the MIT"), (7, "UNDER THE MİT license")]
    rows += [(8, "nc by cc by nc"), (9, "license version 2"), (10, "under the mit license"), (11, "x\x00under the\tmit-license9"), (12, "cc by nc nc by cc by nc")]
    check(spark, rows)
    assert licenses.scan_licenses(docs_of(spark, [])).collect() == []


def test_every_template_finds_its_own_wording(spark):
    rows = [(i, "pre " + t.wording + " post") for i, t in enumerate(licenses.TEMPLATES)]
    for r in check(spark, rows):
        assert licenses.TEMPLATES[int(r[0])].label in r[6].split(",") and r[7] > 0.99


def test_random_words_of_the_templates(spark):
    rng = random.Random(4)
    words = sorted({w for t in licenses.TEMPLATES for w in t.words} | {"x", "é"})
    rows = []
    for i in range(60):
        text = []
        for _ in range(12):
            text += [rng.choice(words)] if rng.random() < 0.6 else rng.choice(licenses.TEMPLATES).key_words
        rows.append((i, " ".join(text)))
    check(spark, rows)


def test_files_without_open_templates_look_nothing_up(spark):
    """A file that lacks a word of every key phrase has no hits; one with all of them out of place has hits and no starts."""
    rows = [(1, "apache license license version"), (2, "2 version license apache"), (3, "license version 2 apache license version 2")]
    got = {r[0]: r for r in check(spark, rows)}
    assert (got["1"][2], got["2"][2], got["3"][2], got["3"][3]) == (0, 0, 1, 3)


def test_phrases_of_one_word_and_of_repeated_words(spark, monkeypatch):
    templates = (
        licenses.Template("one", "the zlib license", "zlib", True),
        licenses.Template("twice", "as is as is where is", "as is as is", True),
    )
    monkeypatch.setattr(licenses, "TEMPLATES", templates)
    rows = [(1, "zlib zlib"), (2, "as is as is as is"), (3, "is as is as"), (4, "as as is as is")]
    got = licenses.scan_licenses(docs_of(spark, rows), templates).collect()
    plainly = {r[0]: r for r in plain(rows)}
    assert {str(r["doc_id"]): (r["n_base"], r["first_word"], r["last_word"], r["labels"]) for r in got} == {
        k: (r[2], r[3], r[4], r[6]) for k, r in plainly.items()
    }
    assert [plainly[k][2] for k in "1234"] == [2, 2, 0, 1]
