"""License scans with a positional index of templates, entered by each file's rarest licence words. DataFrame functions only.

A template is a license's wording with one key phrase in it that must stand word for word. The postings of the index say
at which places of which key phrases a word stands. A file is scanned in four steps, all inside its row:

1. Its licence words, the highest inverse document frequency (over all files) first. A template is open if the file has
   every word of its key phrase; a file without an open template is done.
2. The file's rarest words are looked up, from the rarest on as far as each open template needs to have ``LOOKUPS`` of its
   words among them.
3. A looked-up word's place in the file less its place in a phrase is a start. The starts of a template's looked-up words
   are intersected: the words must stand at the same places relative to each other as in the phrase.
4. The whole key phrase is verified at the starts left. The template's other words at their relative places, weighted by
   rarity, give the score.

No start is lost: at a true one each word of the phrase, so each looked-up one, stands at its place. There is no shuffle but that
of the counts.

Words: A-Z lowered, cut at every ASCII character but digits and letters. Defined results: a null or empty text has no words,
no labels (empty strings) and score 0; equal rows give equal rows; an empty table gives an empty one; other
columns are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import lower_ascii, texts

#: What separates words once A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    wording: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.wording.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key_words)


# The wording of public licenses, of their notices and of the usual references to them.
TEMPLATES = (
    Template("mit", "licensed under the mit license", "under the mit license", True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the"
        " software to deal in the software without restriction including without limitation the rights to use copy modify merge publish"
        " distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject"
        " to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the software",
        "hereby granted free of charge",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org"
        " licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "www apache org licenses license 2 0",
    ),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
        " published by the free software foundation either version",
        "under the terms of the gnu general public license as published by the free software foundation",
    ),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this"
        " file you can obtain one at",
        "mozilla public license v 2",
    ),
    Template("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions"
        " are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistribution and use in source and binary forms",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the"
        " above copyright notice and this permission notice appear in all copies",
        "use copy modify and or distribute this software",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or"
        " distribute this software",
        "free and unencumbered software",
    ),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
)

#: So many words of an open template are looked up, or all if its key phrase has fewer different ones.
LOOKUPS = 2


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Over all files: how many there are, and how many hold each word of the templates."""
    held = words.select(F.explode(F.array_append(F.array_intersect(_strings(vocabulary), "words"), F.lit(""))).alias("w"))
    found = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return found.get("", 0), {w: found.get(w, 0) for w in vocabulary}


def rarities(n_files: int, counts: dict[str, int]) -> dict[str, float]:
    return {w: math.log((n_files + 1) / (n + 1)) for w, n in counts.items()}


def postings_of(templates: tuple[Template, ...]) -> dict[str, list[tuple[int, int]]]:
    """Of each word of the key phrases: (template, place in its key phrase). A word that a phrase repeats is posted at its first place."""
    out: dict[str, list[tuple[int, int]]] = {}
    for number, t in enumerate(templates):
        for word in dict.fromkeys(t.key_words):
            out.setdefault(word, []).append((number, t.key_words.index(word)))
    return out


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    files = texts(docs).select("doc_id", words_of(F.col("text")).alias("words"))
    idf = rarities(*document_frequencies(files, sorted({w for t in templates for w in t.words})))
    postings = postings_of(templates)
    ranked = sorted(postings, key=lambda w: (-idf[w], w))
    looked_up = [[w for w in ranked if w in t.key_words][:LOOKUPS] for t in templates]

    word = lambda i: F.get("words", i)
    none = F.array().cast("array<int>")

    # 1. The intersection keeps the order of its first side: the file's licence words, the rarest first.
    held = files.withColumn("held", F.array_intersect(_strings(ranked), "words"))
    is_open = [F.size(F.array_except(_strings(sorted(set(t.key_words))), F.col("held"))) == 0 for t in templates]
    opened = held.select("*", *[c.alias(f"open{i}") for i, c in enumerate(is_open)])

    # 2. As far down as the last looked-up word of any open template.
    depth = F.greatest(F.lit(0), *[F.when(F.col(f"open{i}"), F.array_position("held", F.lit(ws[-1]))).otherwise(0) for i, ws in enumerate(looked_up)])
    rarest = opened.withColumn("rarest", F.slice("held", F.lit(1), depth.cast("int")))
    everywhere = F.sequence(F.lit(0), F.size("words") - 1)
    hits = F.when(F.size("rarest") > 0, F.filter(everywhere, lambda i: F.array_contains("rarest", word(i)))).otherwise(none)
    entered = rarest.withColumn("hits", hits)

    # 3. and 4.
    def starts_by(w: str, at: int) -> Column:
        return F.transform(F.filter("hits", lambda i: word(i) == w), lambda i: i - at)

    def starts(number: int, t: Template) -> Column:
        lists = [starts_by(w, dict(postings[w])[number]) for w in looked_up[number]]
        met = lists[0]
        for other in lists[1:]:
            met = F.array_intersect(met, other)
        size = len(t.key_words)
        return F.filter(met, lambda s: (s >= 0) & (F.slice("words", F.greatest(s, F.lit(0)) + 1, size) == _strings(t.key_words)))

    found = entered.select("doc_id", "words", *[F.when(F.col(f"open{i}"), starts(i, t)).otherwise(none).alias(f"s{i}") for i, t in enumerate(templates)])

    def fit(i: int, t: Template) -> Column:
        """The share of the template's weight that stands at its places, at the best start."""
        weights = [max(idf[w], 1e-9) for w in t.words]
        wording = F.array(*[F.struct(F.lit(j - t.key_at).alias("at"), F.lit(w).alias("w"), F.lit(x).alias("x")) for j, (w, x) in enumerate(zip(t.words, weights, strict=True))])
        met = lambda s: F.aggregate(wording, F.lit(0.0), lambda total, p: total + F.when(word(s + p["at"]) == p["w"], p["x"]).otherwise(0.0))
        return F.when(F.size(f"s{i}") > 0, F.array_max(F.transform(f"s{i}", met)) / sum(weights)).otherwise(0.0)

    base = [i for i, t in enumerate(templates) if t.base]
    places = F.concat(*[F.col(f"s{i}") for i in base])

    def labels(which) -> Column:
        held = F.array(*[F.when(F.size(f"s{i}") > 0, F.lit(templates[i].label)) for i in which])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(held))), ",")

    return found.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(range(len(templates))).alias("labels"),
        F.least(F.lit(1.0), F.greatest(*[fit(i, t) for i, t in enumerate(templates)])).alias("score"),
    )
