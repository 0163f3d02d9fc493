"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of the passages around them.

Every n-gram of a test item is a seed, common or rare: which ones an edit leaves can't be known beforehand. A seed in a
document, less its place in the item, says where the item would start; the stretches around such starts are aligned with
the item, word by word: ``MATCH`` for an equal word, ``MISS`` for another one, ``GAP`` for a word too many or too few. The
score is the best local alignment's over that of the whole item.

A stretch is as wide as an alignment of THRESHOLD through its seed can be. It is left out only if none can reach THRESHOLD:
m equal words in runs with t whole n-grams make at least (m - t) / (N - 1) runs, and each run after the first costs an edit;
m is at most the words that item and stretch have in common, t the item's n-grams found.

The test items form an index of bounded size, some nine times their text: about ``SLICE_BYTES`` of them at a time, and as many scans of
the documents as there are slices. What a slice leaves is written once the next index is built, so a worker holds one and the driver
two at most. All else happens inside a document's row; results are rows of documents and items.

No n-gram is passed over for being common: an alignment may reach THRESHOLD on one whole n-gram, whichever it is (in a copy with a
word put in after every second one, say, and one stretch left alone), so no choice of rare ones has all copies.

Words: runs of letters, digits and underscores, lower-cased. Defined results: null and empty texts have no words;
items of fewer than N words can't be told from ordinary text and match nothing; equal rows give equal rows, equal
items are each reported; empty tables give an empty result (or leave all documents); other columns are left out by
``find_leaks`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, keep_texts, spread_texts
from foldmark.session import cut_lineage

N = 3
MATCH, MISS, GAP = 2, -1, -1
THRESHOLD = 0.6
SLICE_BYTES = 16 << 20
WORD = re.compile(r"\w+")
LEAKS = "doc_id long, item_id long, score double, first_word long, last_word long"


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score and where it ends in the passage; the first of equals."""
    steps = np.arange(len(passage) + 1) * -GAP
    above, best, end = np.zeros(len(passage) + 1, "i8"), 0, 0
    for word in item:
        row = np.zeros_like(above)
        row[1:] = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISS), above[1:] + GAP)
        # A gap of any length in the item's direction: the best start to the left, less its length.
        above = np.maximum.accumulate(np.maximum(row, 0) + steps) - steps
        top = int(above.argmax())
        if above[top] > best:
            best, end = int(above[top]), top
    return best, end


@dataclass
class Index:
    """Test items as word numbers; their n-grams as single numbers, each with its items and places."""

    items: list[tuple[int | None, np.ndarray]]
    words: dict[str, int]
    seeds: np.ndarray = field(default_factory=lambda: np.empty(0, "i8"))
    #: Where each seed's rows begin in ``places``: (item, place).
    first: np.ndarray = field(default_factory=lambda: np.empty(0, "i8"))
    places: np.ndarray = field(default_factory=lambda: np.empty((0, 2), "i8"))
    #: Where each item's rows begin in ``bags``: (word, how often).
    bag_first: np.ndarray = field(default_factory=lambda: np.empty(0, "i8"))
    bags: np.ndarray = field(default_factory=lambda: np.empty((0, 2), "i8"))

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> Index:
        words: dict[str, int] = {}
        items = []
        for item_id, text in rows:
            numbers = [words.setdefault(w, len(words) + 1) for w in WORD.findall((text or "").lower())]
            if len(numbers) >= N:
                items.append((item_id, np.array(numbers, "i8")))
        index = cls(items, words)
        if items:
            index.add_seeds()
        return index

    def add_seeds(self) -> None:
        codes = [self.codes(item) for _, item in self.items]
        sizes = [len(c) for c in codes]
        flat = np.concatenate(codes)
        order = np.argsort(flat, kind="stable")
        self.seeds, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, len(flat))
        places = np.concatenate([np.arange(n) for n in sizes])
        self.places = np.stack([np.repeat(np.arange(len(sizes)), sizes), places], axis=1)[order]
        bags = [np.stack(np.unique(item, return_counts=True), axis=1) for _, item in self.items]
        self.bag_first = np.cumsum([0, *map(len, bags)])
        self.bags = np.concatenate(bags)

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        """The n-gram that starts at each place, -1 if it holds an unknown word.

        Of more than two million words the numbers wrap and two n-grams may share one: a seed too many, which the alignment settles.
        """
        n = len(numbers) - N + 1
        if n <= 0:
            return np.empty(0, "i8")
        out, known = np.zeros(n, "i8"), np.ones(n, bool)
        for i in range(N):
            out = out * (len(self.words) + 1 | 1) + numbers[i : i + n]
            known &= numbers[i : i + n] > 0
        return np.where(known, out & np.iinfo("i8").max, -1)

    def numbers(self, text: str) -> np.ndarray:
        get = self.words.get
        return np.array([get(w, 0) for w in WORD.findall(text.lower())], "i8")

    def leaks(self, text: str) -> list[tuple[int | None, float, int, int]]:
        """(item_id, score, first word, last word) of each item whose best alignment reaches THRESHOLD."""
        numbers = self.numbers(text)
        codes = self.codes(numbers)
        if not len(codes) or not len(self.seeds):
            return []
        slot = np.minimum(np.searchsorted(self.seeds, codes), len(self.seeds) - 1)
        hits = np.flatnonzero(self.seeds[slot] == codes)
        if not len(hits):
            return []
        held, where = np.unique(slot[hits], return_inverse=True)
        rows = _ranges(self.first[held], self.first[held + 1])
        found, grams = np.unique(self.places[rows, 0], return_counts=True)
        found = found[self._may_reach(found, grams, numbers)]
        if not len(found):
            return []
        rows = rows[np.isin(self.places[rows, 0], found)]
        # Places of each item's n-grams in the document, by the n-gram's rank among those held.
        seed_of = np.searchsorted(self.first, rows, side="right") - 1
        by_item = np.argsort(self.places[rows, 0], kind="stable")
        cuts = np.searchsorted(self.places[rows, 0][by_item], np.append(found, len(self.items)))
        by_seed = hits[np.argsort(where, kind="stable")]
        seed_cuts = np.cumsum(np.append(0, np.bincount(where, minlength=len(held))))
        local = np.zeros(len(self.words) + 1, "i8")
        out = []
        for i, number in enumerate(found.tolist()):
            item_id, item = self.items[number]
            mine = by_item[cuts[i] : cuts[i + 1]]
            ranks, places = np.searchsorted(held, seed_of[mine]), self.places[rows[mine], 1]
            stretches = self._stretches(number, numbers, local, by_seed, seed_cuts, ranks, places)
            best = max((self._aligned(item, numbers, *s) for s in stretches), key=lambda x: (x[0], -x[1]), default=(0, 0, 0))
            if best[0] >= THRESHOLD * MATCH * len(item):
                out.append((item_id, best[0] / (MATCH * len(item)), best[1], best[2]))
        return out

    def _may_reach(self, found: np.ndarray, grams: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Which items can reach THRESHOLD somewhere in a document, by its words and the number of the item's n-grams found."""
        words, times = np.unique(numbers, return_counts=True)
        low, high = self.bag_first[found], self.bag_first[found + 1]
        bag = self.bags[_ranges(low, high)]
        at = np.minimum(np.searchsorted(words, bag[:, 0]), len(words) - 1)
        shared = np.where(words[at] == bag[:, 0], np.minimum(times[at], bag[:, 1]), 0)
        common = np.add.reduceat(shared, np.cumsum(np.append(0, (high - low)[:-1])))
        lengths = np.array([len(self.items[n][1]) for n in found.tolist()])
        return _bound(common, grams) >= THRESHOLD * MATCH * lengths

    def _stretches(self, number, numbers, local, by_seed, seed_cuts, ranks, places) -> list[tuple[int, int]]:
        """Where an alignment of THRESHOLD may lie: around the starts that the item's n-grams give, overlapping ones joined."""
        item = self.items[number][1]
        least, slack = THRESHOLD * MATCH * len(item), math.ceil((1 - THRESHOLD) * MATCH / -GAP * len(item))
        hit, starts = np.zeros(len(numbers) + 1, "i8"), np.zeros(len(numbers) + len(item), bool)
        for rank, place in zip(ranks.tolist(), places.tolist(), strict=True):
            at = by_seed[seed_cuts[rank] : seed_cuts[rank + 1]]
            hit[at + 1] = 1
            starts[at - place + len(item)] = True
        start = np.flatnonzero(starts) - len(item)
        low, high = np.maximum(start - slack, 0), np.minimum(start + len(item) + slack, len(numbers))
        bag = self.bags[self.bag_first[number] : self.bag_first[number + 1]]
        local[bag[:, 0]] = np.arange(1, len(bag) + 1)
        mine = local[numbers]
        local[bag[:, 0]] = 0
        known, hit = np.cumsum(np.append(0, mine > 0)), np.cumsum(hit)
        grams = np.minimum(hit[high] - hit[low], len(places))
        maybe = np.flatnonzero(_bound(np.minimum(known[high] - known[low], len(item)), grams) >= least)
        out: list[tuple[int, int]] = []
        for a, b, t in zip(low[maybe].tolist(), high[maybe].tolist(), grams[maybe].tolist(), strict=True):
            common = np.minimum(np.bincount(mine[a:b], minlength=len(bag) + 1)[1:], bag[:, 1]).sum()
            if _bound(common, t) < least:
                continue
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    def _aligned(self, item: np.ndarray, numbers: np.ndarray, start: int, end: int) -> tuple[int, int, int]:
        passage = numbers[start:end]
        score, last = align(item, passage)
        back = align(item[::-1], passage[:last][::-1])[1]
        return score, start + last - back, start + last - 1


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = high - low
    return np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _bound(words: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """No alignment of at most so many equal words and whole n-grams scores more."""
    runs = np.maximum((words - grams) / (N - 1), 1)
    return MATCH * words + max(MISS, GAP) * (runs - 1)


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """An index for each slice of the test items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-size // SLICE_BYTES)
    for number in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == number)
        index = Index.of(sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r)))
        if index.items:
            yield index


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every document and test item it holds a copy of."""

    def scan(index: Index) -> DataFrame:
        def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                yield arrow_rows([(doc_id, *leak) for doc_id, text in pairs for leak in index.leaks(text)], LEAKS)

        return spread_texts(docs).mapInArrow(of_batch, LEAKS)

    out, last = docs.sparkSession.createDataFrame([], LEAKS), None
    for index in _indexes(benchmark):
        out = out if last is None else out.union(cut_lineage(last))
        last = scan(index)
    return out if last is None else out.union(last)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no copy of a test item."""
    for number, index in enumerate(_indexes(benchmark)):
        left = cut_lineage(docs) if number else docs
        docs = keep_texts(left, lambda text, index=index: not index.leaks(text))
    return docs
