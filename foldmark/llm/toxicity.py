"""Toxicity by a classifier chain of linear models.

The categories form a chain. Each has a logistic model over the words of a text and their beginnings, and over the
probabilities of the categories before it. What a later model learns from are out-of-fold probabilities, from
models that have not seen the row, so training and scoring meet the same kind of input. Equal texts share a fold.

A feature is a word's count over the square root of the text's length: how far the count stands out of chance. It needs
no other word of the text. Beside the words stands a text's form, which tells junk: shares of marks, capitals, distinct words, distinct
lines and the commonest word, and the mean length of words, each by the steps of ``FORM`` that it exceeds. The models are fitted on
at most ``SAMPLE`` labelled documents, picked by a hash of the id, over all words that occur in ``MIN_DOCS`` of them; an absolute
penalty alone says which words a model keeps. All documents are scored, each in its row.

Defined results: a null or empty text has no features, the models' base rates, and is not toxic; a document with several labels counts by
the largest; rows without an id are scored too; equal rows give equal rows; an empty table gives an empty
one; without two classes in a category its probability is its rate in the sample (0 without any label); other columns are left out
by ``score_toxicity`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, keep_texts, spread_texts, texts
from foldmark.session import cut_lineage

#: Categories in the chain's order, with what a row of labels says about them.
CHAIN = {"junk": "1 - quality", "toxic": "toxic"}
SAMPLE = 4_000
MIN_DOCS = 4
WORDS = 1 << 16
FOLDS = 3
#: Letters of a word's beginning, a feature beside the word.
BEGINNING = 5
WORD = re.compile(r"[^\W_]+")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SHARES = (0.01, 0.02, 0.03, 0.04, 0.06, 0.08, 0.12, 0.2, 0.3)
PARTS = (0.2, 0.4, 0.5, 0.6, 0.65, 0.7, 0.8, 0.9, 0.95)
FORM = {"marks": SHARES, "capitals": SHARES, "commonest": SHARES, "distinct": PARTS, "lines": PARTS, "length": (4, 4.5, 5, 5.5, 6, 6.5, 7)}
PENALTY = 1e-3
STEPS = 400
THRESHOLD = 0.5


@dataclass(frozen=True)
class Linear:
    """A logistic model: intercept, weights of words, weights of the probabilities before it."""

    intercept: float
    words: dict[str, float]
    before: list[float]


def counted(text: str) -> tuple[int, Counter[str]]:
    """How many words a text has, and how often each occurs."""
    words = WORD.findall(text.lower())
    return len(words), Counter(words)


def beginnings(words: Counter[str]) -> Counter[str]:
    out: Counter[str] = Counter()
    for word, n in words.items():
        out["^" + word[:BEGINNING]] += n
    return out


def form(text: str, n: int, words: Counter[str]) -> list[str]:
    """Names of the steps that a text of n > 0 words exceeds."""
    letters, lines = sum(len(w) * k for w, k in words.items()), text.split("\n")
    found = {
        "marks": 1 - letters / max(sum(map(len, text.split())), letters),
        "capitals": len(CAPITAL.findall(text)) / letters,
        "commonest": max(words.values()) / n,
        "distinct": len(words) / n,
        "lines": len(set(lines)) / len(lines),
        "length": letters / n,
    }
    return [f"#{name}>{step}" for name, steps in FORM.items() for step in steps if found[name] > step]


def features(text: str) -> dict[str, float]:
    """The features of a text; none without words."""
    n, words = counted(text)
    if not n:
        return {}
    out = dict.fromkeys(form(text, n, words), 1.0)
    words.update(beginnings(words))
    return out | {t: k / math.sqrt(n) for t, k in words.items()}


@dataclass(frozen=True)
class ChainModel:
    models: dict[str, Linear]

    def score(self, text: str) -> tuple[list[float], bool]:
        """The categories' probabilities in order, and whether the last reaches THRESHOLD."""
        found = features(text)
        before: list[float] = []
        for model in self.models.values():
            margin = model.intercept + sum(model.words[t] * x for t, x in found.items() if t in model.words)
            margin += sum(w * p for w, p in zip(model.before, before, strict=True) if w)
            before.append(1 / (1 + math.exp(-margin)) if margin > -700 else 0.0)
        return before, bool(found) and before[-1] >= THRESHOLD


@dataclass(frozen=True)
class Sparse:
    """A matrix by its entries (row, column, x)."""

    row: np.ndarray
    column: np.ndarray
    x: np.ndarray
    shape: tuple[int, int]

    @classmethod
    def of(cls, dense: np.ndarray) -> Sparse:
        row, column = np.nonzero(dense)
        return cls(row, column, dense[row, column], dense.shape)

    def rows(self, chosen: np.ndarray) -> Sparse:
        held = chosen[self.row]
        return Sparse((np.cumsum(chosen) - 1)[self.row[held]], self.column[held], self.x[held], (int(chosen.sum()), self.shape[1]))

    def beside(self, columns: list[np.ndarray]) -> Sparse:
        n, size = self.shape
        row = np.concatenate([self.row, *[np.arange(n) for _ in columns]])
        column = np.concatenate([self.column, *[np.full(n, size + i) for i in range(len(columns))]])
        return Sparse(row, column, np.concatenate([self.x, *columns]), (n, size + len(columns)))

    def times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.x * v[self.column], self.shape[0])

    def turned_times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.x * v[self.row], self.shape[1])

    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean and deviation of each column."""
        mean = np.bincount(self.column, self.x, self.shape[1]) / self.shape[0]
        gap = np.bincount(self.column, (self.x - mean[self.column]) ** 2, self.shape[1])
        absent = self.shape[0] - np.bincount(self.column, minlength=self.shape[1])
        return mean, np.sqrt((gap + absent * mean**2) / self.shape[0])


def fit_penalised(x: np.ndarray | Sparse, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """(intercept, weights) of a logistic regression with an absolute penalty on weights of columns at unit deviation.

    Accelerated proximal gradient steps, of the length that the largest eigenvalue allows.
    """
    x = x if isinstance(x, Sparse) else Sparse.of(x)
    n, (mean, scale) = len(y), x.moments()
    scale = np.where(scale > 1e-12, scale, 1.0)

    # Columns less their means, which the steps need to be long; the intercept takes the means up at the end.
    def times(w: np.ndarray) -> np.ndarray:
        return x.times(w[:-1] / scale) - mean @ (w[:-1] / scale) + w[-1]

    def turned_times(r: np.ndarray) -> np.ndarray:
        return np.append((x.turned_times(r) - mean * r.sum()) / scale, r.sum())

    v = np.random.default_rng(0).normal(size=x.shape[1] + 1)
    for _ in range(20):
        v = turned_times(times(v))
        v /= np.linalg.norm(v)
    step = 4 * n / float(np.linalg.norm(turned_times(times(v))) * 1.05)
    w, ahead, t = np.zeros(len(v)), np.zeros(len(v)), 1.0
    w[-1] = ahead[-1] = math.log(y.mean() / (1 - y.mean()))
    shrink = np.append(np.full(x.shape[1], penalty * step), 0.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(times(ahead), -30, 30)))
        moved = ahead - step * turned_times(p - y) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - shrink, 0)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    weights = w[:-1] / scale
    return float(w[-1] - mean @ weights), weights


@dataclass(frozen=True)
class Sample:
    """Labelled documents as entries (row, word, feature), with targets and folds."""

    words: list[str]
    row: np.ndarray
    word: np.ndarray
    x: np.ndarray
    targets: dict[str, np.ndarray]
    fold: np.ndarray

    def fit(self, y: np.ndarray, rows: np.ndarray, before: list[np.ndarray]) -> tuple[Linear, np.ndarray]:
        """A model from some rows, and its probabilities for all."""
        rate = float(y[rows].mean()) if rows.any() else 0.0
        if rate in (0.0, 1.0):
            return Linear(math.inf if rate else -math.inf, {}, [0.0] * len(before)), np.full(len(y), rate)
        x = Sparse(self.row, self.word, self.x, (len(y), len(self.words))).beside(before)
        intercept, weights = fit_penalised(x.rows(rows), y[rows])
        kept = {w: float(v) for w, v in zip(self.words, weights, strict=False) if v}
        p = 1 / (1 + np.exp(-np.clip(intercept + x.times(weights), -30, 30)))
        return Linear(intercept, kept, weights[len(self.words) :].tolist()), p


def labelled_sample(docs: DataFrame, labels: DataFrame, chain: dict[str, str], sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, targets) of at most ``sample`` labelled documents."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.expr(e).cast("double").alias(f"y_{c}") for c, e in chain.items()])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(f"y_{c}").alias(f"y_{c}") for c in chain])
    rows = texts(docs)
    # Only ids meet here; a document's own rows are one.
    picked = known.join(rows.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return rows.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])


def read_sample(docs: DataFrame, labels: DataFrame, chain: dict[str, str], sample: int) -> Sample:
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("_fold")
    rows = cut_lineage(labelled_sample(docs, labels, chain, sample).select("doc_id", *[f"y_{c}" for c in chain], fold, "text"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                yield arrow_rows([(doc_id, t, x) for t, x in features(text).items()], "doc_id long, t string, x double")

    found = rows.select("doc_id", "text").mapInArrow(entries, "doc_id long, t string, x double")
    used = found.groupBy("t").agg(F.count("*").alias("docs")).where(F.col("docs") >= MIN_DOCS).orderBy(F.desc("docs"), "t").limit(WORDS)
    words = sorted(r["t"] for r in used.collect())
    known = docs.sparkSession.createDataFrame(list(enumerate(words)), "word int, t string")
    # At most WORDS words, and at most ``sample`` documents.
    entries_, heads = found.join(F.broadcast(known), "t").select("doc_id", "word", "x").toArrow(), rows.drop("text").orderBy("doc_id").toArrow()
    ids = heads.column("doc_id").to_numpy()
    columns = [entries_.column(c).to_numpy() for c in ("doc_id", "word", "x")]
    order = np.lexsort((columns[1], columns[0]))  # the same sums in every run
    doc, word, x = (c[order] for c in columns)
    y = {c: heads.column(f"y_{c}").to_numpy() for c in chain}
    return Sample(words, np.searchsorted(ids, doc), word, x, y, heads.column("_fold").to_numpy())


def fit_chain(docs: DataFrame, labels: DataFrame, chain: dict[str, str] = CHAIN, sample: int = SAMPLE) -> ChainModel:
    seen = read_sample(docs, labels, chain, sample)
    models: dict[str, Linear] = {}
    before: list[np.ndarray] = []
    every = np.ones(len(seen.fold), bool)
    for name, y in seen.targets.items():
        models[name], _ = seen.fit(y, every, before)
        unseen = np.zeros(len(y))
        for fold in range(FOLDS if len(models) < len(chain) else 0):
            held = seen.fold == fold
            unseen[held] = seen.fit(y, ~held, before)[1][held]
        before.append(unseen)
    return ChainModel(models)


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, p_<category> ..., toxic) of every document."""
    model = fit_chain(docs, labels, CHAIN, sample)
    schema = ", ".join(["doc_id long", *[f"p_{c} double" for c in CHAIN], "toxic int"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scored = [model.score(t) for t in batch.column("text").to_pylist()]
            yield arrow_rows([(i, *p, int(toxic)) for i, (p, toxic) in zip(batch.column("doc_id").to_pylist(), scored, strict=True)], schema)

    return spread_texts(docs).mapInArrow(score, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents, with all their columns, that the chain does not call toxic."""
    model = fit_chain(docs, labels, CHAIN, sample)
    return keep_texts(docs, lambda text: not model.score(text)[1])
