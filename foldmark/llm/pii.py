"""Personal data: spans by fixed rules, and more by a semi-Markov conditional random field.

The rules give the base spans. The field adds spans that the rules don't form, such as a phone number without its
plus. Its input are regions: runs of white-space separated chunks that each hold a digit or an at sign. A segment is up to
``MAX_CHUNKS`` chunks of a region, without punctuation at its ends; features are taken from the whole segment
(shape, digits, checksums, separators, number of chunks), so boundaries and kinds are chosen together by dynamic
programming over segment ends; a chunk outside any segment has kind ``none``. The work is linear in the region.

Training: maximum likelihood by gradient steps on the regions of at most ``SAMPLE`` documents, labelled by the rules, with
copies that vary a label: phones lose the plus or the country code and stay phones, card numbers with a wrong
check digit and addresses with a part over 255 become ``none``.

Added spans never overlap base spans. Defined results: a null or empty text has no spans (empty strings, digest of
no bytes); equal rows give equal rows; an empty table gives an empty one; without labelled regions nothing is added; other
columns are left out by ``find_personal_data`` and kept by ``mask_personal_data``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import arrow_rows, spread_texts, texts

KINDS = ("email", "ip", "card", "phone")
NONE = 0  # in the field kind i of KINDS is i + 1
MAX_CHUNKS = 6
#: No kind has so many digits: longer spans share one feature.
LONGEST = 20
SAMPLE = 4000
#: Longer regions are not learned from.
LONGEST_EXAMPLE = 400
EPOCHS = 8
RATE = 0.3
SEED = 20

# The patterns of the base spans. What precedes a match is left to the code below.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
DIGITS = re.compile(r"[0-9]")
BLANK = re.compile(r"[ \t\r\n]")
GAP = re.compile(r"[ \t]{1,3}")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            free = match.end()
            found.append((start, free))
        at = text.find("@", max(at + 1, free))
    return found


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in text.split(".")))


def base_spans(text: str) -> dict[str, list[Span]]:
    """Per kind the leftmost matches that don't overlap, less those that fail the kind's check."""
    if not MARK.search(text):
        return {k: [] for k in KINDS}
    ips = [m.span() for m in IP.finditer(text) if is_ip(m[0])]
    cards = [m.span() for m in CARD.finditer(text) if is_card(m[0])]
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return {"email": _emails(text), "ip": ips, "card": cards, "phone": phones}


def regions(text: str) -> Iterator[list[Span]]:
    """The chunks of each region."""
    at, low, chunks = 0, 0, []
    while mark := MARK.search(text, at):
        i = mark.start()
        start = max(text.rfind(c, low, i) for c in " \t\r\n") + 1 or low
        start = max(start, low)
        blank = BLANK.search(text, i)
        end = blank.start() if blank else len(text)
        if chunks and not GAP.fullmatch(text, chunks[-1][1], start):
            yield chunks
            chunks = []
        chunks.append((start, end))
        at = low = end
    if chunks:
        yield chunks


def trimmed(text: str, start: int, end: int) -> Span:
    """Without punctuation that belongs to the sentence."""
    while start < end and text[start] in "\"'<[{,;:":
        start += 1
    while end > start and text[end - 1] in "\"'>]},;:.!?":
        end -= 1
    return start, end


_LETTERS = re.compile(r"[^\W\d_]+")
_NUMBERS = re.compile(r"[0-9]+")


def features(span: str, chunks: int) -> list[str]:
    digits = _digits(span)
    shape = _NUMBERS.sub("0", _LETTERS.sub("a", span))
    out = ["1", f"shape {shape}", f"digits {len(digits) if len(digits) < LONGEST else LONGEST}", f"chunks {chunks}"]
    out.append("signs " + "".join(sorted({c for c in shape if c not in "0a "})))
    if 13 <= len(digits) <= 19:
        out.append(f"check {luhn(digits)}")
    if shape == "0.0.0.0":
        out.append(f"parts {is_ip(span)}")
    if DOMAIN.search(span):
        out.append("domain")
    return out


class Field:
    """Weights of whole-segment features per kind, and of a kind after a kind (the last row: at the start)."""

    def __init__(self):
        self.n = len(KINDS) + 1
        self.weights: dict[str, np.ndarray] = {}
        self.after = np.zeros((self.n + 1, self.n))

    def _segment(self, text: str, chunks: list[Span], i: int, j: int) -> tuple[list[str], np.ndarray]:
        start, end = trimmed(text, chunks[i][0], chunks[j - 1][1])
        found = features(text[start:end], j - i)
        score = sum((self.weights[f] for f in found if f in self.weights), np.zeros(self.n))
        if j - i > 1:
            score[NONE] = -np.inf
        return found, score

    def _segments(self, text: str, chunks: list[Span]) -> dict[tuple[int, int], tuple[list[str], np.ndarray]]:
        """All of them at once: for the examples of a fit, which are short."""
        n = len(chunks)
        return {(i, j): self._segment(text, chunks, i, j) for i in range(n) for j in range(i + 1, min(n, i + MAX_CHUNKS) + 1)}

    def best(self, text: str, chunks: list[Span]) -> list[tuple[int, int, int]]:
        """(first chunk, chunk beyond, kind) of the segmentation with the highest score.

        Scores are held for the last ``MAX_CHUNKS`` chunks; of all others two small numbers a kind say the way back.
        """
        n, size = len(chunks), MAX_CHUNKS + 1
        enter = np.full((size, self.n), -np.inf)  # the best way to a kind after the first j chunks, in row j % size
        before = np.zeros((size, self.n), "i1")
        length, kind_before = np.zeros((n + 1, self.n), "i1"), np.zeros((n + 1, self.n), "i1")
        here = np.full(self.n + 1, -np.inf)
        here[self.n] = 0
        for j in range(n + 1):
            if j:
                here = np.full(self.n + 1, -np.inf)
                for i in range(max(0, j - MAX_CHUNKS), j):
                    total = enter[i % size] + self._segment(text, chunks, i, j)[1]
                    better = total > here[: self.n]
                    here[: self.n][better] = total[better]
                    length[j, better] = j - i
                    kind_before[j, better] = before[i % size, better]
            ways = here[:, None] + self.after
            enter[j % size], before[j % size] = ways.max(axis=0), ways.argmax(axis=0)
        out, j, kind = [], n, int(here[: self.n].argmax())
        while j:
            i = j - int(length[j, kind])
            out.append((i, j, kind))
            j, kind = i, int(kind_before[j, kind])
        return out[::-1]

    def step(self, text: str, chunks: list[Span], truth: list[tuple[int, int, int]], rate: float) -> float:
        """One gradient step on the likelihood of a segmentation; gives the log-likelihood before it."""
        segments, n = self._segments(text, chunks), len(chunks)
        with np.errstate(divide="ignore"):
            ahead = np.full((n + 1, self.n + 1), -np.inf)
            ahead[0, self.n] = 0
            enter = {}
            for j in range(1, n + 1):
                for i in range(max(0, j - MAX_CHUNKS), j):
                    if i not in enter:
                        enter[i] = np.logaddexp.reduce(ahead[i][:, None] + self.after, axis=0)
                    ahead[j, : self.n] = np.logaddexp(ahead[j, : self.n], enter[i] + segments[i, j][1])
            behind = np.full((n + 1, self.n), -np.inf)
            behind[n] = 0
            for i in range(n - 1, 0, -1):
                for j in range(i + 1, min(n, i + MAX_CHUNKS) + 1):
                    onward = np.logaddexp.reduce(self.after[: self.n] + segments[i, j][1] + behind[j], axis=1)
                    behind[i] = np.logaddexp(behind[i], onward)
            whole = np.logaddexp.reduce(ahead[n, : self.n])
        gradient: dict[str, np.ndarray] = {}
        after = np.zeros_like(self.after)
        for (i, j), (found, own) in segments.items():
            pairs = np.exp(ahead[i][:, None] + self.after + own + behind[j] - whole)
            after -= pairs
            for f in found:
                gradient[f] = gradient.get(f, 0) - pairs.sum(axis=0)
        likelihood, before = -whole, self.n
        for i, j, kind in truth:
            found, own = segments[i, j]
            after[before, kind] += 1
            likelihood += own[kind] + self.after[before, kind]
            for f in found:
                gradient[f][kind] += 1
            before = kind
        self.after += rate * after
        for f, g in gradient.items():
            self.weights[f] = self.weights.get(f, np.zeros(self.n)) * (1 - 1e-4) + rate * g
        return float(likelihood)


def labelled(text: str, chunks: list[Span], base: dict[str, list[Span]]) -> list[tuple[int, int, int]] | None:
    """The rules' spans as a segmentation; None if one of them is not a run of whole chunks."""
    left, right = chunks[0][0], chunks[-1][1]
    inside = sorted((s, e, k + 1) for k, kind in enumerate(KINDS) for s, e in base[kind] if s < right and e > left)
    places = {trimmed(text, chunks[i][0], chunks[j - 1][1]): (i, j) for i in range(len(chunks)) for j in range(i + 1, min(len(chunks), i + MAX_CHUNKS) + 1)}
    out, at = [], 0
    for s, e, kind in inside:
        if (s, e) not in places or places[s, e][0] < at:
            return None
        i, j = places[s, e]
        out += [(x, x + 1, NONE) for x in range(at, i)] + [(i, j, kind)]
        at = j
    return out + [(x, x + 1, NONE) for x in range(at, len(chunks))]


def _varied(text: str, chunks: list[Span], truth: list[tuple[int, int, int]]) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Regions with one label, changed: what stays of its kind, and what is none."""
    held = [t for t in truth if t[2] != NONE]
    if len(held) != 1:
        return
    (i, j, kind), = held
    start, end = trimmed(text, chunks[i][0], chunks[j - 1][1])
    span, name = text[start:end], KINDS[kind - 1]
    if name == "phone":
        parts = span.split(" ")
        yield span[1:], [(0, j - i, kind)]
        if len(parts) > 1 and sum(map(str.isdigit, "".join(parts[1:]))) >= 9:
            yield " ".join(parts[1:]), [(0, j - i - 1, kind)]
    if name == "card":
        wrong = span[:-1] + str((int(span[-1]) + 1) % 10)
        yield wrong, [(x, x + 1, NONE) for x in range(j - i)]
    if name == "ip":
        yield "999" + span[span.index(".") :], [(0, 1, NONE)]


def train(sample: list[str]) -> Field | None:
    """Fits the field to the rules' labels in some texts. The same texts in the same order give the same field."""
    examples = []
    for text in sample:
        base = base_spans(text)
        for chunks in regions(text):
            if len(chunks) > 4 * MAX_CHUNKS or (truth := labelled(text, chunks, base)) is None:
                continue
            examples.append((text[chunks[0][0] : chunks[-1][1]], [(s - chunks[0][0], e - chunks[0][0]) for s, e in chunks], truth))
            for varied, kinds in _varied(text, chunks, truth):
                examples.append((varied, next(regions(varied)), kinds))
    examples = [x for x in examples if len(x[1]) == x[2][-1][1]]
    if not any(kind for _, _, truth in examples for _, _, kind in truth):
        return None
    field, rng = Field(), np.random.default_rng(SEED)
    for epoch in range(EPOCHS):
        for x in rng.permutation(len(examples)):
            field.step(*examples[x], RATE / (1 + epoch))
    return field


def all_spans(text: str, field: Field | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """The base spans, and these with the field's that overlap none of them."""
    base = base_spans(text)
    if field is None:
        return base, base
    taken = sorted(s for spans in base.values() for s in spans)
    more: dict[str, list[Span]] = {k: list(v) for k, v in base.items()}
    at, reach = 0, 0  # base spans before ``at`` start left of the segment and end by ``reach`` at the latest
    for chunks in regions(text):
        for i, j, kind in field.best(text, chunks):
            if kind == NONE:
                continue
            start, end = trimmed(text, chunks[i][0], chunks[j - 1][1])
            while at < len(taken) and taken[at][0] < end:
                reach = max(reach, taken[at][1])
                at += 1
            if start >= reach and start < end:
                more[KINDS[kind - 1]].append((start, end))
    return base, {k: sorted(v) for k, v in more.items()}


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])


def masked(text: str, spans: dict[str, list[Span]]) -> str:
    """Each stretch covered by spans becomes its first span's kind in angle brackets."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, v in spans.items() for s, e in v):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def fit_field(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Trains on at most ``sample`` documents with a digit or at sign, picked by a hash."""
    rows = texts(docs).where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), F.length("text").alias("n"), "text")
    picked = rows.select("h", "n").distinct().orderBy("h", "n").limit(sample)
    found = rows.join(F.broadcast(picked), ["h", "n"], "left_semi").dropDuplicates(["h", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [t[c[0][0] : c[-1][1]] for t in batch.column("text").to_pylist() for c in regions(t)]
            yield arrow_rows([(x,) for x in lines if len(x) <= LONGEST_EXAMPLE], "line string")

    # Only the regions leave the executors: lines, not texts.
    lines = found.select("text").mapInArrow(cut, "line string").distinct()
    return train([r["line"] for r in lines.orderBy(F.xxhash64("line"), "line").limit(sample).collect()])


SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_<kind> ..., base_sha256, spans) of every document."""
    field = fit_field(docs, sample)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base, every = all_spans(text, field)
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                out.append((doc_id, *(len(base[k]) for k in KINDS), digest, listed(every)))
            yield arrow_rows(out, SPANS)

    return spread_texts(docs).mapInArrow(scan, SPANS)


def mask_personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents, with all their columns, with spans of personal data replaced by their kind. A null text stays null."""
    field = fit_field(docs, sample)

    @F.pandas_udf("string")
    def mask(text):
        return text.map(lambda t: t if t is None else masked(t, all_spans(t, field)[1]))

    return docs.withColumn("text", mask("text"))
