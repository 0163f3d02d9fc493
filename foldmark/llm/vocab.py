"""Token ids of whole texts by a tokenizer file, quick for texts that repeat their words.

A text is cut only where the tokenizer would cut it anyway: at spaces into pieces, and a piece by the tokenizer's own
pattern into words. The library's model merges each word that a worker has not met lately, and a text's ids
are its pieces' ids in order. Tests hold this to the library's ids of whole texts.
"""

from __future__ import annotations

import json
import os
import sys
import types
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash

#: A space between two non-spaces: it starts a piece of its own in a tokenizer that keeps spaces.
_INNER_SPACE = regex.compile(r"(?<=\S) (?=\S)")
#: Punctuation that is a word of its own after letters.
_STOPS = (".", ",")
#: Below, lower case is one letter's own and composed forms stay.
_BEYOND_LATIN = "\u0100"
#: A worker's memory of pieces, and that of words in pieces of several, starts anew beyond this many.
REMEMBERED = 750_000
REMEMBERED_WORDS = 150_000
#: Pieces that a worker remembers under their hashes, some 35 bytes each, and bytes of text that it encodes at a time.
TABLED, RECENT = 1_800_000, 200_000
SLICE_BYTES = 3 << 20
#: Words of pieces of several that stay beside that table.
TABLED_WORDS = 20_000
ID = np.dtype("<u4")


def _worker_memory(key: tuple) -> dict[str, bytes]:
    """What this Python worker has met: functions travel by value, so their own globals end with a task."""
    held = sys.modules.setdefault("_foldmark_worker", types.ModuleType("_foldmark_worker"))
    return vars(held).setdefault("met", {}).setdefault(key, {})


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 for itself, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)}


class Encoder:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit integers.

    ``keeps_spaces``: the tokenizer's tokens hold spaces (byte-level), or it drops them (word-level).
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, keeps_spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_spaces = keeps_spaces
        self.lead = " " if keeps_spaces else ""
        self.known = _worker_memory((path, "pieces"))
        self.words = _worker_memory((path, "words"))
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)["pre_tokenizer"]
        own = [s["pattern"]["Regex"] for s in steps.get("pretokenizers", [steps]) if "pattern" in s]
        self.pattern = regex.compile(own[0] if own else public_tokenizers.PATTERN)
        self.characters = _byte_characters()
        self.merges = self.tokenizer.model
        self.merges._resize_cache(0)  # what was met is remembered here

    def _merge(self, word: str) -> bytes:
        return array("I", [t.id for t in self.merges.tokenize(word.encode().decode("latin-1").translate(self.characters))]).tobytes()

    def _merged(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= REMEMBERED_WORDS:
                self.words.clear()
            found = self.words[word] = self._merge(word)
        return found

    def _ids(self, text: str) -> bytes:
        if self.tokenizer.normalizer is not None:
            text = text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
        return b"".join(map(self._merged, self.pattern.findall(text)))

    def _piece(self, piece: str) -> bytes | None:
        """Of a piece between spaces, or between a line's end, which it keeps, and a space. None if it has another blank
        at an end: where to cut there is the pattern's choice."""
        if piece.isalpha() and (self.keeps_spaces or max(piece) < _BEYOND_LATIN):  # one word by the pattern
            ids = self._merge(" " + piece if self.keeps_spaces else piece.lower())
        elif self.keeps_spaces and piece[:1] == "\n" and piece[1:2].strip() and piece[-1].strip():
            ids = self._merged("\n") + self._ids(piece[1:])
        elif self.keeps_spaces and (not piece or piece[0].isspace() or piece[-1].isspace()):
            return None
        elif piece[-1:] in _STOPS and piece[:-1].isalpha():  # two
            ids = (self.known.get(piece[:-1]) or self._piece(piece[:-1])) + self._merged(piece[-1])
        else:
            ids = self._ids(self.lead + piece)
        self.known[piece] = ids
        return ids

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        return [self._text(t) for t in texts]

    def _text(self, text: str) -> bytes:
        # A line's end is a word of its own between two words, and nothing where blanks are dropped.
        pieces = text.replace("\n", " \n" if self.keeps_spaces else " ").split(" ")
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = list(map(self.known.get, pieces))
        if self.keeps_spaces:
            if pieces[0] and pieces[0][-1].isspace():
                return self._oddly_spaced(text)
            found[0] = self._ids(pieces[0])
        at, unknown = 0, found.count(None)
        for _ in range(unknown):
            at = found.index(None, at)
            found[at] = self._piece(pieces[at])
            if found[at] is None:
                return self._oddly_spaced(text)
        return b"".join(found)

    def _oddly_spaced(self, text: str) -> bytes:
        first, *rest = _INNER_SPACE.split(text)
        found = (self.known.get(p) or self._piece(p) or self._ids(" " + p) for p in rest)
        return b"".join([self._ids(first), *found])


class PieceTable:
    """Pieces' ids under hashes of 128 bits, in arrays sorted by hash: a fraction of what strings and objects take.

    What came lately has arrays of its own, so that the large ones are sorted anew once in RECENT pieces.
    """

    def __init__(self) -> None:
        none = (np.empty(0, "u8"), np.empty(0, "u8"), np.empty(0, "i4"), np.empty(0, "i4"))
        self.settled, self.recent = none, none  # (high, low, place among the ids, length)
        self.ids, self.used = np.empty(1 << 16, ID), 0

    def __len__(self) -> int:
        return len(self.settled[0]) + len(self.recent[0])

    def find(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the ids, length) of each hash; the length -1 for those that are not here."""
        at, n = np.zeros(len(high), "i4"), np.full(len(high), -1, "i4")
        for highs, lows, places, lengths in (self.settled, self.recent):
            if len(highs):
                row = np.minimum(np.searchsorted(highs, high), len(highs) - 1)
                met = (highs[row] == high) & (lows[row] == low)
                at[met], n[met] = places[row[met]], lengths[row[met]]
        return at, n

    @staticmethod
    def _merged(one: tuple, two: tuple) -> tuple:
        order = np.argsort(np.concatenate([one[0], two[0]]), kind="stable")
        return tuple(np.concatenate([a, b])[order] for a, b in zip(one, two, strict=True))

    def add(self, high: np.ndarray, low: np.ndarray, found: list[bytes]) -> None:
        n = np.fromiter(map(len, found), "i4", len(found)) // ID.itemsize
        at = self.used + np.cumsum(n, dtype="i4") - n
        self.used = self.beyond(b"".join(found))
        self.recent = self._merged(self.recent, (high, low, at, n))
        if len(self.recent[0]) > RECENT:
            self.settled, self.recent = self._merged(self.settled, self.recent), tuple(c[:0] for c in self.recent)

    def beyond(self, ids: bytes) -> int:
        """Puts ids after those of the table, where the next ones will go, and says where they end."""
        end = self.used + len(ids) // ID.itemsize
        if end > len(self.ids):
            grown = np.empty(max(end, len(self.ids) * 3 // 2), ID)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : end] = np.frombuffer(ids, ID)
        return end


class ColumnEncoder(Encoder):
    """``Encoder`` for columns of texts and a tokenizer whose tokens hold spaces: the ids of a slice in one array.

    Arrow cuts the texts into pieces and finds the distinct ones; each is merged once, as long as the worker's table has
    room for it, and the slice's ids are taken from the table. Texts with odd blanks go the way of single texts.
    """

    def __init__(self, path: str):
        super().__init__(path, keeps_spaces=True)
        self.known = {}  # pieces of one slice
        self.blank = self.characters[ord(" ")]
        self.table: PieceTable = _worker_memory((path, "table")).setdefault("table", PieceTable())

    def _merge(self, word: str) -> bytes:
        # The bytes of ASCII are its characters, and letters stand for themselves in the vocabulary.
        if word.isascii():
            spelled = word if word.isalpha() else word.translate(self.characters)
            return array("I", [t.id for t in self.merges.tokenize(spelled)]).tobytes()
        return super()._merge(word)

    def _hashes(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, pieces)), ">u8").reshape(-1, 2).astype("u8")
        return np.ascontiguousarray(hashes[:, 0]), np.ascontiguousarray(hashes[:, 1])

    def _recall(self, words: list[str]) -> None:
        """Words of the table, as pieces that this slice knows."""
        at, n = self.table.find(*self._hashes(words))
        for i in np.flatnonzero(n >= 0).tolist():
            self.known[words[i]] = self.table.ids[int(at[i]) : int(at[i]) + int(n[i])].tobytes()

    def _rows(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place among the ids, length) of each piece; an odd piece has the length -1."""
        high, low = self._hashes(pieces)
        missing = np.flatnonzero(self.table.find(high, low)[1] < 0)
        if len(self.table) + len(missing) > TABLED:  # the table starts anew, with all of this slice's pieces
            self.table.__init__()
            missing = np.arange(len(pieces))
        if len(missing):
            unknown = [pieces[i] for i in missing.tolist()]
            self._recall([p[:-1] for p in unknown if p[-1:] in _STOPS])
            tokenize, blank, known, found = self.merges.tokenize, self.blank, self.known, []
            for p in unknown:
                if p.isascii() and p.isalpha():  # most: one word
                    known[p] = array("I", [t.id for t in tokenize(blank + p)]).tobytes()
                    found.append(known[p])
                else:
                    found.append(self._piece(p))
            known.clear()
            merged = missing[np.array([f is not None for f in found], bool)]
            self.table.add(high[merged], low[merged], [f for f in found if f is not None])
        return self.table.find(high, low)

    def encode_column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, each with the end id after it, number of ids of each)."""
        lists = pc.split_pattern(pc.replace_substring(texts, pattern="\n", replacement=" \n"), pattern=" ")
        flat = pc.list_flatten(lists)
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype="i8")])
        first = starts[:-1]
        opening = flat.take(pa.array(first)).to_pylist()
        encoded = pc.dictionary_encode(flat)
        indices = encoded.indices.to_numpy(zero_copy_only=False)
        places, lengths = self._rows(encoded.dictionary.to_pylist())
        at, n = places[indices], lengths[indices]
        odd = np.zeros(len(texts), bool)
        if (lengths < 0).any():
            strange = n < 0
            strange[first] = False  # a text's first piece has no space before it and is not looked up
            odd = np.add.reduceat(strange.view("i1"), first, dtype="i4") > 0
        own, end, extra = self.table.used, np.array([end_id], ID).tobytes(), []
        for i, piece in enumerate(opening):
            if odd[i] or (piece and piece[-1].isspace()):
                found = self._oddly_spaced(texts[i].as_py())
                n[starts[i] : starts[i + 1]] = 0
            else:
                found = self._ids(piece)
            # What comes first in a text follows the end of the one before.
            extra.append(end + found if i else found)
            at[first[i]], n[first[i]] = own, len(extra[-1]) // ID.itemsize
            own += len(extra[-1]) // ID.itemsize
        self.known.clear()
        if len(self.words) > TABLED_WORDS:
            self.words.clear()
        pa.default_memory_pool().release_unused()
        self.table.beyond(b"".join(extra))
        ends = np.cumsum(n, dtype="i4")
        place = np.repeat(at - (ends - n), n)
        place += np.arange(len(place), dtype="i4")
        counts = np.add.reduceat(n, first, dtype="i8")
        counts[:1] += 1
        return np.append(self.table.ids[place], ID.type(end_id)), counts


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
