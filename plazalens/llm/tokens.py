"""Token ids of whole texts by the tokenizers library, fast where words repeat.

A byte-level tokenizer splits a text into pieces first and merges bytes within a piece only, so a
piece always has the same ids. Texts of Latin letters are split here, for many texts at once; the
library's model is asked for each different piece, and a bounded memory of a worker keeps the
answers. Any other text goes to the library as a whole. The ids are those of
``encode(text, add_special_tokens=False)``, with names of special tokens as ordinary text.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tokenizers

from .shingles import segment_hashes

VOCABULARY = "byte_bpe_50k.json"
_CHUNK = 1 << 20
_MEMORY = 1_000_000
"""Pieces a worker remembers, some 40 bytes each; it starts anew beyond that."""

# --- fixed values: the endings that the splitting pattern keeps together ----
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_SPACE, _BLANK, _LETTER, _NUMBER, _OTHER, _UNSURE = range(6)


def _kinds() -> np.ndarray:
    """The kind of each character below 0x250; characters that are not plain are unsure."""
    kinds = np.full(0x251, _UNSURE, np.uint8)
    for code in range(0x250):
        category = unicodedata.category(chr(code))
        if code == 32:
            kinds[code] = _SPACE
        elif 9 <= code <= 13:
            kinds[code] = _BLANK
        elif category[0] == "L":
            kinds[code] = _LETTER
        elif category[0] == "N":
            kinds[code] = _NUMBER
        elif category[0] in "PS":
            kinds[code] = _OTHER
    return kinds


_KINDS = _kinds()


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: the byte's own if it is
    visible, else the next free one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def piece_starts(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of texts start. ``chars`` holds the texts one after another, ``first``
    is true at the first character of each. Only for characters of a sure kind."""
    kind = _KINDS[np.minimum(chars, 0x250)]
    blank = kind <= _BLANK
    before = np.concatenate(([_UNSURE], kind[:-1]))
    group = np.where(blank, _SPACE, kind)
    changed = first | (group != np.concatenate(([_UNSURE], group[:-1])))
    last = np.concatenate((first[1:], [True]))
    ends_run = ~last & blank & ~np.concatenate((blank[1:], [True]))
    # The last blank before a piece stands alone, or opens the piece if it is a space.
    starts = np.where(blank, changed | ends_run, changed & (first | (before != _SPACE)))
    quotes = np.flatnonzero((chars == 39) & starts & (kind == _OTHER))
    for at in quotes.tolist():
        for ending in _ENDINGS:
            end = at + 1 + len(ending)
            if end <= len(chars) and not first[at + 1 : end].any() and all(
                chars[at + 1 + i] == ord(letter) for i, letter in enumerate(ending)
            ):
                starts[at + 1] = False
                if end < len(chars):
                    # What follows is a new piece, unless a space there opens one anyway.
                    starts[end] = True
                break
    return starts


_SAFE = re.compile(r"(?<=\w) (?=\w)")


def parts_of(text: str) -> Iterator[str]:
    """A very long text in parts of about a chunk. They are cut before a single space between two
    word characters, where a piece starts in any text, so their ids are those of the whole."""
    at = 0
    while len(text) - at > _CHUNK and (cut := _SAFE.search(text, at + _CHUNK)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Encoder:
    """Ids of texts, with a memory of pieces."""

    def __init__(self, vocabulary: str = VOCABULARY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self._tokenizer.encode_special_tokens = True
        self._model, self._letters = self._tokenizer.model, _byte_letters()
        self._forget()

    def _forget(self) -> None:
        # Sorted hashes of the pieces, and where the ids of each start and how many they are.
        self._codes = np.empty(0, np.uint64)
        self._starts = np.empty(0, np.int64)
        self._counts = np.empty(0, np.int32)
        self._ids, self._used = np.empty(1 << 16, np.uint32), 0

    def _learn(self, codes: np.ndarray, pieces: Iterator[str]) -> None:
        """Remember the ids of pieces, by sorted hashes that are new."""
        starts, counts = np.empty(len(codes), np.int64), np.empty(len(codes), np.int32)
        for row, piece in enumerate(pieces):
            spelled = piece.encode().decode("latin-1").translate(self._letters)
            ids = [token.id for token in self._model.tokenize(spelled)]
            if self._used + len(ids) > len(self._ids):
                self._ids = np.concatenate((self._ids, np.empty(len(self._ids) // 2 + len(ids), np.uint32)))
            self._ids[self._used : self._used + len(ids)] = ids
            starts[row], counts[row] = self._used, len(ids)
            self._used += len(ids)
        at = np.searchsorted(self._codes, codes)
        self._codes = np.insert(self._codes, at, codes)
        self._starts = np.insert(self._starts, at, starts)
        self._counts = np.insert(self._counts, at, counts)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; none for NULL."""
        chunk, held = [], 0
        for text in texts:
            text = text or ""
            if chunk and held + len(text) > _CHUNK:
                yield from self._encode(chunk)
                chunk, held = [], 0
            if len(text) > _CHUNK:
                yield np.concatenate([self._encode([part])[0] for part in parts_of(text)])
                continue
            chunk.append(text)
            held += len(text)
        if chunk:
            yield from self._encode(chunk)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        lengths = np.array([len(text) for text in texts])
        joined = "".join(texts)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        unsure = np.flatnonzero(_KINDS[np.minimum(chars, 0x250)] == _UNSURE)
        whole = np.unique(np.searchsorted(bounds, unsure, "right") - 1)
        first = np.zeros(len(chars) + 1, bool)
        first[bounds[:-1]] = True
        first = first[: len(chars)]
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        if len(chars):
            starts = np.flatnonzero(piece_starts(chars, first))
            ends = np.append(starts[1:], len(chars))
            ids, counts = self._pieces(joined, chars, starts, ends)
            ends_at = np.concatenate(([0], np.cumsum(counts)))
            cuts = ends_at[np.searchsorted(starts, bounds)]
            out = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for text in whole.tolist():
            found = self._tokenizer.encode(texts[text], add_special_tokens=False)
            out[text] = np.array(found.ids, np.uint32)
        return out

    def _pieces(self, joined: str, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        with np.errstate(over="ignore"):
            hashes = segment_hashes(chars, starts, ends)
        different, first, numbers = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._codes) + len(different) > _MEMORY:
            self._forget()
        new = np.flatnonzero(~self._known(different)[1])
        self._learn(different[new], (joined[starts[i] : ends[i]] for i in first[new].tolist()))
        slots = self._known(different)[0][numbers]
        begin, counts = self._starts[slots], self._counts[slots]
        offsets = np.cumsum(counts, dtype=np.int64) - counts
        places = np.arange(int(counts.sum(dtype=np.int64))) + np.repeat(begin - offsets, counts)
        return self._ids[places], counts

    def _known(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of hashes, and whether they are remembered."""
        if not len(self._codes):
            return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        slots = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
        return slots, self._codes[slots] == codes


_encoder: Encoder | None = None


def encoder() -> Encoder:
    """This worker's encoder: its memory lasts over tasks."""
    global _encoder
    if _encoder is None:
        _encoder = Encoder()
    return _encoder
