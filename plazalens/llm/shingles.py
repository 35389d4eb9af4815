"""Hashed words and word shingles of whole texts, worked out for many texts at once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CHUNK = 1 << 20

_powers = np.empty(0, np.uint64)
_inverses = np.empty(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse. A worker keeps those of two chunks, no more."""
    global _powers, _inverses
    with np.errstate(over="ignore"):
        if size > 2 * _CHUNK:
            return np.cumprod(np.full(size, _BASE)), np.cumprod(np.full(size, _INVERSE))
        if len(_powers) < size:
            _powers = np.cumprod(np.full(2 * _CHUNK, _BASE))
            _inverses = np.cumprod(np.full(2 * _CHUNK, _INVERSE))
    return _powers, _inverses


def segment_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches [start, end) of an array of small numbers; the same
    stretch has the same hash wherever it stands."""
    powers, inverses = _tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[: len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(raw ^ mix((ends - starts).astype(np.uint64)))


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about a chunk that cut no word."""
    at = 0
    while len(text) - at > _CHUNK and (blank := _BLANK.search(text, at + _CHUNK)):
        yield text[at : blank.start()]
        at = blank.end()
    yield text[at:] if at else text


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, letters A-Z as a-z, and the number of words of each text. What is held
    beside the hashes does not grow with the texts."""
    if len(texts) == 1 and len(texts[0]) > _CHUNK:
        found = [_hashes_at_once([piece])[0] for piece in _pieces(texts[0])]
        return np.concatenate(found), np.array([sum(map(len, found))])
    return _hashes_at_once(texts)


def _hashes_at_once(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8).copy()
    upper = (joined >= 65) & (joined <= 90)
    joined[upper] += 32
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edges = np.diff(np.concatenate(([True], blank)).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    bounds = np.cumsum([len(text) + 1 for text in texts])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    return segment_hashes(joined, starts, ends), counts


def _sets_of(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    hashes, counts = _word_hashes(texts)
    shingles = np.zeros(len(hashes), np.uint64)
    for k in range(size):  # a shingle that runs out of its text is not used below
        shingles[: len(hashes) - k] = mix(shingles[: len(hashes) - k] * _BASE + hashes[k:])
    at = 0
    for count in counts.tolist():
        if count >= size:
            yield np.unique(shingles[at : at + count - size + 1])
        elif count:
            whole = np.uint64(count)
            for value in hashes[at : at + count]:
                whole = mix(np.array([whole * _BASE + value]))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.empty(0, np.uint64)
        at += count


def shingle_sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """For each text its set of shingles, as sorted 64-bit hashes. A text of fewer words is one
    shingle; a text without words, or NULL, has an empty set. Whole texts are read."""
    with np.errstate(over="ignore"):
        chunk: list[bytes] = []
        held = 0
        for text in texts:
            text = text or b""
            if chunk and held + len(text) > _CHUNK:
                yield from _sets_of(chunk, size)
                chunk, held = [], 0
            chunk.append(text)
            held += len(text)
        if chunk:
            yield from _sets_of(chunk, size)
