"""A linear-chain conditional random field over words, in numpy.

A word's label score is the sum of the weights of its features: character n-grams of two to
four letters with the word's edges, prefixes and suffixes of one to three letters, and the word
itself as its own lexicon entry. Features are hashed into one table. A learned matrix scores a
label after another. Forward-backward gives each word's label probabilities. Sequences are
stretches of a text of bounded length; all stretches of a batch move in step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .shingles import mix, segment_hashes

BITS = 17
STRETCH = 128
"""Words of a sequence, at most; a longer text is several sequences."""

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


@dataclass
class Words:
    """The words (runs of letters, in lower case) of a batch of texts: each word's number among
    the different words, the number of words of each text, and the features of each different
    word, as table places with the place where a word's features start."""

    numbers: np.ndarray
    counts: np.ndarray
    places: np.ndarray
    starts: np.ndarray


def find_words(texts: list[str | None]) -> Words:
    lowered = [(text or "").lower() for text in texts]
    chars = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le", "replace"), "<u4")
    letter = _is_letter()[chars]
    edges = np.diff(np.concatenate(([False], letter)).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    bounds = np.cumsum([len(text) + 1 for text in lowered])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    with np.errstate(over="ignore"):
        hashes = segment_hashes(chars, starts, ends)
        different, first, numbers = np.unique(hashes, return_index=True, return_inverse=True)
        places, begins = _features(chars, starts[first], ends[first], different)
    return Words(numbers, counts, places, begins)


def _features(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
    """Places of all features of the given words. The last place of the table holds zeros."""
    none = (1 << BITS) - 1
    lengths = ends - starts
    if not len(lengths):
        return np.empty(0, np.int64), np.empty(0, np.int64)

    def place(values: np.ndarray, kind: int) -> np.ndarray:
        return (mix(values + np.uint64(kind) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(none)).astype(np.int64)

    # Every different word once, with a 0 before it, and two at the very end.
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    spelled = np.zeros(offsets[-1] + 4, np.uint64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(lengths.sum()) - np.repeat(offsets[:-1] - np.arange(len(lengths)), lengths)
    spelled[offsets[owner] + 1 + inside] = chars[starts[owner] + inside]
    n = offsets[-1]
    grams, code, open_ = [], spelled[:n].copy(), np.ones(n, bool)
    for size in (2, 3, 4):
        code = code * np.uint64(0x110001) + spelled[size - 1 : n + size - 1]
        grams.append(np.where(open_, place(code, size), none))
        open_ &= spelled[size - 1 : n + size - 1] != 0
    edge = [place(hashes, 9)]
    for size in (1, 2, 3):
        ok = lengths >= size
        for kind, at in ((10 + size, starts), (20 + size, ends - size)):
            at = np.where(ok, at, starts)
            edge.append(np.where(ok, place(segment_hashes(chars, at, np.where(ok, at + size, ends)), kind), none))
    per_gram, per_edge = 3 * (lengths + 1), len(edge)
    begins = np.concatenate(([0], np.cumsum(per_gram + per_edge)))[:-1]
    places = np.empty(begins[-1] + per_gram[-1] + per_edge, np.int64)
    word = np.repeat(np.arange(len(lengths)), lengths + 1)
    slot = begins[word] + np.arange(n) - offsets[word]
    for k, gram in enumerate(grams):
        places[slot + k * (lengths[word] + 1)] = gram
    for k, value in enumerate(edge):
        places[begins + per_gram + k] = value
    return places, begins


def _stretches(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of each stretch, padded with -1, and the text each stretch belongs to."""
    per_text = -(-counts // size)
    text = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    first = (np.cumsum(counts) - counts)[text] + nth * size
    length = np.minimum(size, counts[text] - nth * size)
    grid = first[:, None] + np.arange(size)
    return np.where(np.arange(size) < length[:, None], grid, -1), text


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Label scores of each different word."""
        if not len(words.starts):
            return np.zeros((0, len(self.labels)))
        return np.add.reduceat(self.weights[words.places], words.starts, axis=0).astype(np.float64)

    def marginals(self, scores: np.ndarray, mask: np.ndarray, pairs: bool = False):
        """Probabilities of each label at each place of the sequences (n, t, labels); with
        ``pairs`` also the expected number of each transition. Forward and backward messages
        are scaled to sum to 1."""
        n, t, k = scores.shape
        emit = np.exp(scores - scores.max(axis=2, keepdims=True))
        move = np.exp(self.transitions)
        forward, backward = np.empty((t, n, k)), np.empty((t, n, k))
        message = np.exp(self.start) * emit[:, 0]
        forward[0] = message / message.sum(axis=1, keepdims=True)
        for i in range(1, t):
            message = (forward[i - 1] @ move) * emit[:, i]
            message = message / message.sum(axis=1, keepdims=True)
            forward[i] = np.where(mask[:, i, None], message, forward[i - 1])
        backward[t - 1] = 1 / k
        for i in range(t - 2, -1, -1):
            message = (backward[i + 1] * emit[:, i + 1]) @ move.T
            message = message / message.sum(axis=1, keepdims=True)
            backward[i] = np.where(mask[:, i + 1, None], message, backward[i + 1])
        both = forward * backward
        both = (both / both.sum(axis=2, keepdims=True)).transpose(1, 0, 2) * mask[:, :, None]
        if not pairs:
            return both
        joint = np.zeros((k, k))
        for i in range(1, t):
            ahead = backward[i] * emit[:, i]
            each = forward[i - 1][:, :, None] * move * ahead[:, None, :]
            each /= each.sum(axis=(1, 2), keepdims=True)
            joint += each[mask[:, i]].sum(axis=0)
        return both, joint

    def label_shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the share of each label in its words, by the words' probabilities, and
        the number of words."""
        words = find_words(texts)
        shares = np.zeros((len(texts), len(self.labels)))
        if len(words.numbers):
            scores = self.scores(words)
            grid, text = _stretches(words.counts, STRETCH)
            for at in range(0, len(grid), 4096):
                part = grid[at : at + 4096]
                part = part[:, : int((part >= 0).sum(axis=1).max())]
                probabilities = self.marginals(scores[words.numbers[part]], part >= 0)
                np.add.at(shares, text[at : at + 4096], probabilities.sum(axis=1))
        return shares / np.maximum(words.counts, 1)[:, None], words.counts


def train(texts: list[str], labels: list[str], rounds: int = 40, rate: float = 0.4, decay: float = 1e-5) -> Model:
    """Fit on short texts with a label each, by full-batch AdaGrad on the log-likelihood.

    So that switches are seen too, half of the sequences are two texts in a row, paired at
    random with a fixed seed, each word with its own text's label."""
    kinds = sorted(set(labels))
    k = len(kinds)
    words = find_words(texts)
    used = np.flatnonzero(words.counts)
    number = {kind: i for i, kind in enumerate(kinds)}
    target = np.array([number[label] for label in labels], np.int64)
    first = np.cumsum(words.counts) - words.counts
    rng = np.random.default_rng(7)
    order = rng.permutation(used)
    half = len(order) // 2
    pairs = [(a,) for a in order[:half]] + list(zip(order[half:], np.roll(order[half:], 1)))
    size = max((int(sum(words.counts[list(p)])) for p in pairs), default=1)
    grid, gold = np.full((len(pairs), size), -1), np.zeros((len(pairs), size), np.int64)
    for row, members in enumerate(pairs):
        at = 0
        for text in members:
            count = words.counts[text]
            grid[row, at : at + count] = first[text] + np.arange(count)
            gold[row, at : at + count] = target[text]
            at += count
    mask = grid >= 0
    token = words.numbers[grid[mask]]
    model = Model(kinds, np.zeros((1 << BITS, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if not len(token) or k == 1:
        return model
    truth = np.zeros((len(token), k))
    truth[np.arange(len(token)), gold[mask]] = 1
    both = mask[:, 1:] & mask[:, :-1]
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    started = np.bincount(gold[:, 0], minlength=k)
    sums = [np.full_like(model.weights, 1e-8, np.float64), np.full((k, k), 1e-8), np.full(k, 1e-8)]
    spans = np.diff(np.append(words.starts, len(words.places)))
    total = len(token)
    for _ in range(rounds):
        probabilities, joint = model.marginals(model.scores(words)[words.numbers[grid]], mask, pairs=True)
        error = truth - probabilities[mask]
        by_word = np.stack([np.bincount(token, error[:, j], len(words.starts)) for j in range(k)], 1)
        by_place = np.repeat(by_word, spans, axis=0)
        gradient = np.stack([np.bincount(words.places, by_place[:, j], 1 << BITS) for j in range(k)], 1)
        gradient[-1] = 0
        steps = (gradient / total - decay * model.weights, (seen - joint) / total, (started - probabilities[:, 0].sum(axis=0)) / total)
        values = (model.weights, model.transitions, model.start)
        for value, step, held in zip(values, steps, sums):
            held += step**2
            value += (rate * step / np.sqrt(held)).astype(value.dtype)
    return model
