"""Decontamination against brute force, and the FM-index against plain search."""

import hashlib
import re

import numpy as np
import pytest

from plazalens.llm import decontamination, fm_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        found = words(text)
        k = min(len(found), size)
        for i in range(len(found) - k + 1 if k else 0):
            windows.setdefault(tuple(found[i : i + k]), set()).add(item)
    sizes = {len(window) for window in windows}
    out = []
    for doc, text in docs:
        found, hit, named = words(text), set(), set()
        for k in sizes:
            for i in range(len(found) - k + 1):
                if tuple(found[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    named |= windows[tuple(found[i : i + k])] - {None}
        ids = sorted(map(str, named))
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc, len(found), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=repr)


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [
    (1, PASSAGE), (10, "Alpha, BETA!"), (2, "é ü 42"), (3, None), (4, "!?"), (5, ""), (None, "nameless item here"),
    (6, " ".join(f"w{i}" for i in range(30))), (6, "second text of six"), (7, "alpha beta"), (8, "a" * 40 + " b"),
]
DOCS = [
    (1, f"before {PASSAGE} after"), (2, PASSAGE.upper().replace(" ", " - ")), (3, None), (4, ""), (5, "alpha beta alpha\nbeta"),
    (5, "alpha beta"), (None, "x é ü 42 y"), (6, "one two three four five six seven eight nine"), (7, "nameless item here"),
    (8, " ".join(f"w{i}" for i in range(5, 25)) + " w5 w6 " + PASSAGE), (9, "alpha"), (10, "beta alpha"), (11, "a" * 40 + " b"),
    (12, "a" * 39 + " b"), (13, " ".join(["alpha beta gamma"] * 30_000)), (14, PASSAGE + " " + PASSAGE), (15, "second text of six"),
    (16, "É ü 42"), (17, "  "),
]


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(*row, 1) for row in rows], "item_id long, text string, spans int")


def test_contamination(documents, items):
    got = decontamination.contamination(documents(DOCS), items(ITEMS))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(DOCS, ITEMS)


def test_blocks_of_windows_and_many_shards(documents, items, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_ROWS", 7)
    docs = [(i, f"lead {i} " + (PASSAGE if i % 3 == 0 else f"w{i % 9} alpha beta")) for i in range(300)] + DOCS
    got = decontamination.contamination(documents(docs), items(ITEMS))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, ITEMS)


def test_spans_are_merged_in_order(documents, items):
    docs = documents([(1, f"x {PASSAGE} y alpha beta alpha beta"), (2, "clean text")])
    rows = {r.doc_id: r for r in decontamination.contaminated_spans(docs, items(ITEMS)).collect()}
    assert [tuple(span) for span in rows[1].spans] == [(1, 13), (14, 18)]
    assert rows[1].items == ["1", "10", "7"]
    assert rows[2].spans == [] and rows[2].items == []


def test_empty_tables(documents, items):
    assert decontamination.contamination(documents([]), items(ITEMS)).collect() == []
    for none in ([], [(1, None), (2, "...")]):
        got = decontamination.contamination(documents(DOCS[:4]), items(none))
        assert sorted(map(tuple, got.collect()), key=repr) == brute(DOCS[:4], none)


def test_shards_are_independent_of_their_size():
    import pyarrow as pa

    hashes, counts = decontamination.word_hashes([text and text.encode() for _, text in DOCS])
    window, _ = decontamination.word_hashes([b"alpha beta"])
    block = decontamination.Block(np.unique(window), [np.array([[1, 2], [2, 1]], np.uint32)], 2, ["i"], np.zeros(2, np.int64), np.arange(3))
    whole = decontamination._Shard()
    whole.add(pa.array(range(len(DOCS)), pa.int64()), hashes, counts)
    one = whole.searched([block]).to_pylist()
    parts, at = [], 0
    for doc, count in enumerate(counts.tolist()):
        shard = decontamination._Shard()
        shard.add(pa.array([doc], pa.int64()), hashes[at : at + count], counts[doc : doc + 1])
        parts += shard.searched([block]).to_pylist()
        at += count
    assert one == parts


def test_words_of_long_texts_are_hashed_in_pieces(monkeypatch):
    texts = [None, b"", b"one Two-three " * 50, "é ".encode() * 20, b"x" * 300, b"one"]
    whole = decontamination.word_hashes(texts)
    monkeypatch.setattr(decontamination, "_CHUNK", 16)
    pieces = decontamination.word_hashes(texts)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all()
    assert whole[1].tolist() == [len(words((text or b"").decode())) for text in texts]
    assert len(set(whole[0].tolist())) == 5


def test_fm_index_finds_every_place():
    rng = np.random.default_rng(11)
    for _ in range(60):
        top = int(rng.integers(1, 6))
        text = np.append(np.tile(rng.integers(0, top + 1, int(rng.integers(1, 80))), 3), 0).astype(np.uint32)
        index = fm_index.FMIndex(text, top, step=int(rng.integers(1, 9)))
        size = int(rng.integers(1, 6))
        patterns = np.unique(rng.integers(1, top + 1, (30, size)).astype(np.uint32), axis=0)
        got = sorted((int(p), int(a)) for ps, at in index.occurrences(patterns) for p, a in zip(ps, at))
        lists = patterns.tolist()
        assert got == [(p, i) for p in range(len(lists)) for i in range(len(text)) if text[i : i + size].tolist() == lists[p]]


def test_suffixes_of_repeated_stretches_are_in_order():
    stretch = list(range(1, 60)) * 5
    text = np.array((stretch + [0]) * 40, np.uint32)
    order = fm_index.suffix_order(text, 59)
    ends = np.flatnonzero(text == 0)
    keys = [[(1, w) for w in text[i : ends[np.searchsorted(ends, i)]].tolist()] + [(0, int(ends[np.searchsorted(ends, i)]))] for i in range(len(text))]
    assert order.tolist() == sorted(range(len(text)), key=keys.__getitem__)
