"""Token ids, packing and blocks: exact round trips against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from plazalens.llm import blocks, packing
from plazalens.llm.tokens import Encoder

PARTS = [
    "a", "b", "s", "t", "re", "ll", "'", "'s", "'re", " ", "  ", "\n", "\t", "1", "23", "!", "#", "é", "ß", "x", " '",
    "\r\n", "Z", "_", "-", ".", "€", " ", "日本", "😀", "ſ", "\x1c", "\x85", "<|endoftext|>", "d", "m", "ve",
]


@pytest.fixture(scope="module")
def library():
    found = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_library(library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(25))) for _ in range(3000)] + [None, "", "word " * 3000]
    assert [ids.tolist() for ids in Encoder().encode(texts)] == [library(text) for text in texts]


def test_the_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr("plazalens.llm.tokens._MEMORY", 50)
    monkeypatch.setattr("plazalens.llm.tokens._CHUNK", 100)
    encoder, rng = Encoder(), random.Random(2)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(20)) for _ in range(100)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == [library(text) for text in texts]
    assert len(encoder._codes) <= 150


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    monkeypatch.setattr("plazalens.llm.tokens._CHUNK", 40)
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS + [" a", " b1"] * 9, k=400)) for _ in range(60)] + ["x" * 500, " " * 200]
    assert [ids.tolist() for ids in Encoder().encode(texts)] == [library(text) for text in texts]


ROWS = [
    (9, "long " * 9000), (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (5, "é€日本 <|endoftext|>"), (None, "no id"),
    (-4, "negative"), *[(100 + i, f"text number {i} " * (i % 90)) for i in range(300)],
]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def held_against_the_library(pieces, rows, library):
    """Every id of every document lies in exactly one piece; sequences have no gaps."""
    wanted = Counter((doc, tuple([*library(text), 1])) for doc, text in rows)
    by_total = defaultdict(set)
    for doc, ids in wanted:
        by_total[doc, len(ids)].add(ids)
    covered = Counter()
    for p in pieces:
        (ids,) = by_total[p.doc_id, p.doc_tokens]
        assert p.ids_crc32 == crc(ids[p.start : p.start + p.length])
        for place in range(p.start, p.start + p.length):
            covered[p.doc_id, ids, place] += 1
    assert covered == {(doc, ids, i): n for (doc, ids), n in wanted.items() for i in range(len(ids))}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    sizes = []
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    return sizes


def test_packing(documents, library):
    docs = documents(ROWS).repartition(7)
    pieces = packing.pieces(packing.pack(docs, open_windows=3)).collect()
    sizes = held_against_the_library(pieces, ROWS, library)
    assert sum(size != 2048 for size in sizes) <= 1 and max(sizes) == 2048


def test_leftovers_are_merged_in_rounds(documents, library, monkeypatch):
    monkeypatch.setattr(packing, "_FAN_IN", 2)
    rows = [(i, f"short {i}") for i in range(60)]
    pieces = packing.pieces(packing.pack(documents(rows).repartition(9), length=64)).collect()
    sizes = held_against_the_library(pieces, rows, library)
    assert sum(size != 64 for size in sizes) <= 1


def test_packing_of_few_or_no_rows(documents, library):
    assert packing.pieces(packing.pack(documents([]))).collect() == []
    pieces = packing.pieces(packing.pack(documents([(1, None)]))).collect()
    assert held_against_the_library(pieces, [(1, None)], library) == [1]


def test_a_packer_keeps_to_its_windows_and_emits_the_fullest():
    packer = packing.Packer(10, 2)
    out = []
    for doc, size in enumerate([6, 7, 3, 8, 1, 9, 10, 4]):
        out += packer.add(doc, 0, np.arange(size, dtype=np.uint32), size)
        assert len(packer.open) <= 2
    assert all(window.size == 10 for window in out)
    assert out[0].pieces == [(1, 0, 7, 7), (2, 0, 3, 3)]  # 3 fits best beside 7
    out += packer.merge()
    assert len(packer.open) <= 1
    assert sum(w.size for w in [*out, *packer.open]) == 48


@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 2**32 - 1])
@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 5000])
def test_blocks_round_trip(high, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, np.uint64, endpoint=True).astype(np.uint32)
    ids[rng.random(n) < 0.7] //= 1000  # outliers
    data = blocks.encode_blocks(ids)
    assert np.array_equal(np.concatenate([blocks.decode_block(block) for block in data])[:n], ids)


def test_outliers_do_not_widen_a_block():
    ids = np.full(1024, 7, np.uint32)
    ids[:40] = 50_000
    (block,) = blocks.encode_blocks(ids)
    assert len(block) == blocks._HEAD.size + 40 * 6
    assert np.array_equal(blocks.decode_block(block), ids)


def test_stretches_are_read_from_anywhere(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50_257, 200_000).astype(np.uint32)
    writer = blocks.BlockWriter(f"file://{tmp_path}", "x.pfr")
    for at in range(0, len(ids), 777):
        writer.add(ids[at : at + 777])
    writer.close()
    assert [p.name for p in tmp_path.iterdir()] == ["x.pfr"]
    reader, rng = blocks.BlockReader(f"file:{tmp_path}"), random.Random(3)
    for _ in range(100):
        start = rng.randrange(len(ids))
        length = rng.randrange(min(5000, len(ids) - start) + 1)
        assert np.array_equal(reader.read("x.pfr", start, length), ids[start : start + length])
    with pytest.raises(FileNotFoundError):
        reader.read("y.pfr", 0, 1)


def test_ids_written_and_read_back(documents, library):
    folder, index = blocks.write_ids(documents(ROWS).repartition(5))
    got = sorted(blocks.read_ids(folder, index).collect(), key=lambda row: row.start)
    at, order = 0, sorted(ROWS, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    assert len(got) == len(order)
    for row, (doc, text) in zip(got, order):
        ids = [*library(text), 0]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc, at, len(ids), crc(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        at += len(ids)
    folder, index = blocks.write_ids(documents([]))
    assert blocks.read_ids(folder, index).collect() == []
