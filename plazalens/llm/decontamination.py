"""Benchmark decontamination with an FM-index of each training shard.

A window is so many consecutive words of a benchmark item, or a shorter item as a whole. The
windows are written to the shared folder in blocks of bounded size. A task reads its documents
shard by shard. Words that no window of a block holds cannot be part of a hit, so they separate
the stretches of the shard that the index keeps, and stretches shorter than the shortest window
go. The block's windows are searched in the index backwards, a word at a time through wavelet
ranks; their places come from sampled suffix positions. What the windows cover is merged into
spans of words to remove.

Neither the benchmark nor the documents pass through the driver, and nothing of a document is
shuffled: a window found in a third of all documents is found where each of them lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder
from .files import open_folder
from .fm_index import FMIndex
from .shingles import mix

WINDOW = 10
BLOCK_ROWS = 1 << 18
"""Windows of a block, about; a benchmark of more is searched block by block."""
SHARD_WORDS = 1 << 21
SHARD_DOCS = 1 << 16
"""A shard is closed when it has so many words or documents."""
_CHUNK = 1 << 22
_ODD = np.uint64(0x9E3779B97F4A7C15)

# --- fixed values: a word is a run of digits, letters a-z and anything beyond ASCII; A-Z count
# --- as a-z
_DIGITS, _UPPER, _LOWER = range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B)


def _byte_table() -> bytes:
    """The byte that each byte counts as; 0 where it is not part of a word."""
    table = bytearray(256)
    for byte in (*_DIGITS, *_LOWER, *range(0x80, 0x100)):
        table[byte] = byte
    for byte in _UPPER:
        table[byte] = byte + 32
    return bytes(table)


_TABLE = _byte_table()


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of bytes, eight bytes at a time, and where the words start."""
    body = data.translate(_TABLE) + bytes(9)
    marks = np.frombuffer(body, np.uint8)[: len(data) + 1] != 0
    edges = np.flatnonzero(marks[1:] != marks[:-1]) + 1
    if marks[0]:
        edges = np.concatenate(([0], edges))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(body) - 7, "<u8", body, strides=(1,))
    out, rows, at = mix(sizes.astype(np.uint64) * _ODD), np.arange(len(starts)), 0
    while len(rows):
        rest = np.minimum(sizes[rows] - at, 8).astype(np.uint64)
        mask = ~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * rest)
        out[rows] = mix((out[rows] ^ (eight[starts[rows] + at] & mask)) * _ODD)
        at += 8
        rows = rows[sizes[rows] > at]
    return out, starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces that cut no word."""
    at = 0
    while len(text) - at > _CHUNK:
        end = at + _CHUNK
        while end < len(text) and _TABLE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of texts, one after another, and the number of each text's."""
    found, counts, chunk, held = [], np.zeros(len(texts), np.int64), [], 0

    def flush(first: int) -> None:
        hashes, starts = _hashes(b" ".join(chunk))
        bounds = np.cumsum([len(text) + 1 for text in chunk])
        counts[first : first + len(chunk)] += np.diff(np.searchsorted(starts, bounds), prepend=0)
        found.append(hashes)
        chunk.clear()

    with np.errstate(over="ignore"):
        for row, text in enumerate(texts):
            pieces = list(_pieces(text or b""))
            for piece in pieces:
                if len(pieces) > 1 or held + len(piece) > _CHUNK:
                    if chunk:
                        flush(row - len(chunk))
                    held = 0
                chunk.append(piece)
                held += len(piece) + 1
                if len(pieces) > 1:
                    flush(row)
                    held = 0
        if chunk:
            flush(len(texts) - len(chunk))
    return np.concatenate(found) if found else np.empty(0, np.uint64), counts


# --- the benchmark ----------------------------------------------------------


def _windows(size: int):
    """Rows ``item_id, text``: a row for each window, as its words' hashes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = word_hashes(batch.column(1).to_pylist())
            items, values, at = [], [], 0
            for row, count in enumerate(counts.tolist()):
                k = min(count, size)
                for first in range(at, at + count - k + 1 if k else at):
                    items.append(row)
                    values.append(hashes[first : first + k].tobytes())
                at += count
            taken = batch.column(0).take(pa.array(items, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken, pa.array(values, pa.binary())], ["item", "window"])

    return windows


def write_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> tuple[str, int]:
    """Write the different (item, window) rows in blocks: their folder and the number of blocks.
    A window of very many items is spread over the blocks."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    found = rows.mapInArrow(_windows(window), "item string, window binary").distinct()
    spark = benchmark.sparkSession
    plain, folder = shared_folder(spark, "windows"), shared_folder(spark, "window-blocks")
    found.write.parquet(plain)
    found = spark.read.schema(found.schema).parquet(plain)
    blocks = max(1, -(-found.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("window", "item"), F.lit(blocks)).cast("int").alias("block")
    found.select("*", block).repartition(blocks, "block").write.partitionBy("block").parquet(folder)
    return folder, blocks


@dataclass
class Block:
    """Windows to search: the sorted words of all, the different windows of each length as word
    numbers from 1, and the items of each window."""

    words: np.ndarray
    patterns: list[np.ndarray]
    shortest: int
    items: list[str]
    owners: np.ndarray
    bounds: np.ndarray


def read_block(folder: str, number: int) -> Block | None:
    system, path = open_folder(f"{folder}/block={number}")
    names = _parquet_files(system, path)
    tables = [pq.read_table(system.open_input_file(name), columns=["item", "window"]) for name in names]
    if not tables:
        return None
    table = pa.concat_tables(tables)
    windows = table.column("window").combine_chunks().dictionary_encode()
    items = table.column("item").combine_chunks().dictionary_encode()
    if isinstance(windows, pa.ChunkedArray):
        windows, items = windows.combine_chunks(), items.combine_chunks()
    texts = windows.dictionary.to_pylist()
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    words = np.unique(np.frombuffer(b"".join(texts), "<u8"))
    patterns, at = [], 0
    sizes = [len(texts[i]) // 8 for i in order]
    while at < len(order):
        end = at + sizes.count(sizes[at])
        hashes = np.frombuffer(b"".join(texts[i] for i in order[at:end]), "<u8")
        patterns.append((np.searchsorted(words, hashes) + 1).astype(np.uint32).reshape(-1, sizes[at]))
        at = end
    number_of = np.empty(len(order), np.int64)
    number_of[order] = np.arange(len(order))
    window = number_of[windows.indices.to_numpy(zero_copy_only=False)]
    known = np.asarray(items.is_valid())
    window, item = window[known], items.drop_null().indices.to_numpy(zero_copy_only=False)
    by_window = np.argsort(window, kind="stable")
    bounds = np.searchsorted(window[by_window], np.arange(len(order) + 1))
    return Block(words, patterns, sizes[0], items.dictionary.to_pylist(), item[by_window].astype(np.int64), bounds)


def _parquet_files(system: fs.FileSystem, path: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".parquet") and f.base_name[0] not in "._")


class _Blocks:
    """The blocks one after another; a single one stays in memory."""

    def __init__(self, folder: str, count: int):
        self._folder, self._count, self._only = folder, count, None

    def __iter__(self) -> Iterator[Block]:
        for number in range(self._count):
            block = self._only or read_block(self._folder, number)
            if self._count == 1:
                self._only = block
            if block is not None:
                yield block


# --- the documents ----------------------------------------------------------


def _numbered(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The number of each word among sorted ones, from 1; 0 for others."""
    bits = np.uint64(max(10, 2 + int(len(words)).bit_length()))
    seen = np.zeros(1 << int(bits), bool)
    seen[words >> (np.uint64(64) - bits)] = True
    there = np.flatnonzero(seen[hashes >> (np.uint64(64) - bits)])
    at = np.minimum(np.searchsorted(words, hashes[there]), len(words) - 1)
    out = np.zeros(len(hashes), np.uint32)
    out[there] = np.where(words[at] == hashes[there], at + 1, 0)
    return out


def kept_stretches(numbers: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretches without 0 of at least so many words, each followed by a 0, and where each of
    these words stood."""
    inside = np.concatenate(([False], numbers != 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    long = sizes >= shortest
    starts, sizes = starts[long], sizes[long] + 1
    ends = np.cumsum(sizes)
    places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    words = np.append(numbers, np.uint32(0))[places]
    if len(ends):
        words[ends - 1] = 0
    return words, places


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch, as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.concatenate(([True], starts[1:] > ends[:-1])) if len(ends) else np.empty(0, bool)
    last = np.concatenate((new[1:], [True])) if len(ends) else new
    return starts[new], ends[last]


class _Shard:
    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.hashes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.words = self.docs = 0

    def add(self, ids: pa.Array, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(ids)
        self.hashes.append(hashes)
        self.counts.append(counts)
        self.words += len(hashes)
        self.docs += len(ids)

    def searched(self, blocks: _Blocks) -> pa.RecordBatch:
        counts = np.concatenate(self.counts)
        docs = len(counts)
        # A place is left free after each document, so that no stretch reaches into the next.
        first = np.cumsum(counts + 1) - (counts + 1)
        hashes = np.concatenate(self.hashes)
        places = np.arange(len(hashes)) + np.repeat(np.arange(docs), counts)
        starts, ends = np.empty(0, np.int64), np.empty(0, np.int64)
        items: dict[int, set[str]] = {}
        for block in blocks:
            numbers = np.zeros(len(hashes) + docs, np.uint32)
            numbers[places] = _numbered(hashes, block.words)
            words, stood = kept_stretches(numbers, block.shortest)
            if not len(words):
                continue
            index, base = FMIndex(words, len(block.words)), 0
            for patterns in block.patterns:
                found = np.empty(0, np.int64)
                for pattern, at in index.occurrences(patterns):
                    at = stood[at]
                    more = merged(at, at + patterns.shape[1])
                    starts, ends = merged(np.concatenate((starts, more[0])), np.concatenate((ends, more[1])))
                    doc = np.searchsorted(first, at, "right") - 1
                    pairs = doc * np.int64(len(block.bounds)) + pattern + base
                    found = np.union1d(found, pairs)
                doc, window = np.divmod(found, np.int64(len(block.bounds)))
                sizes = block.bounds[window + 1] - block.bounds[window]
                ends_at = np.cumsum(sizes)
                which = np.repeat(np.arange(len(found)), sizes)
                owner = block.owners[np.arange(len(which)) - (ends_at - sizes)[which] + block.bounds[window][which]]
                pairs = np.unique(doc[which] * np.int64(len(block.items) + 1) + owner)
                for key in pairs.tolist():
                    at, item = divmod(key, len(block.items) + 1)
                    items.setdefault(at, set()).add(block.items[item])
                base += len(patterns)
        owner = np.searchsorted(first, starts, "right") - 1
        bounds = pa.array(np.searchsorted(owner, np.arange(docs + 1)), pa.int32())
        spans = pa.StructArray.from_arrays([pa.array(starts - first[owner]), pa.array(ends - first[owner])], ["start", "end"])
        lists = pa.array([sorted(items.get(doc, ())) for doc in range(docs)], pa.list_(pa.string()))
        columns = [pa.concat_arrays(self.ids), pa.array(counts), pa.ListArray.from_arrays(bounds, spans), lists]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "spans", "items"])


def _search(folder: str, count: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, shard = _Blocks(folder, count), _Shard()
        for batch in batches:
            at = 0
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            while at < batch.num_rows:
                end, size = at, 0
                while end < batch.num_rows and size <= _CHUNK:
                    size += sizes[end] + 1
                    end += 1
                part = batch.slice(at, end - at)
                shard.add(part.column(0), *word_hashes(part.column(1).to_pylist()))
                at = end
                if shard.words >= SHARD_WORDS or shard.docs >= SHARD_DOCS:
                    yield shard.searched(blocks)
                    shard = _Shard()
        if shard.docs:
            yield shard.searched(blocks)

    return search


FOUND = "doc_id long, n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``spans`` (stretches [start, end) of word
    numbers from 0 that windows of benchmark items cover, merged and in order), ``items`` (ids of
    the items with a window in the document, as strings and in their order).

    NULL and empty texts have no words; repeated rows and NULL ids are documents of their own. An
    item without words has no window. Item rows that share an id are one item with the windows of
    all; windows of an item without an id are hit, but no item is named for them. An empty table
    of either kind gives no hits. Other columns are ignored. A very long text is hashed in
    pieces, but a shard holds it as a whole (8 bytes a word).
    """
    folder, count = write_windows(benchmark, item_col, item_text_col, window)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    return rows.mapInArrow(_search(folder, count), FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, **columns: str | int) -> DataFrame:
    """`contaminated_spans` as numbers: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``."""
    found = contaminated_spans(docs, benchmark, **columns)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
