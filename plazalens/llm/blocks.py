"""Token ids in files of patched frame-of-reference blocks.

A block holds 1024 ids. The block's smallest id is subtracted; what is left is packed with the
number of bits that 95 % of the block's values need. The other values lose their upper bits to
an exception list of places and whole values. A file is its blocks, then the byte at which
each block starts, then a footer; so any stretch of ids is read with two range reads.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, parts, shared_folder
from .files import Reader, Writer
from .tokens import encoder

BLOCK = 1024
SHARE = 0.95
END = 0
_LANES = BLOCK // 32
_AT_ONCE = 64
_HEAD = struct.Struct("<IBH")
_FOOT = struct.Struct("<4sQQQ")
_MARK = b"PFR1"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 1024 values of ``width`` bits as rows of 32-bit words, 32 lanes side by side."""
    words = np.zeros((len(values), max(width, 1), _LANES), "<u4")
    values = values.reshape(len(values), 32, _LANES).astype("<u4")
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        words[:, word] |= values[:, i] << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= values[:, i] >> np.uint32(32 - shift)
    return words[:, :width]


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    values = np.zeros((len(words), 32, _LANES), "<u4")
    mask = np.uint32((1 << width) - 1)
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        part = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            part = part | (words[:, word + 1] << np.uint32(32 - shift))
        values[:, i] = part & mask
    return values.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of ids; a last, shorter one is filled up with its smallest id."""
    missing = -len(ids) % BLOCK
    if missing:
        ids = np.concatenate((ids, np.full(missing, ids[len(ids) - len(ids) % BLOCK :].min(), ids.dtype)))
    table = ids.reshape(-1, BLOCK).astype(np.uint32)
    least = table.min(axis=1)
    rest = table - least[:, None]
    bits = np.searchsorted(np.uint64(1) << np.arange(32, dtype=np.uint64), rest.astype(np.uint64), "right").astype(np.uint8)
    at = int(np.ceil(SHARE * BLOCK)) - 1
    widths = np.partition(bits, at, axis=1)[:, at]
    out: list[bytes] = [b""] * len(table)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        packed = _pack(rest[rows] & np.uint32((1 << width) - 1), width)
        for row, words in zip(rows.tolist(), packed):
            places = np.flatnonzero(bits[row] > width)
            head = _HEAD.pack(int(least[row]), width, len(places))
            out[row] = head + words.tobytes() + places.astype("<u2").tobytes() + rest[row, places].astype("<u4").tobytes()
    return out


def decode_block(data: bytes) -> np.ndarray:
    least, width, n = _HEAD.unpack_from(data)
    at = _HEAD.size + 4 * width * _LANES
    words = np.frombuffer(data, "<u4", width * _LANES, _HEAD.size).reshape(1, width, _LANES)
    values = _unpack(words, width)[0]
    values[np.frombuffer(data, "<u2", n, at)] = np.frombuffer(data, "<u4", n, at + 2 * n)
    return values + np.uint32(least)


class BlockWriter:
    """A file of ids, written as they come."""

    def __init__(self, folder: str, name: str):
        self._file, self._starts = Writer(folder, name), []
        self._held, self._size, self.count = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids)
        self._size += len(ids)
        self.count += len(ids)
        if self._size >= _AT_ONCE * BLOCK:
            ids = np.concatenate(self._held)
            cut = len(ids) - len(ids) % BLOCK
            self._write(ids[:cut])
            self._held, self._size = [ids[cut:]], len(ids) - cut

    def _write(self, ids: np.ndarray) -> None:
        for block in encode_blocks(ids):
            self._starts.append(self._file.write(block))

    def close(self) -> None:
        if self._size:
            self._write(np.concatenate(self._held))
        at = self._file.write(np.array([*self._starts, self._file.size], "<u8").tobytes())
        self._file.write(_FOOT.pack(_MARK, self.count, len(self._starts), at))
        self._file.close()


class BlockReader:
    """Stretches of ids from the files of a folder. Some blocks are read ahead."""

    def __init__(self, folder: str):
        self._files, self._name = Reader(folder), None

    def _open(self, name: str) -> None:
        if name == self._name:
            return
        size = self._files.size(name)
        mark, self.count, n, at = _FOOT.unpack(self._files.read(name, size - _FOOT.size, _FOOT.size))
        if mark != _MARK:
            raise ValueError(f"{name} is not a file of blocks")
        self._starts = np.frombuffer(self._files.read(name, at, 8 * (n + 1)), "<u8").astype(np.int64)
        self._name, self._first, self._ids = name, 0, np.empty(0, np.uint32)

    def read(self, name: str, start: int, length: int) -> np.ndarray:
        self._open(name)
        out = []
        while length:
            at = start - self._first
            if not 0 <= at < len(self._ids):
                self._load(start // BLOCK)
                at = start - self._first
            part = self._ids[at : at + length]
            out.append(part)
            start, length = start + len(part), length - len(part)
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def _load(self, block: int) -> None:
        last = min(block + _AT_ONCE, len(self._starts) - 1)
        base = self._starts[block]
        data = self._files.read(self._name, int(base), int(self._starts[last] - base))
        cuts = (self._starts[block : last + 1] - base).tolist()
        blocks = [decode_block(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        self._ids, self._first = np.concatenate(blocks)[: self.count - block * BLOCK], block * BLOCK


_INDEX = "doc_id long, part int, file string, start long, n_tokens long"


def _write(folder: str, end: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId()
        name = f"ids-{part:06d}-{task.taskAttemptId()}.pfr"
        file = None
        for batch in batches:
            if file is None and batch.num_rows:
                file = BlockWriter(folder, name)
            starts, counts = [], []
            for ids in encoder().encode(batch.column(1).to_pylist()):
                starts.append(file.count)
                counts.append(len(ids) + 1)
                file.add(np.append(ids, np.uint32(end)))
            n = batch.num_rows
            columns = [pa.array([part] * n, pa.int32()), pa.array([name] * n, pa.string()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "part", "file", "start", "n_tokens"])
        if file is not None:
            file.close()

    return write


def write_ids(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end: int = END
) -> tuple[str, DataFrame]:
    """Write the ids of all documents in ascending order of the document's id, with the id
    ``end`` after each: the folder, and the table of documents ``doc_id``, ``file``, ``at``
    (place in the file), ``start`` (ids before it in all files), ``n_tokens``.

    Documents are dealt out by ranges of their ids, a file for each range. NULL ids come first;
    repeated ids follow each other, ordered by text. NULL and empty texts are the end id alone.
    A task that is run again writes a file of another name, and the table names only files of
    tasks that ended. An empty table gives an empty table and no file.
    """
    folder = shared_folder(docs.sparkSession, "ids")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranges = rows.repartitionByRange(parts(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    index = kept(ranges.mapInArrow(_write(folder, end), _INDEX), "ids-index")
    files = index.groupBy("file", "part").agg(F.sum("n_tokens").alias("n"))  # one row per task
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = index.join(kept(files.select("file", before.alias("before")), "ids-files"), "file")
    start = (F.col("start") + F.col("before")).alias("start")
    return folder, placed.select("doc_id", "file", F.col("start").alias("at"), start, "n_tokens")


def read_ids(folder: str, index: DataFrame) -> DataFrame:
    """Read documents back: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (unsigned 32-bit,
    little-endian) and their ``ids_crc32``. Any rows of the index in any order will do; rows in
    the order of the file read each block once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = BlockReader(folder)
        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in ("file", "at", "n_tokens")))
            ids = [files.read(*row).astype("<u4").tobytes() for row in rows]
            columns = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
            crcs = pa.array([zlib.crc32(data) for data in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary()), crcs], ["doc_id", "start", "n_tokens", "ids", "ids_crc32"])

    return index.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")
