"""Packing token ids into sequences of bounded length, online and in bounded space.

A task keeps a fixed number of open windows. A document's ids, cut where a sequence is full, come
in one after another. A piece goes to the window that it fits best. Where none has room, the
fullest window gets as much of the piece as it can take and is emitted, and the rest is placed
like any piece. At the end the open windows are merged by the same rule, which leaves at most
one that is not full; those of all tasks are merged in rounds of 64 until one is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept
from .tokens import encoder

LENGTH = 2048
OPEN = 32
END = 1
_FAN_IN = 64
_SLICE = 512
"""Documents whose texts are held as Python strings at once."""

_PIECE = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())])
SEQUENCES = (
    "sequence_id long, length long, ids binary, "
    "pieces array<struct<doc_id: long, start: long, length: long, doc_tokens: long>>, full boolean"
)


@dataclass
class Window:
    size: int = 0
    ids: list[np.ndarray] = field(default_factory=list)
    pieces: list[tuple] = field(default_factory=list)

    def add(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> None:
        self.ids.append(ids)
        self.pieces.append((doc, start, len(ids), total))
        self.size += len(ids)


class Packer:
    """Places pieces and gives back the windows that are full."""

    def __init__(self, length: int = LENGTH, open_windows: int = OPEN):
        self.length, self.limit = length, open_windows
        self.open: list[Window] = []

    def add(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> Iterator[Window]:
        """Place a stretch of a document, ``start`` ids after its first of ``total``."""
        for at in range(0, len(ids), self.length):
            yield from self._place(doc, start + at, ids[at : at + self.length], total)

    def _place(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> Iterator[Window]:
        while len(ids):
            fitting = [w for w in self.open if self.length - w.size >= len(ids)]
            if fitting:
                window = max(fitting, key=lambda w: w.size)
            elif len(ids) == self.length or len(self.open) < self.limit:
                window = Window()
                self.open.append(window)
            else:
                window = max(self.open, key=lambda w: w.size)
            room = self.length - window.size
            window.add(doc, start, ids[:room], total)
            if window.size == self.length:
                self.open.remove(window)
                yield window
            start, ids = start + room, ids[room:]

    def merge(self) -> Iterator[Window]:
        """Empty the smaller windows into the fuller ones. At most one stays open."""
        left = sorted(self.open, key=lambda w: w.size)
        self.open, self.limit = [], 1
        for window in reversed(left):
            for (doc, start, _, total), ids in zip(window.pieces, window.ids):
                yield from self._place(doc, start, ids, total)


def _rows(windows: list[Window], first: int, full: bool) -> pa.RecordBatch:
    ids = [np.concatenate(w.ids).astype("<u4").tobytes() for w in windows]
    pieces = [[dict(zip(("doc_id", "start", "length", "doc_tokens"), p)) for p in w.pieces] for w in windows]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(first, first + len(windows)), pa.int64()),
            pa.array([w.size for w in windows], pa.int64()),
            pa.array(ids, pa.binary()),
            pa.array(pieces, pa.list_(_PIECE)),
            pa.array([full] * len(windows), pa.bool_()),
        ],
        ["sequence_id", "length", "ids", "pieces", "full"],
    )


def _packed(stretches: Iterator[tuple], round_: int, length: int, open_windows: int) -> Iterator[pa.RecordBatch]:
    """Sequences of one task, numbered by round, task and place."""
    number = ((round_ << 24) + TaskContext.get().partitionId()) << 32
    packer, ready = Packer(length, open_windows), []
    for stretch in stretches:
        ready += packer.add(*stretch)
        if len(ready) >= 256:
            yield _rows(ready, number, True)
            number, ready = number + len(ready), []
    ready += packer.merge()
    for windows, full in ((ready, True), (packer.open, False)):
        if windows:
            yield _rows(windows, number, full)
            number += len(windows)


def _pack(end: int, length: int, open_windows: int):
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                docs, texts = (column.to_pylist() for column in batch.slice(at, _SLICE).columns)
                for doc, ids in zip(docs, encoder().encode(texts)):
                    ids = np.append(ids, np.uint32(end))
                    yield doc, 0, ids, len(ids)

    return lambda batches: _packed(stretches(batches), 0, length, open_windows)


def _merge(round_: int, length: int, open_windows: int):
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for ids, pieces in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                ids, at = np.frombuffer(ids, "<u4"), 0
                for p in pieces:
                    yield p["doc_id"], p["start"], ids[at : at + p["length"]], p["doc_tokens"]
                    at += p["length"]

    return lambda batches: _packed(stretches(batches), round_, length, open_windows)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    length: int = LENGTH, open_windows: int = OPEN, end: int = END,
) -> DataFrame:
    """The sequences: ``sequence_id``, ``length``, ``ids`` (unsigned 32-bit, little-endian),
    ``pieces`` in order, ``full``. Only one sequence is not full.

    NULL and empty texts are the end id alone; repeated rows are packed each; NULL ids stay.
    A text of any length is cut into as many pieces as needed. An empty table gives no
    sequence. The sequences are written to the shared folder; what is merged over tasks is less
    than a sequence from each.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = kept(rows.mapInArrow(_pack(end, length, open_windows), SEQUENCES), "sequences", "zstd")
    done, left, round_ = packed.filter("full"), packed.filter("NOT full"), 1
    while (number := left.count()) > 1:
        # Dealt out by a shuffle, so that many tasks look for what is left.
        dealt = left.repartition(-(-number // _FAN_IN))
        merged = kept(dealt.mapInArrow(_merge(round_, length, open_windows), SEQUENCES), "merged", "zstd")
        done, left, round_ = done.unionByName(merged.filter("full")), merged.filter("NOT full"), round_ + 1
    return done.unionByName(left)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in batches:
        rows = []
        for number, ids, pieces in zip(*(batch.column(name).to_pylist() for name in ("sequence_id", "ids", "pieces"))):
            at = 0
            for p in pieces:
                crc = zlib.crc32(ids[4 * at : 4 * (at + p["length"])])
                rows.append((p["doc_id"], p["start"], p["length"], crc, p["doc_tokens"], number, at))
                at += p["length"]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return sequences.mapInArrow(_digest, schema)
