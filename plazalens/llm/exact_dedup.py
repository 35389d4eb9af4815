"""Exact duplicates by an extendible-hash index kept in shared files.

Every text has a 64-bit key. The keys are cut into ranges, many more than tasks, and each task
owns some ranges. It reads the texts of a range in key order; texts with the same key form a
chain and are told apart byte by byte. The entries of a range go into buckets found through a
directory of the next bits of the key. A bucket that overflows is split in two by one more bit,
and the directory doubles when the bucket already used all its bits. The buckets are written as
a Parquet table in the shared folder. A text is looked up by its key alone: the key's first bits
give the range, its next bits the slot of the range's directory, the slot the bucket, and the
chain of the key in that bucket is searched for the text's digest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, kept, parts

BUCKET = 512
"""Keys a bucket holds before it is split."""
DEPTH = 16
"""Bits of a directory, at most; a bucket that has used them all grows instead."""
RANGE_ROWS = 1 << 15
"""Rows of a key range, on average, at most."""
SLICE = 256
"""Rows that a task holds as Python objects, or hands on, at a time."""

_COMBINED = "owner long, key long, text binary, digest binary, keep_id long, copies long"
INDEX = "owner long, bucket long, depth int, key long, chain int, digest binary, keep_id long, copies long"


def normalised(text: Column) -> Column:
    """The text with each run of ASCII blanks as one space; empty for NULL."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


class Directory:
    """The directory of one key range: a slot for every value of the ``depth`` bits that follow
    the range's own bits, pointing to a bucket. Buckets are dicts from key to chain. Written, a
    directory is the depths of its buckets, empty ones too, in slot order."""

    def __init__(self, range_bits: int, capacity: int = BUCKET):
        self.range_bits, self.capacity = range_bits, capacity
        self.depth = 0
        self.slots: list[tuple[int, dict]] = [(0, {})]

    def _slot(self, key: int, depth: int) -> int:
        tail = (key << self.range_bits) & 0xFFFFFFFFFFFFFFFF
        return tail >> (64 - depth) if depth else 0

    def chain(self, key: int) -> list:
        """The chain of a key; a new one if there is none. Keys are unsigned."""
        while True:
            depth, bucket = self.slots[self._slot(key, self.depth)]
            full = len(bucket) >= self.capacity and depth < DEPTH
            if key in bucket or not full:
                return bucket.setdefault(key, [])
            self._split(key, depth, bucket)

    def _split(self, key: int, depth: int, bucket: dict) -> None:
        if depth == self.depth:
            self.slots = [slot for slot in self.slots for _ in range(2)]
            self.depth += 1
        halves: tuple[dict, dict] = ({}, {})
        for other, chain in bucket.items():
            halves[self._slot(other, depth + 1) & 1][other] = chain
        width = 1 << (self.depth - depth - 1)
        first = self._slot(key, depth) * 2 * width
        for half in (0, 1):
            start = first + half * width
            self.slots[start : start + width] = [(depth + 1, halves[half])] * width

    def buckets(self) -> Iterator[tuple[int, int, dict]]:
        """Each bucket once: its number among those of its depth, the depth, its chains."""
        at = 0
        while at < len(self.slots):
            depth, bucket = self.slots[at]
            width = 1 << (self.depth - depth)
            yield at // width, depth, bucket
            at += width


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch become one row, so that a text in a third of all rows reaches its
    owner as a few rows of each task. Texts of one digest are compared byte by byte, in place:
    no text becomes a Python object."""
    names = ["owner", "key", "text", "digest", "keep_id", "copies"]
    for batch in batches:
        owner, key, text, digest, ids = batch.columns
        keep: list[int | None] = ids.to_pylist()
        copies = [1] * len(keep)
        first: dict[bytes, list[int]] = {}
        rows: list[int] = []
        for row, fingerprint in enumerate(digest.to_pylist()):
            seen = first.setdefault(fingerprint, [])
            at = next((other for other in seen if text[other].equals(text[row])), None)
            if at is None:
                seen.append(row)
                rows.append(row)
            else:
                keep[at] = _least(keep[at], keep[row])
                copies[at] += 1
        for start in range(0, len(rows), SLICE):
            part = rows[start : start + SLICE]
            columns = [column.take(pa.array(part)) for column in (owner, key, text, digest)]
            counts = [pa.array([values[row] for row in part], pa.int64()) for values in (keep, copies)]
            yield pa.RecordBatch.from_arrays(columns + counts, names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, as Python objects of few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield from zip(*(column.to_pylist() for column in batch.slice(start, SLICE).columns))


def _own(range_bits: int, capacity: int):
    names = [field.split()[0] for field in INDEX.split(", ")]
    kinds = (
        pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(),
    )

    def written(owner: int, directory: Directory) -> pa.RecordBatch:
        rows: list[tuple] = [
            (owner, number, depth, key - (1 << 64) if key >> 63 else key, link, digest, keep, copies)
            for number, depth, bucket in directory.buckets()
            for key, chain in bucket.items()
            for link, (digest, keep, copies) in enumerate(chain)
        ]
        rows += [
            (owner, number, depth, None, None, None, None, None)
            for number, depth, bucket in directory.buckets()
            if not bucket
        ]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, directory = None, None
        key, texts = None, []
        for at, row_key, text, digest, doc, copies in _rows(batches):
            if at != owner:
                if directory is not None:
                    yield written(owner, directory)
                owner, directory, key = at, Directory(range_bits, capacity), None
            unsigned = row_key & 0xFFFFFFFFFFFFFFFF
            if unsigned != key:  # the texts of one key only are held, to be compared
                key, texts = unsigned, []
            chain = directory.chain(unsigned)
            if text in texts:
                entry = chain[texts.index(text)]
                entry[1], entry[2] = _least(entry[1], doc), entry[2] + copies
            else:
                texts.append(text)
                chain.append([digest, doc, copies])
        if directory is not None:
            yield written(owner, directory)

    return own


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, body, key, digest``: the normalised text, its 64-bit key and its SHA-256."""
    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("body"))
    return body.select("*", F.xxhash64("body").alias("key"), F.unhex(F.sha2("body", 256)).alias("digest"))


def range_bits(docs: DataFrame) -> int:
    """First bits of a key that tell its range: some eight ranges for each task, and more where
    they would hold over `RANGE_ROWS` rows on average."""
    return max(1, math.ceil(math.log2(max(8 * parts(docs), docs.count() / RANGE_ROWS, 2))))


def build_index(
    docs: DataFrame, bits: int, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET
) -> DataFrame:
    """The index table: a row for each different text, with its bucket, the smallest id of its
    copies and their number, and a row without a key for each empty bucket. It is written to the
    shared folder once, in bucket order."""
    n = parts(docs)
    rows = keyed(docs, id_col, text_col).select(
        F.shiftrightunsigned("key", 64 - bits).alias("owner"),
        "key", F.encode("body", "UTF-8").alias("text"), "digest", "doc_id",
    )
    combined = rows.mapInArrow(_combine, _COMBINED)
    owned = combined.repartition(n, "owner").sortWithinPartitions("owner", "key")
    return kept(owned.mapInArrow(_own(bits, capacity), INDEX), "dedup-index")


def directories(index: DataFrame) -> DataFrame:
    """``owner``, ``slots`` of each key range: the depth of the bucket that each slot points to.

    A bucket of depth d has as many neighbouring slots as the deepest bucket has bits more than
    d. There are at most 2 ** `DEPTH` slots in a range, one byte each.
    """
    buckets = index.select("owner", "bucket", "depth").distinct()
    start = F.expr(f"shiftleft(bucket, {DEPTH} - depth)").alias("start")
    in_order = F.array_sort(F.collect_list(F.struct(start, "depth")))
    ranges = buckets.groupBy("owner").agg(in_order.alias("buckets"), F.max("depth").alias("deepest"))
    slots = "flatten(transform(buckets, b -> array_repeat(CAST(b.depth AS TINYINT), 1 << (deepest - b.depth))))"
    return ranges.select("owner", "deepest", F.expr(slots).alias("slots"))


def located(rows: DataFrame, index: DataFrame, bits: int) -> DataFrame:
    """Rows that have a ``key``, with ``owner``, ``bucket`` and ``depth``, as the written
    directories say."""
    owner = F.shiftrightunsigned("key", 64 - bits).alias("owner")
    tail = F.shiftleft("key", bits).alias("tail")
    found = rows.select("*", owner, tail).join(directories(index), "owner")
    # A shift by 64 bits would be one by none.
    slot = F.expr("CASE WHEN deepest = 0 THEN 0 ELSE shiftrightunsigned(tail, 64 - deepest) END")
    depth = F.element_at("slots", (slot + 1).cast("int")).cast("int").alias("depth")
    found = found.select(*rows.columns, "owner", "tail", depth)
    bucket = F.expr("CASE WHEN depth = 0 THEN 0 ELSE shiftrightunsigned(tail, 64 - depth) END")
    return found.select(*rows.columns, "owner", bucket.cast("long").alias("bucket"), "depth")


def look_up(rows: DataFrame, index: DataFrame, bits: int) -> DataFrame:
    """Rows that have ``key`` and ``digest``, with ``keep_id`` and ``copies`` of their text: each
    goes to the bucket that its directory names, and there along the chain of its key."""
    chains = index.filter("key IS NOT NULL").select("owner", "bucket", "depth", "key", "digest", "keep_id", "copies")
    found = located(rows, index, bits).join(chains, ["owner", "bucket", "depth", "key", "digest"])
    return found.select(*rows.columns, "keep_id", "copies")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id`` (smallest id with an equal text),
    ``group_size``, ``kept``, ``text_sha256``.

    NULL and empty texts are equal. A repeated row is a copy like any other, so rows that share
    the smallest id all stay. Rows without an id count as copies; they stay only where no copy
    has an id. An empty table gives an empty table. Other columns are ignored.

    The look-up joins 48 bytes per document to the directories and then to the buckets; a text
    with very many copies is one key of those joins, which Spark splits.
    """
    bits = range_bits(docs)
    index = build_index(docs, bits, id_col, text_col)
    rows = keyed(docs, id_col, text_col).select("doc_id", "key", "digest")
    return look_up(rows, index, bits).select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: the rows that `exact_groups` calls kept,
    and rows without an id where no copy has one. A row stays by its id and its text, so of rows
    that share an id only those stay whose own text has no smaller id."""
    index = build_index(docs, range_bits(docs), id_col, text_col).filter("key IS NOT NULL")
    keep = index.select(F.col("keep_id").alias("__keep"), F.col("digest").alias("__digest"))
    digest = F.unhex(F.sha2(normalised(docs[text_col]), 256))
    return docs.join(keep, (digest == F.col("__digest")) & docs[id_col].eqNullSafe(F.col("__keep")), "left_semi")
