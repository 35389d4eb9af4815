"""Web archives with a two-level capture index.

Every page is a WARC record, compressed on its own. Pages with the payload of an earlier page
are revisit records without it. The captures are sorted by a key, the URL with its host
reversed, and written as compressed blocks of lines. A sparse directory at the end of each index
file holds the first key and the place of each block; the list of index files with their first
keys, one per task, is all that has to be known beforehand. A look-up searches the list, the
directory and the block by bisection, each read as a range of bytes, and then reads the record.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, parts, shared_folder
from .files import Reader, Writer

BLOCK_LINES = 256
_NO_PAGE = -(1 << 63)
_FOOT = 16

# --- fixed values: the archive format ---------------------------------------
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
"""The date of every record: the pages have none."""


def url_key(url: str | None) -> str:
    """The URL for sorting: host labels reversed, then port, path and query; no scheme, user or
    fragment. A URL that cannot be split is its own key; NULL has the empty key."""
    try:
        found = urlsplit(url or "")
        host, port = (found.hostname or "").rstrip("."), found.port
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    reversed_host = ",".join(reversed(host.split(".")))
    query = f"?{found.query}" if found.query else ""
    return f"{reversed_host}{f':{port}' if port else ''}){found.path or '/'}{query}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page_of(record_id: str) -> int | None:
    page = record_id.strip("<>").rpartition(":")[2]
    return None if page == "none" else int(page)


def _field(value: str | None) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value or "")


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response, or a revisit where ``refers_to`` is given. A revisit keeps the
    digest and, as an extension field, the length of the payload that it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _field(url)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Capture:
    """What a record says, read back."""

    page: int | None
    kind: str
    digest: str
    payload_bytes: int
    refers_to: int | None
    payload: bytes | None
    url: str


def parse(data: bytes) -> Capture:
    """A record read back; a response's payload is held against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = fields.get("WARC-Refers-To")
    payload = block.partition(b"\r\n\r\n")[2] if refers is None else None
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError(f"{fields['WARC-Record-ID']}: payload and digest differ")
    size = int(fields["WARC-Payload-Length"]) if payload is None else len(payload)
    page = _page_of(fields["WARC-Record-ID"])
    first = None if refers is None else _page_of(refers)
    return Capture(page, fields["WARC-Type"], digest, size, first, payload, fields["WARC-Target-URI"])


_CAPTURES = "url_key string, page_id long, file string, offset long, length long"


def _write_records(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, file = TaskContext.get(), None
        name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        for batch in batches:
            if file is None and batch.num_rows:
                file = Writer(folder, name)
            keys, offsets, lengths = [], [], []
            for page, url, payload, first, revisit in zip(*(column.to_pylist() for column in batch.columns)):
                data = gzip.compress(record(page, url, payload, first if revisit else None), 6, mtime=0)
                keys.append(url_key(url))
                offsets.append(file.write(data))
                lengths.append(len(data))
            columns = [pa.array(keys, pa.string()), batch.column(0), pa.array([name] * batch.num_rows, pa.string())]
            columns += [pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["url_key", "page_id", "file", "offset", "length"])
        if file is not None:
            file.close()

    return write


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[str, DataFrame]:
    """Write all pages to archives, a file for each task: the folder, and the captures
    ``url_key, page_id, file, offset, length``.

    Of equal payloads the one with the smallest id is the response. Repeated rows with that id
    are responses as well. NULL html is the empty payload; of rows without an id, those are
    responses whose payload no row with an id has. A payload that very many pages share is one
    key of the join by digest, which Spark splits.
    """
    folder = shared_folder(pages.sparkSession, "archive")
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1")
    )
    firsts = kept(rows.groupBy("sha1").agg(F.min("page_id").alias("first")), "payloads")
    rows = rows.join(firsts, "sha1")
    revisit = ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "payload", "first", revisit.alias("revisit"))
    return folder, kept(rows.mapInArrow(_write_records(folder), _CAPTURES), "captures")


_Place = tuple[str, int]


def _write_index(folder: str):
    """Lines in key order as compressed blocks, then their directory."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, file = TaskContext.get(), None
        name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}.gz"
        directory: list[list] = []
        lines: list[list] = []

        def flush() -> None:
            data = gzip.compress("\n".join(json.dumps(line, ensure_ascii=False) for line in lines).encode(), 6, mtime=0)
            directory.append([*lines[0][:2], file.write(data), len(data)])
            lines.clear()

        for batch in batches:
            if file is None and batch.num_rows:
                file = Writer(folder, name)
            for key, page, *place in zip(*(column.to_pylist() for column in batch.columns)):
                lines.append([key, _NO_PAGE if page is None else page, *place])
                if len(lines) == BLOCK_LINES:
                    flush()
        if file is None:
            return
        if lines:
            flush()
        data = gzip.compress(json.dumps(directory, ensure_ascii=False).encode(), 6, mtime=0)
        at = file.write(data)
        file.write(at.to_bytes(8, "little") + len(data).to_bytes(8, "little"))
        file.close()
        first = directory[0]
        columns = [pa.array([first[0]], pa.string()), pa.array([first[1]], pa.int64()), pa.array([name], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["url_key", "page_id", "file"])

    return write


class CaptureIndex:
    """Look-ups in the index files of a folder. ``files`` is their sorted list of first key,
    first page and name. Directories and blocks read last are remembered."""

    def __init__(self, folder: str, files: list[tuple[str, int, str]]):
        self._reader, self._files = Reader(folder), files
        self._memory: OrderedDict[tuple, list] = OrderedDict()

    def _remembered(self, key: tuple, load) -> list:
        if key not in self._memory:
            if len(self._memory) >= 64:
                self._memory.popitem(last=False)
            self._memory[key] = load()
        self._memory.move_to_end(key)
        return self._memory[key]

    def _directory(self, name: str) -> list:
        def load() -> list:
            size = self._reader.size(name)
            foot = self._reader.read(name, size - _FOOT, _FOOT)
            at, length = int.from_bytes(foot[:8], "little"), int.from_bytes(foot[8:], "little")
            return json.loads(gzip.decompress(self._reader.read(name, at, length)))

        return self._remembered((name,), load)

    def _block(self, name: str, at: int, length: int) -> list:
        def load() -> list:
            data = gzip.decompress(self._reader.read(name, at, length))
            return [json.loads(line) for line in data.decode().split("\n")]

        return self._remembered((name, at), load)

    def find(self, key: str, page: int | None) -> Iterator[tuple[str, int, int]]:
        """File, offset and length of each capture of a key and page."""
        want = (key, _NO_PAGE if page is None else page)
        place = lambda entry: (entry[0], entry[1])
        first = max(0, bisect.bisect_left(self._files, want, key=place) - 1)
        for _, _, name in self._files[first:]:
            directory = self._directory(name)
            if place(directory[0]) > want:
                return
            at = max(0, bisect.bisect_left(directory, want, key=place) - 1)
            for entry in directory[at:]:
                if place(entry) > want:
                    return
                lines = self._block(name, entry[2], entry[3])
                for line in lines[bisect.bisect_left(lines, want, key=place) :]:
                    if place(line) != want:
                        break
                    yield line[2], line[3], line[4]


def build_index(captures: DataFrame) -> tuple[str, list[tuple[str, int, str]]]:
    """Sort the captures into index files: the folder, and the list of files, one per task."""
    folder = shared_folder(captures.sparkSession, "index")
    ranges = captures.repartitionByRange(parts(captures), "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    files = kept(ranges.mapInArrow(_write_index(folder), "url_key string, page_id long, file string"), "index-files")
    return folder, sorted((row.url_key, row.page_id, row.file) for row in files.collect())


def read_archive(
    pages: DataFrame, archive: str, index: tuple[str, list[tuple[str, int, str]]],
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Look up the pages by URL and id and read their records: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``. Each capture found is one row; pages
    that the archive does not hold have none. The look-ups are sorted as the index is, so a
    task reads neighbouring blocks once."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, records = CaptureIndex(*index), Reader(archive)
        for batch in batches:
            rows = []
            for page, url in zip(*(column.to_pylist() for column in batch.columns)):
                for place in lookup.find(url_key(url), page):
                    found = parse(gzip.decompress(records.read(*place)))
                    if found.url == _field(url):  # another URL can have the same key
                        rows.append((found.page, found.payload_bytes, found.digest, found.kind, found.refers_to))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    wanted = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).distinct()
    host = F.split(F.regexp_extract("url", r"^[^:]*://([^/?#]*)", 1), r"\.")
    near = F.array_join(F.reverse(host), ",")
    ranges = wanted.repartitionByRange(parts(pages), near, "url", "page_id").sortWithinPartitions(near, "url", "page_id")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return ranges.mapInArrow(read, schema)


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write, index, look up and read back all pages. Two URLs with one key, and repeated rows,
    are separate captures; an empty table gives an empty table."""
    archive, captures = write_archive(pages, id_col, url_col, html_col)
    return read_archive(pages, archive, build_index(captures), id_col, url_col)
