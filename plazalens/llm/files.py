"""Binary files in the shared folder, by the address Spark knows it by."""

from __future__ import annotations

from collections import OrderedDict

from pyarrow import NativeFile, fs


def open_folder(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address such as ``file:///shared/x`` or ``hdfs://host/x``, and the
    path within it."""
    if "://" not in address and address.startswith("file:"):
        address = "file://" + address.removeprefix("file:")
    return fs.FileSystem.from_uri(address)


class Writer:
    """One file being written. It gets its name only when it is complete, so a task that dies
    half-way leaves nothing that a reader would take for a file."""

    def __init__(self, folder: str, name: str):
        self._fs, path = open_folder(folder)
        self._fs.create_dir(path, recursive=True)
        self._path, self._draft = f"{path}/{name}", f"{path}/.{name}.part"
        self._out = self._fs.open_output_stream(self._draft, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; the answer is where the data start."""
        start = self.size
        self._out.write(data)
        self.size += len(data)
        return start

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._draft, self._path)


class Reader:
    """Range reads from the files of one folder; the files read last stay open."""

    _OPEN = 16

    def __init__(self, folder: str):
        self._fs, self._path = open_folder(folder)
        self._files: OrderedDict[str, NativeFile] = OrderedDict()

    def _open(self, name: str) -> NativeFile:
        if name in self._files:
            self._files.move_to_end(name)
        else:
            if len(self._files) >= self._OPEN:
                self._files.popitem(last=False)[1].close()
            self._files[name] = self._fs.open_input_file(f"{self._path}/{name}")
        return self._files[name]

    def size(self, name: str) -> int:
        return self._open(name).size()

    def read(self, name: str, start: int, length: int) -> bytes:
        data = self._open(name).read_at(length, start)
        if len(data) != length:
            raise EOFError(f"{name} ends before {start + length}")
        return data
