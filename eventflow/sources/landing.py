"""A landing folder as a log with positions (SRC-2).

Files are added to the folder under rising names, and lines to the end of the last file only.
A position is a file's name and a number of bytes of it: all before it has been read. So a
stream can start anywhere, and another stream can go on where one has stopped.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventflow import files

# The reader travels with its tasks, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "landing"
# A task reads so many bytes at most; files are cut between lines.
SPLIT_BYTES = 64 << 20
CHUNK = 4 << 20
EARLIEST, LATEST = "earliest", "latest"
BEGINNING = {"file": "", "bytes": 0}


@dataclass
class Range(InputPartition):
    """Lines of a file that begin in ``[first, last)``; the file counts from ``begin`` to ``end``."""

    file: str
    begin: int
    first: int
    last: int
    end: int


class Landing(DataSource):
    """Options: ``path``, ``start`` (a position as JSON, "earliest" or "latest"), ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LandingReader:
        return LandingReader(self.options["path"], self.options.get("start", EARLIEST), int(self.options.get("splitBytes", SPLIT_BYTES)))


class LandingReader(DataSourceStreamReader):
    def __init__(self, path: str, start: str, split_bytes: int):
        self.path, self.start, self.split_bytes = path, start, split_bytes

    def initialOffset(self) -> dict:
        if self.start == EARLIEST:
            return BEGINNING
        return self.latestOffset() if self.start == LATEST else parse_position(self.start)

    def latestOffset(self) -> dict:
        """After the last whole line: a line that is still being written is not read yet."""
        store, folder = _store(self.path)
        listed = _files(store, folder)
        if not listed:
            return BEGINNING
        name, size = listed[-1]
        return {"file": name, "bytes": _whole_lines(store, f"{folder}/{name}", size)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        store, folder = _store(self.path)
        found = []
        for name, size in _files(store, folder):
            if not start["file"] <= name <= end["file"]:
                continue
            begin = start["bytes"] if name == start["file"] else 0
            stop = end["bytes"] if name == end["file"] else size
            for first in range(begin, stop, self.split_bytes):
                found.append(Range(name, begin, first, min(first + self.split_bytes, stop), stop))
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, folder = _store(self.path)
        with store.open_input_file(f"{folder}/{partition.file}") as file:
            for lines in _lines(file, partition):
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])


def _lines(file, part: Range) -> Iterator[list[str]]:
    """The lines of a range, a few megabytes at a time; the last one may end beyond it."""
    at, held, skipping = part.first, b"", part.first > part.begin
    if skipping:
        # The line that the range begins in belongs to the one before, unless it begins right here.
        at -= 1
    file.seek(at)
    while at < part.end:
        data = file.read(min(CHUNK, part.end - at))
        if not data:
            break
        at += len(data)
        if skipping:
            cut = data.find(b"\n")
            if cut < 0:
                if at >= part.last:
                    return
                continue
            data, skipping = data[cut + 1 :], False
            if at - len(data) >= part.last:
                return
        held += data
        # Where the bytes at hand begin in the file.
        base = at - len(held)
        if at >= part.last:
            # The last line is the one that holds the last byte of the range.
            cut = held.find(b"\n", max(0, part.last - 1 - base))
            if cut >= 0:
                yield _texts(held[: cut + 1])
                return
        else:
            cut = held.rfind(b"\n")
            if cut >= 0:
                yield _texts(held[: cut + 1])
                held = held[cut + 1 :]
    if held:
        yield _texts(held)


def _texts(data: bytes) -> list[str]:
    lines = data.decode("utf-8", "replace").split("\n")
    if not lines[-1]:
        lines.pop()
    return [line[:-1] if line.endswith("\r") else line for line in lines]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the folder in it."""
    local = re.sub(r"^file:/*", "/", path)
    if "://" not in local:
        return fs.LocalFileSystem(), local.rstrip("/")
    store, folder = fs.FileSystem.from_uri(local)
    return store, folder.rstrip("/")


def _files(store: fs.FileSystem, folder: str) -> list[tuple[str, int]]:
    """Names and sizes in order; names that begin with a dot or an underscore are no data yet."""
    listed = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((i.base_name, i.size) for i in listed if i.type == fs.FileType.File and i.base_name[0] not in "._")


def _whole_lines(store: fs.FileSystem, path: str, size: int) -> int:
    """Bytes of a file up to the end of its last whole line."""
    with store.open_input_file(path) as file:
        while size > 0:
            first = max(0, size - CHUNK)
            file.seek(first)
            cut = file.read(size - first).rfind(b"\n")
            if cut >= 0:
                return first + cut + 1
            size = first
    return 0


def parse_position(text: str) -> dict:
    position = json.loads(text)
    if not isinstance(position, dict) or set(position) != {"file", "bytes"}:
        raise ValueError(f"a position has a file and bytes: {text}")
    return {"file": str(position["file"]), "bytes": int(position["bytes"])}


def last_position(spark: SparkSession, checkpoint: str, source: int = 0) -> str | None:
    """Where a stream's last finished batch ended, as its checkpoint tells; None before the first.

    It is what ``start`` takes, of any source whose offsets are JSON.
    """
    root = checkpoint.rstrip("/")
    done = set(files.children(spark, f"{root}/commits")) & set(files.children(spark, f"{root}/offsets"))
    batches = [int(name) for name in done if name.isdigit()]
    if not batches:
        return None
    # Fixed form: a version, the batch's settings, and a line for each source.
    return files.lines(spark, f"{root}/offsets/{max(batches)}")[2 + source]
