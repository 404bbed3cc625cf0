"""Growing files as a stream: every finished line once, in byte ranges.

Spark's own text stream reads a file once and never looks back, so following files that
grow needs a source of its own. Offsets are `{file id: {path, end, marks}}`; an end always lies
behind a line break, and the marks are checksums of blocks before it. A file goes on at an end
only where the marks still hold: a file truncated and grown again past its old end is read from
its start, a renamed one goes on, and so does one that other files with the same first line join
or leave. The files must be on a folder that the driver and all executors see.
"""

from __future__ import annotations

import fnmatch
import glob
import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Fixed value: how much of the first line identifies a file.
FINGERPRINT_BYTES = 256

SCHEMA = (
    "path string, file_id string, start_offset long, end_offset long, "
    "payload string, refused_bytes long"
)
BLOCK = 1 << 20
# Bytes of a block whose checksum is kept with an offset.
MARK_BYTES = 4096


def fingerprint(path: str, skip: int = 0) -> str | None:
    """Checksum of a file's first line after a header of `skip` bytes; None before it ends."""
    with open(path, "rb") as file:
        file.seek(skip)
        head = file.read(FINGERPRINT_BYTES)
    line, found, _ = head.partition(b"\n")
    if not found and len(head) < FINGERPRINT_BYTES:
        return None
    return f"{zlib.crc32(line):08x}"


def last_break(path: str, size: int) -> int:
    """Offset behind the last line break of the first `size` bytes."""
    with open(path, "rb") as file:
        end = size
        while end > 0:
            begin = max(0, end - BLOCK)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return 0


def block_marks(path: str, end: int) -> list[list[int]]:
    """[place, checksum] of blocks that end at `end`, at half of it, at a quarter and so on.

    Few blocks however long the file; together they tell whether it still begins as it did.
    """
    marks, at = [], end
    with open(path, "rb") as file:
        while at > 0:
            marks.append([at, _block_sum(file, at)])
            at //= 2
    return marks


def _block_sum(file: BinaryIO, at: int) -> int:
    begin = max(0, at - MARK_BYTES)
    file.seek(begin)
    return zlib.crc32(file.read(at - begin))


def goes_on(path: str, entry: dict) -> bool:
    """Whether a file still begins with what was read up to an offset's end."""
    with open(path, "rb") as file:
        if file.seek(0, os.SEEK_END) < entry["end"]:
            return False
        return all(_block_sum(file, at) == known for at, known in entry.get("marks", []))


def range_lines(path: str, file_id: str, start: int, end: int, max_line: int, wrap: bool) -> Iterator[tuple]:
    """Rows of SCHEMA for the lines that begin in a byte range."""
    if end <= start:
        return
    with open(path, "rb") as file:
        # A line belongs to the range it begins in.
        at = start
        if at > 0:
            file.seek(at - 1)
            if file.read(1) != b"\n":
                at += _pass_line(file)
        file.seek(at)
        while at < end:
            line = file.readline(max_line + 1)
            if not line:
                return
            size, refused = len(line), None
            if not line.endswith(b"\n") and size > max_line:
                size += _pass_line(file)
                refused = size
            begin, at = at, at + size
            text = line.decode("utf-8", errors="replace").strip()
            if refused is None and not text:
                continue
            payload = None
            if refused is None:
                payload = json.dumps({"line": text}, ensure_ascii=False) if wrap else text
            yield (path, file_id, begin, at, payload, refused)


def _pass_line(file: BinaryIO) -> int:
    """Skip to behind the next line break; returns the bytes passed."""
    passed = 0
    while True:
        piece = file.readline(BLOCK)
        passed += len(piece)
        if not piece or piece.endswith(b"\n"):
            return passed


@dataclass
class ByteRange(InputPartition):
    path: str
    file_id: str
    start: int
    end: int


# Between a checksum and the inode of one of several files that have it.
TWIN = "/"


class LineTailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        # Spark hands option names over in lower case.
        self.include = [g for g in options.get("path", "").split(",") if g]
        self.exclude = [g for g in options.get("exclude", "").split(",") if g]
        self.read_from = options.get("readfrom", "beginning")
        self.identity = options.get("identity", "checksum")
        self.header = int(options.get("headerbytes", "0"))
        self.max_line = int(options.get("maxlinebytes", str(1 << 20)))
        self.split = int(options.get("splitbytes", str(64 << 20)))
        self.wrap = options.get("decode", "ndjson") == "line"
        if self.read_from not in ("beginning", "end"):
            raise ValueError("readFrom is 'beginning' or 'end'")
        if self.identity not in ("checksum", "inode"):
            raise ValueError("identity is 'checksum' or 'inode'")

    def _ends(self) -> dict:
        found = []
        for path in sorted({p for g in self.include for p in glob.glob(g)}):
            if any(fnmatch.fnmatch(path, g) for g in self.exclude) or not os.path.isfile(path):
                continue
            state = os.stat(path)
            node = f"{state.st_dev:x}-{state.st_ino:x}"
            key = node if self.identity == "inode" else fingerprint(path, self.header)
            if key is not None:
                found.append((path, key, node, state.st_size))
        nodes: dict[str, set[str]] = {}
        for _, key, node, _ in found:
            nodes.setdefault(key, set()).add(node)
        ends = {}
        for path, key, node, size in found:
            # files that begin alike are told apart by inode
            key = key if len(nodes[key]) == 1 else f"{key}{TWIN}{node}"
            end = last_break(path, size)
            ends.setdefault(key, {"path": path, "end": end, "marks": block_marks(path, end)})
        return ends

    def initialOffset(self) -> dict:
        return {"files": self._ends() if self.read_from == "end" else {}}

    def latestOffset(self) -> dict:
        return {"files": self._ends()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # a file that twins have joined or left has another key, and the same first line
        before: dict[str, list[dict]] = {}
        for key, file in start.get("files", {}).items():
            before.setdefault(key.split(TWIN)[0], []).append(file)
        ranges: list[InputPartition] = []
        for key, file in sorted(end.get("files", {}).items()):
            known = before.get(key.split(TWIN)[0], [])
            # truncated, or another file: a new generation starts over
            at = max([e["end"] for e in known if e["end"] <= file["end"] and goes_on(file["path"], e)], default=0)
            while at < file["end"]:
                to = min(at + self.split, file["end"])
                ranges.append(ByteRange(file["path"], key, at, to))
                at = to
        # An empty plan is not allowed; a range without bytes reads nothing.
        return ranges or [ByteRange("", "", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[tuple]:
        where = (partition.path, partition.file_id, partition.start, partition.end)
        return range_lines(*where, self.max_line, self.wrap)

    def commit(self, end: dict) -> None:
        pass


class LineTail(DataSource):
    """`spark.readStream.format("line_tail").option("path", globs)`.

    Options: exclude, readFrom (beginning, end), identity (checksum, inode), headerBytes,
    maxLineBytes, splitBytes, decode (ndjson, line). A line over the bound has no payload
    and its size in `refused_bytes`.
    """

    @classmethod
    def name(cls) -> str:
        return "line_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineTailReader:
        return LineTailReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LineTail)
