"""A streaming source of lines from files that grow, are rotated or are cut back, by byte offsets.

``spark.readStream.format("growing_lines")`` follows all files of a folder that match a pattern. An offset names every file by
what stays the same when it grows or is renamed (its number in the file system, where there is one, and its first line) and
says up to which byte it was read, always just behind a line end. A batch is the byte ranges between two offsets, dealt
out in pieces; each piece reads the lines that start in it. So a batch can be repeated, a line is in exactly one batch, and a
file that is rotated away between two triggers is read to its end under its new name.
"""

from __future__ import annotations

import fnmatch
import hashlib
import os
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

HEAD = 4096
BLOCK = 1 << 22
SPLIT = 64 << 20
SETTLED_SECONDS = 60.0


def _file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


@dataclass(frozen=True)
class Found:
    """A file as listed: its name, length, age in seconds, and what names it for good (None before its first line ends)."""

    path: str
    size: int
    age: float
    identity: str | None


class Folder:
    """The files of a folder that match a pattern."""

    def __init__(self, path: str, pattern: str):
        self.files, self.path = _file_system(path)
        self.pattern = pattern

    def identity(self, path: str, size: int) -> str | None:
        with self.files.open_input_file(path) as file:
            head = file.read_at(min(HEAD, size), 0)
        end = head.find(b"\n")
        if end < 0 and len(head) < HEAD:
            return None
        first = hashlib.sha1(head if end < 0 else head[:end + 1]).hexdigest()
        where = f"{os.stat(path).st_dev}:{os.stat(path).st_ino}" if self.files.type_name == "local" else path
        return f"{where}:{first}"

    def listed(self) -> list[Found]:
        from pyarrow import fs

        out = []
        for info in self.files.get_file_info(fs.FileSelector(self.path, allow_not_found=True)):
            if info.type != fs.FileType.File or not info.size or not fnmatch.fnmatch(info.base_name, self.pattern):
                continue
            age = time.time() - info.mtime_ns / 1e9 if info.mtime_ns else 0.0
            try:
                out.append(Found(info.path, info.size, age, self.identity(info.path, info.size)))
            except FileNotFoundError:  # renamed since it was listed: it is found under its new name next time
                continue
        return sorted(out, key=lambda f: f.path)

    def line_end(self, path: str, size: int) -> int:
        """The place behind the last line end in the first ``size`` bytes; 0 if there is none."""
        with self.files.open_input_file(path) as file:
            at = size
            while at > 0:
                start = max(0, at - (1 << 16))
                found = file.read_at(at - start, start).rfind(b"\n")
                if found >= 0:
                    return start + found + 1
                at = start
        return 0

    def locate(self, path: str, identity: str) -> str:
        """Where the file of this identity is now: at ``path``, or where a rotation put it."""
        try:
            size = self.files.get_file_info(path).size or 0
            if size and self.identity(path, size) == identity:
                return path
        except FileNotFoundError:
            pass
        for found in self.listed():
            if found.identity == identity:
                return found.path
        raise FileNotFoundError(f"{path} is gone before all its lines were read, and no file of its folder is its continuation")


@dataclass
class Piece(InputPartition):
    """Lines that start in [start, end) of a file. ``first``: the piece starts at a line, else behind the next line end.

    Nothing at or behind ``limit``, the end of the whole range, is read.
    """

    path: str
    identity: str
    start: int
    end: int
    limit: int
    first: bool

    def __init__(self, path: str, identity: str, start: int, end: int, limit: int, first: bool):
        self.path, self.identity, self.start, self.end, self.limit, self.first = path, identity, start, end, limit, first


def lines_of(file, piece: Piece) -> Iterator[list[bytes]]:
    """Blocks of whole lines of a piece, without their line ends."""
    at = piece.start
    rest = b""
    if not piece.first:  # the line over the cut belongs to the piece before, also one that ends just at the cut
        at -= 1
        while True:
            block = file.read_at(min(BLOCK, piece.limit - at), at)
            found = block.find(b"\n")
            if found >= 0 or not block:
                at += found + 1 if block else 0
                break
            at += len(block)
        if at >= piece.end:
            return
    begun = at  # where the line at the front of ``rest`` starts
    while at < piece.limit:
        block = file.read_at(min(BLOCK, piece.limit - at), at)
        if not block:
            raise EOFError(f"{piece.path} ends at byte {at}, before byte {piece.limit} that was to be read")
        at += len(block)
        *whole, rest = (rest + block).split(b"\n")
        taken = []
        for line in whole:
            if begun >= piece.end:
                break
            taken.append(line)
            begun += len(line) + 1
        if taken:
            yield taken
        if begun >= piece.end:
            return
    if rest:
        yield [rest]


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options
        self.settled = float(options.get("settledseconds", SETTLED_SECONDS))
        self.split = int(options.get("splitbytes", SPLIT))

    def folder(self) -> Folder:
        return Folder(self.options["path"], self.options.get("pattern", "*"))

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        folder, files = self.folder(), {}
        for found in folder.listed():
            if found.identity is None and found.age < self.settled:
                continue
            end = found.size if found.age >= self.settled else folder.line_end(found.path, found.size)
            if end:
                files[found.identity or f"settled:{found.path}:{found.size}"] = [found.path, end]
        return {"files": files}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        pieces = []
        for identity, (path, stop) in sorted(end["files"].items(), key=lambda f: f[1]):
            begin = start["files"].get(identity, [path, 0])[1]
            if stop < begin:  # cut back and written anew with the same first line
                begin = 0
            for at in range(begin, stop, self.split):
                pieces.append(Piece(path, identity, at, min(at + self.split, stop), stop, at == begin))
        return pieces

    def read(self, partition: Piece):
        import pyarrow as pa

        folder = self.folder()
        path = partition.path if partition.identity.startswith("settled:") else folder.locate(partition.path, partition.identity)
        with folder.files.open_input_file(path) as file:
            for block in lines_of(file, partition):
                text = pa.array([line.decode("utf-8", "replace") for line in block], pa.string())
                yield pa.RecordBatch.from_arrays([text], names=["value"])

    def commit(self, end: dict) -> None:
        pass


class GrowingLines(DataSource):
    """Options: ``path`` (a folder), ``pattern`` of file names, ``settledSeconds`` (after so long without a change a last line
    without a line end is taken as whole), ``splitBytes`` (of a file for one task).

    A half-written last line waits. A file that is cut back and starts with another line is a new file; so is, from byte 0 on,
    one that is shorter than what was read of it. A file that is deleted before its lines are read stops the stream with an
    error. Bytes that are no UTF-8 become replacement characters. Offsets name every file of the folder, so rotated files
    should be moved away once they are old: hundreds of them are no burden, for folders of very many whole files there
    is the built-in text source.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader({k.lower(): v for k, v in self.options.items()})


def follow(spark: SparkSession, path: str, pattern: str | None = None, **options):
    """A stream of the lines of a growing file and of those it is rotated to, or of all files of a folder by ``pattern``.

    For a single file the pattern is its stem, anything, and its suffix: ``events.jsonl`` and ``events-2024-01-01.jsonl``.
    """
    if pattern is None:
        path, name = os.path.split(path)
        stem, suffix = os.path.splitext(name)
        pattern = f"{stem}*{suffix}"
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").options(path=path, pattern=pattern, **options).load()
