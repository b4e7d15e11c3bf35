"""Daily logs as a stream while they are written: the open file of the day and the rolled ones.

A folder holds ``app.log``, which grows, and ``app.<day>.log``, the files it was renamed to at
the end of each day. Offsets are byte positions, so a batch reads what was added since the last
one, in byte ranges, whole lines only; a line that is not finished waits for its end. The open
file is known by its first line: when it has been rolled meanwhile, also between the planning
of a batch and its reading or before a restart, its bytes are found under the new name.

The rows are ``value, day, file, position``, where ``position`` is the byte at which the line
begins: (``day``, ``file``, ``position``) follows the lines of a file from top to bottom. The day
of the open file is the day of its last change.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The name of the open file and the names of rolled ones.
OPEN_FILE = "app.log"
ROLLED_FILE = re.compile(r"app\.(\d{4}-\d{2}-\d{2})\.log")

GROWING_ORDER = ("day", "file", "position")
SPLIT_BYTES = 64 << 20
READ_BYTES = 4 << 20


@dataclass
class LineRange(InputPartition):
    """Lines that begin in ``[start, end)`` of the finished part ``[first, last)`` of a file."""

    folder: str
    name: str
    head: int | None
    day: str
    first: int
    last: int
    start: int
    end: int


class Folders:
    """The log folders below a path, on any file system that Arrow can open."""

    def __init__(self, path: str) -> None:
        self.fs, self.root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)

    def files(self) -> dict[str, dict[str, pafs.FileInfo]]:
        """Log files by folder and name."""
        found: dict[str, dict[str, pafs.FileInfo]] = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.root, allow_not_found=True, recursive=True)):
            folder, _, name = info.path.rpartition("/")
            if info.type == pafs.FileType.File and (name == OPEN_FILE or ROLLED_FILE.fullmatch(name)):
                found.setdefault(folder, {})[name] = info
        return found

    def finished(self, path: str, size: int) -> int:
        """Where the last finished line before ``size`` ends."""
        with self.fs.open_input_file(path) as file:
            end = size
            while end > 0:
                start = max(0, end - READ_BYTES)
                file.seek(start)
                at = file.read(end - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def head(self, path: str) -> int | None:
        """A number for the first line of a file; None while it has none."""
        line = b""
        with self.fs.open_input_file(path) as file:
            while chunk := file.read(4096):
                before, found, _ = chunk.partition(b"\n")
                line += before
                if found:
                    return zlib.crc32(line)
        return None

    def named(self, part: LineRange) -> str:
        """The file that a range belongs to, under the name it has now."""
        path = f"{part.folder}/{part.name}"
        if part.head is None or (self.fs.get_file_info(path).type == pafs.FileType.File and self.head(path) == part.head):
            return path
        for name in sorted(self.files().get(part.folder, {})):
            if name != OPEN_FILE and name >= f"app.{part.day}" and self.head(f"{part.folder}/{name}") == part.head:
                return f"{part.folder}/{name}"
        raise FileNotFoundError(f"no file in {part.folder} begins like the {part.name} that was planned")

    def lines(self, part: LineRange) -> Iterator[tuple[list[bytes], list[int]]]:
        """Lines and their positions, some megabytes at a time."""
        with self.fs.open_input_file(self.named(part)) as file:
            at = part.start
            if at > part.first:
                # A line belongs to the range in which it begins.
                file.seek(at - 1)
                while at - 1 < part.last:
                    chunk = file.read(min(READ_BYTES, part.last - at + 1))
                    found = chunk.find(b"\n")
                    if found >= 0:
                        at += found
                        break
                    at += len(chunk)
                else:
                    return
            file.seek(at)
            rest, begin = b"", at
            while begin < part.end:
                chunk = file.read(min(READ_BYTES, part.last - begin - len(rest)))
                pieces = (rest + chunk).split(b"\n")
                rest = pieces.pop()
                if not chunk and rest:
                    pieces, rest = [rest], b""  # the end of a rolled file without a line break
                elif not chunk:
                    return
                values, positions = [], []
                for piece in pieces:
                    if begin >= part.end:
                        break
                    values.append(piece.removesuffix(b"\r"))
                    positions.append(begin)
                    begin += len(piece) + 1
                yield values, positions


class GrowingLogs(DataSource):
    """``spark.readStream.format("growing_logs").load(folder)``; option ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "growing_logs"

    def schema(self) -> str:
        return "value string, day date, file string, position bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingLogsReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


class GrowingLogsReader(DataSourceStreamReader):
    """Offsets: per folder the finished bytes of the open file, its first line and day, and the rolled files."""

    def __init__(self, path: str, split_bytes: int) -> None:
        self.path, self.split_bytes = path, split_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        folders = Folders(self.path)
        names = None
        while True:  # a file that is renamed while they are listed could be missed
            files = folders.files()
            again = {folder: sorted(found) for folder, found in files.items()}
            if again == names:
                break
            names = again
        offset = {}
        for folder, found in files.items():
            entry = {"open": 0, "rolled": {name: info.size for name, info in found.items() if name != OPEN_FILE}}
            if OPEN_FILE in found:
                info = found[OPEN_FILE]
                end = folders.finished(info.path, info.size)
                if end:
                    entry |= {"open": end, "head": folders.head(info.path), "day": info.mtime.date().isoformat()}
            offset[folder] = entry
        return offset

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        folders, parts = Folders(self.path), []
        for folder, now in sorted(end.items()):
            before = start.get(folder, {"open": 0, "rolled": {}})
            taken, head = before["open"], before.get("head")
            for name, size in sorted(now["rolled"].items()):
                if name in before["rolled"]:
                    continue
                first = 0
                if taken and folders.head(f"{folder}/{name}") == head:
                    first, taken = taken, 0  # this was the open file
                day = ROLLED_FILE.fullmatch(name)[1]
                parts += self.ranges(folder, name, None, day, first, size)
            if now["open"]:
                parts += self.ranges(folder, OPEN_FILE, now["head"], now["day"], taken, now["open"])
        return parts

    def ranges(self, folder: str, name: str, head: int | None, day: str, first: int, last: int) -> list[LineRange]:
        edges = [*range(first, last, self.split_bytes), last]
        return [LineRange(folder, name, head, day, first, last, a, b) for a, b in zip(edges, edges[1:])]

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        fields = [("value", pa.string()), ("day", pa.date32()), ("file", pa.string()), ("position", pa.int64())]
        day, file = date.fromisoformat(partition.day), f"{partition.folder}/{partition.name}"
        for values, positions in Folders(self.path).lines(partition):
            texts = [value.decode("utf-8", "replace") for value in values]
            columns = [texts, [day] * len(texts), [file] * len(texts), positions]
            arrays = [pa.array(column, kind) for column, (_, kind) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    def commit(self, end: dict) -> None:
        pass


def stream_growing_logs(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of the open and the rolled files below ``folder`` with the columns of ``GROWING_ORDER``.

    The folder must be one that Arrow can open on every machine: shared, or an object store.
    """
    spark.dataSource.register(GrowingLogs)
    return spark.readStream.format("growing_logs").option("splitBytes", split_bytes).load(folder)
