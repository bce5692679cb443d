"""Text files of any size, read in byte ranges.

A row of Spark's whole-text reader holds a file, which must be smaller than 2 GB. Here files are cut
into ranges of bytes, each of which is read by a task of its own, a block at a time: a line belongs
to the range in which it begins. Lines have their place in the file, so their order is known; parts
are runs of lines, to be put in order by file and part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from textsignal.functions.text import name_from_path

#: Bytes of a task, of a part, of a block that is read at once, and rows sent at once.
RANGE_BYTES = 128 << 20
PART_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20

LINES = "file_name string, offset long, line string"
PARTS = "file_name string, part int, text string"


class ByteRange(InputPartition):
    def __init__(self, file: str, start: int, end: int) -> None:
        self.file, self.start, self.end = file, start, end


def _opened(path: str):
    """A file system, which all machines must reach, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def ranges(path: str, size: int) -> list[ByteRange]:
    """Ranges of all files below a folder, or of one file; hidden files are left out."""
    from pyarrow import fs

    system, inner = _opened(path)
    found = system.get_file_info(inner)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    files = [found]
    if found.type == fs.FileType.Directory:
        files = system.get_file_info(fs.FileSelector(inner, recursive=True))
    below = len(inner.rstrip("/")) + 1
    out = []
    for f in sorted((f for f in files if f.type == fs.FileType.File), key=lambda f: f.path):
        if not any(name[:1] in "._" for name in f.path[below:].split("/") if name):
            out += [ByteRange(f.path, a, min(f.size, a + size)) for a in range(0, f.size, size)]
    return out


def lines_of(source, start: int, end: int, block: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """Places and bytes of the lines that begin from `start` to `end` - 1, without their ends.

    `source` has seek and read. Only a line and a block are held.
    """
    at = start
    source.seek(max(0, start - 1))
    rest = b""
    if start:  # the line that runs into the range belongs to the one before
        if source.read(1) != b"\n":
            while True:
                got = source.read(block)
                if not got:
                    return
                cut = got.find(b"\n")
                if cut >= 0:
                    at, rest = at + cut + 1, got[cut + 1 :]
                    break
                at += len(got)
    held = [rest]
    while at < end:
        whole = held[-1]
        cut = whole.find(b"\n")
        if cut < 0:
            got = source.read(block)
            if got:
                held.append(got)
                continue
            last = b"".join(held)
            if last:
                yield at, last.removesuffix(b"\r")
            return
        line = b"".join([*held[:-1], whole[:cut]])
        yield at, line.removesuffix(b"\r")
        at += len(line) + 1
        held = [whole[cut + 1 :]]


class LineReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.size = options["path"], int(options.get("rangebytes", RANGE_BYTES))
        self.part = int(options.get("partbytes", 0))
        if self.part:  # a part lies in one range
            self.size = max(1, self.size // self.part) * self.part

    def partitions(self) -> list[ByteRange]:
        return ranges(self.path, self.size) or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        system, _ = _opened(self.path)
        # As Spark writes names of files.
        shown = partition.file if "://" in self.path else "file://" + quote(partition.file)

        def batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
            texts = [line.decode("utf-8", "replace") for _, line in rows]
            places = pa.array([at for at, _ in rows], pa.int32() if self.part else pa.int64())
            named = pa.array([shown] * len(rows), pa.string())
            names = ["file_name", "part", "text"] if self.part else ["file_name", "offset", "line"]
            return pa.RecordBatch.from_arrays([named, places, pa.array(texts, pa.string())], names=names)

        with system.open_input_file(partition.file) as source:
            found = lines_of(source, partition.start, partition.end)
            rows, size = [], 0
            for at, line in _joined(found, self.part) if self.part else found:
                rows.append((at, line))
                size += len(line) + 64
                if size >= BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)


def _joined(lines: Iterator[tuple[int, bytes]], part: int) -> Iterator[tuple[int, bytes]]:
    """Numbers and texts of the parts that the lines begin in."""
    for number, group in groupby(lines, lambda entry: entry[0] // part):
        yield number, b" ".join(line for _, line in group).replace(b"\r", b" ")


class LineSource(DataSource):
    """Format `textsignal_lines`; options `path`, `rangeBytes`, and `partBytes` for parts."""

    @classmethod
    def name(cls) -> str:
        return "textsignal_lines"

    def schema(self) -> str:
        return PARTS if any(k.lower() == "partbytes" for k in self.options) else LINES

    def reader(self, schema) -> LineReader:
        return LineReader({k.lower(): v for k, v in self.options.items()})


def read_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """`[file_name, offset, line]` of all files below a folder; `offset` is a line's first byte.

    Lines end with a line feed, before which a carriage return is left out. Bytes that are no UTF-8
    become replacement characters; an empty file has no lines. A line must fit a row.
    """
    spark.dataSource.register(LineSource)
    options = {"path": path, "rangeBytes": str(range_bytes)}
    return spark.read.format("textsignal_lines").options(**options).load()


def read_parts(
    spark: SparkSession, path: str, part_bytes: int = PART_BYTES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """`[file_name, show, part, text]`: files as parts of about `part_bytes`, in whole lines.

    Lines are joined by spaces in their order, as in `read_documents`. Put parts in order by `file_name` and `part`, as
    `segment_tokens` does with these as its order. No task holds more than a part and a
    line, and nothing is shuffled.
    """
    spark.dataSource.register(LineSource)
    options = {"path": path, "rangeBytes": str(range_bytes), "partBytes": str(part_bytes)}
    parts = spark.read.format("textsignal_lines").options(**options).load()
    return parts.select("file_name", name_from_path(F.col("file_name")).alias("show"), "part", "text")
