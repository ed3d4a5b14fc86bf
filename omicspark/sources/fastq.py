"""A data source of FASTQ files: byte ranges that begin with the first record in them, so no line has to move."""

from __future__ import annotations

import bz2
import gzip
import io
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Files by these endings are read whole, as a range of theirs cannot be found.
PACKED = (".gz", ".bz2", ".zst", ".lz4")
#: What opening a file counts as in bytes, and how much of one is held at a time.
OPEN_COST, BLOCK = 4 << 20, 8 << 20


def opened(uri: str, packed: bool = False):
    """A binary stream of a file in any store that the Arrow file systems reach, unpacked unless it is to stay ``packed``."""
    from pyarrow import fs

    store, path = (fs.LocalFileSystem(), uri.removeprefix("file://")) if uri.startswith("file:") else fs.FileSystem.from_uri(uri)
    if packed:
        return store.open_input_stream(path, compression=None)
    if uri.endswith(".gz"):
        return gzip.GzipFile(fileobj=store.open_input_file(path))  # of several members, as block-wise packed files are
    if uri.endswith(".bz2"):
        return bz2.BZ2File(store.open_input_file(path))
    return store.open_input_stream(path, compression="detect") if uri.endswith(PACKED) else store.open_input_file(path)


def first_record(lines: Sequence[bytes]) -> int | None:
    """Which of the first four lines is a header: it starts with ``@`` and the next but one with ``+``.

    A quality line may start with ``@`` too, but the next but one after it is a sequence, and none starts with ``+``.
    """
    return next((i for i in range(min(4, len(lines) - 2)) if lines[i].startswith(b"@") and lines[i + 2].startswith(b"+")), None)


def records(stream, start: int, end: int | None, block: int = BLOCK) -> Iterator[tuple[list[int], list[bytes]]]:
    """Offsets and lines, four each, of the records that begin in ``[start, end)`` of a stream; the last is read to its end, past ``end`` if need be."""
    at, rest, lines, aligned, more = start, b"", [], start == 0, True
    if start:
        stream.seek(start - 1)
        at = start - 1
    skip = bool(start)
    while more:
        data = stream.read(block)
        more = bool(data)
        found = (rest + data).split(b"\n")
        rest = found.pop() if more else b""
        if not more and found[-1] == b"":
            found.pop()
        lines += found
        if skip and lines:  # what is left of the line before
            at, lines, skip = at + len(lines[0]) + 1, lines[1:], False
        if not aligned and not skip and (len(lines) >= 6 or not more):
            first = first_record(lines)
            if first is None:
                return
            at, lines, aligned = at + sum(len(x) + 1 for x in lines[:first]), lines[first:], True
        if aligned:
            if not more and len(lines) % 4 == 3:  # an empty quality line that no line end follows
                lines.append(b"")
            whole = len(lines) // 4 * 4
            ends = list(accumulate((len(x) + 1 for x in lines[:whole]), initial=at))
            offsets = ends[:-1:4]
            n = len(offsets) if end is None else sum(o < end for o in offsets)
            if n:
                yield offsets[:n], lines[: 4 * n]
            if n < len(offsets) or end is not None and ends[-1] >= end:
                return
            at, lines = ends[-1], lines[whole:]


@dataclass
class Ranges(InputPartition):
    """Byte ranges ``(uri, start, end)`` that one task reads."""

    pieces: list[tuple[str, int, int | None]]


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, self.most = json.loads(options["files"]), int(options["bytes"])

    def partitions(self) -> list[Ranges]:
        """Large plain files in ranges, small ones together in a task, packed ones each in one."""
        out, held, size = [], [], 0
        for uri, length in self.files:
            if uri.endswith(PACKED):
                out.append(Ranges([(uri, 0, None)]))
                continue
            for start in range(0, length, self.most):
                end = min(start + self.most, length)
                if held and size + end - start + OPEN_COST > self.most:
                    out.append(Ranges(held))
                    held, size = [], 0
                held.append((uri, start, end))
                size += end - start + OPEN_COST
        return out + ([Ranges(held)] if held else [])

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for uri, start, end in partition.pieces:
            with opened(uri) as stream:
                for offsets, lines in records(stream, start, end):
                    text = lambda k: pa.array(lines[k::4], pa.binary()).cast(pa.string())  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays([pa.array([uri] * len(offsets)), pa.array(offsets, pa.int64()), text(0), text(1), text(3)], names=["path", "ord", "h", "seq", "qual"])


class Fastq(DataSource):
    """Records of FASTQ files: ``path, ord, h, seq, qual``; ``ord`` is the place of a record in its (unpacked) file."""

    @classmethod
    def name(cls) -> str:
        return "fastq_ranges"

    def schema(self) -> str:
        return "path string, ord bigint, h string, seq string, qual string"

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)
