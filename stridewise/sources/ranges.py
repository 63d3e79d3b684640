"""Files read by byte ranges: XML elements and delimited records that start in a range.

A range is read by one task. It seeks to the first element or record that
starts in it and reads the last one to its end, beyond the range if need be,
so every one is read once, by the range in which it starts. Small files share a task, large ones are split
whatever their content: a single export file is as parallel as many. Only positions travel through the driver.

For delimited text a line break ends a record only outside quotes. Quotes come
in pairs (doubled inside quoted values), so the number of quotes before a range
tells whether it starts inside a quoted value: one pass counts the quotes of each range, their prefix sums give the parity.

Compressed files (``.gz``, ``.bz2``, ``.zst``, ``.lz4`` in the name) are read as a stream, each by one task. XML files of Hadoop's Snappy
blocks (``.snappy``) are read by ranges as plain ones are: a range starts with a block, and one pass over the files finds where blocks start.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from types import MappingProxyType

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# the functions below run in Python workers; shipped by value, executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The largest range, and the least size to which ranges of little data are cut so that all cores work.
RANGE_BYTES, LEAST_RANGE = 64 << 20, 4 << 20
BLOCK_BYTES = 4 << 20
#: Tasks a core beyond which ranges smaller than ``RANGE_BYTES`` share one.
TASKS_A_CORE = 16
#: Bytes read beyond a range at first, for the end of what starts last in it.
BEYOND = 1 << 16
#: Endings of compressed files, what a compressed byte counts for when files are dealt to tasks, and the end of a file of unknown length.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
COMPRESSED_WEIGHT = 8
NO_END = 1 << 62
#: Ending of files of compressed blocks, in which positions are those of the plain text.
BLOCKED = ".snappy"
#: Rows and bytes in a batch given back to Spark.
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20

RECORD_SCHEMA = "file string, start long, record string"


@dataclass(frozen=True)
class FileRange:
    file: str
    size: int
    start: int
    stop: int
    quoted: bool = False  # the range starts inside a quoted value
    offset: int = -1  # of a file of blocks: the byte at which the block stands that starts the range

    @property
    def weight(self) -> int:
        return (self.stop if self.stop < NO_END else self.size * COMPRESSED_WEIGHT) - self.start


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files matching a glob, through the Hadoop file system (any scheme), sorted."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted((str(s.getPath().toString()), s.getLen()) for s in found or [] if s.isFile())


def plain_bytes(files: Sequence[tuple[str, int]]) -> int:
    """Bytes of the files, those of compressed ones as they may be read."""
    return sum(size * (COMPRESSED_WEIGHT if f.endswith(COMPRESSED) else 1) for f, size in files)


def range_size(spark: SparkSession, files: Sequence[tuple[str, int]], range_bytes: int) -> int:
    """``range_bytes``, or less where the files would not give every core a range."""
    share = plain_bytes(files) // max(spark.sparkContext.defaultParallelism, 1) + 1
    return min(range_bytes, max(share, LEAST_RANGE))


def task_size(spark: SparkSession, files: Sequence[tuple[str, int]], size: int) -> int:
    """Bytes a task: that of a range, or more where small ranges would make more than ``TASKS_A_CORE`` tasks a core."""
    return max(size, min(RANGE_BYTES, plain_bytes(files) // (TASKS_A_CORE * max(spark.sparkContext.defaultParallelism, 1))))


def split_files(files: Sequence[tuple[str, int]], range_bytes: int = RANGE_BYTES, blocks: Mapping[str, np.ndarray] = MappingProxyType({})) -> list[FileRange]:
    """Ranges of the files; those with ``blocks`` (:func:`block_starts`) are cut where a block starts, their sizes are those of the plain text."""
    out = []
    for f, size in files:
        if f in blocks:
            plain, stored = blocks[f]
            first = np.unique(np.searchsorted(plain, np.arange(0, size, range_bytes)))
            first = first[first < len(plain)]
            stops = [*plain[first[1:]].tolist(), size]
            out += [FileRange(f, size, int(plain[i]), stop, offset=int(stored[i])) for i, stop in zip(first.tolist(), stops, strict=True)] if size else []
        elif f.endswith(COMPRESSED):
            out += [FileRange(f, size, 0, NO_END)] if size else []
        else:
            out += [FileRange(f, size, at, min(at + range_bytes, size)) for at in range(0, size, range_bytes)]
    return out


def pack_ranges(ranges: Sequence[FileRange], task_bytes: int = RANGE_BYTES) -> list[list[FileRange]]:
    """Neighbouring ranges of ``task_bytes`` together, one list a task."""
    tasks, room = [], 0
    for r in ranges:
        if r.weight > room:
            tasks.append([])
            room = task_bytes
        tasks[-1].append(r)
        room -= r.weight
    return tasks


class _Blocks:
    """A file of Hadoop's Snappy blocks, read on from the start of a block.

    A block is the length of its text (four bytes, highest first), then pieces until it is complete: length and Snappy data, which tells the length of its text.
    """

    def __init__(self, file, at: int, step: int) -> None:
        self.file, self.next, self.step, self.raw, self.at, self.size = file, at, max(step, 1 << 16), b"", 0, file.size()

    @property
    def position(self) -> int:
        return self.next - len(self.raw) + self.at

    def take(self, n: int) -> bytes:
        while len(self.raw) - self.at < n:
            got = self.file.read_at(min(self.step, self.size - self.next), self.next) if self.next < self.size else b""
            if not got:
                raise ValueError(f"a block ends after {self.size} bytes of the file")
            self.raw, self.at, self.next = self.raw[self.at :] + got, 0, self.next + len(got)
        self.at += n
        return self.raw[self.at - n : self.at]

    def pieces(self) -> Iterator[tuple[bytes, int]]:
        """The pieces of the next block with the length of their text; none at the end of the file."""
        left = 0
        while not left and self.position < self.size:
            left = int.from_bytes(self.take(4), "big")
        while left:
            data = self.take(int.from_bytes(self.take(4), "big"))
            text = shift = 0
            for byte in data[:5]:
                text |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    break
            yield data, text
            left -= text

    def read(self) -> bytes:
        """The text of the next block; empty at the end of the file."""
        return b"".join(pa.Codec("snappy").decompress(data, text, asbytes=True) for data, text in self.pieces())


class _Bytes:
    """A file read in blocks from a position on, with what has been read and not dropped yet."""

    def __init__(self, r: FileRange, position: int, block: int) -> None:
        if ":" in r.file.split("/")[0]:
            fs, path = pafs.FileSystem.from_uri(r.file if not r.file.startswith("file:/") else "file://" + r.file[5:].replace("//", "", 1))
        else:
            fs, path = pafs.LocalFileSystem(), r.file
        self.stream = fs.open_input_stream(path) if path.endswith(COMPRESSED) else None
        self.file = None if self.stream else fs.open_input_file(path)
        self.blocks = _Blocks(self.file, r.offset, block // 4) if r.offset >= 0 else None
        self.size, self.block, self.base, self.buffer = r.size, block, position, b""
        self.needed = position

    def done(self, position: int) -> None:
        """What stands before ``position`` may go when the next block is read."""
        self.needed = max(self.needed, position)

    def more(self) -> bool:
        """Reads a block on; false at the end of the file."""
        if self.needed > self.base:
            self.drop(self.needed)
        at = self.base + len(self.buffer)
        if self.stream:
            got = self.stream.read(self.block)
        elif self.blocks:
            got = self.blocks.read()
        else:
            got = self.file.read_at(min(self.block, self.size - at), at) if at < self.size else b""
        self.buffer += got
        return bool(got)

    def drop(self, position: int) -> None:
        self.buffer = self.buffer[position - self.base :]
        self.base = position

    def search(self, pattern: re.Pattern, position: int, limit: int | None = None, longest: int = 64):
        """First match at ``position`` or later (and before ``limit``) as ``(begin, end, text)``; None if there is none.

        What was searched without a match is dropped, but for the ``longest`` bytes in which one may begin, if ``limit`` is given.
        """
        while True:
            found = pattern.search(self.buffer, position - self.base)
            # a match at the end of what is read might grow or be another one
            if found:
                begin, end = self.base + found.start(), self.base + found.end()  # reading on moves the base
                if found.end() < len(self.buffer) or not self.more():
                    return None if limit is not None and begin >= limit else (begin, end, found.group())
                continue
            position = max(position, self.base + len(self.buffer) - longest)
            if limit is not None:
                if position >= limit:
                    return None
                self.drop(position)
            if not self.more():
                return None


def _block(r: FileRange, block: int) -> int:
    """Blocks no longer than the range asks for."""
    return min(block, r.stop - r.start + BEYOND)


def xml_elements(r: FileRange, tag: str, block: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """``(position, bytes)`` of the outermost ``<tag>`` elements that start in a range; comments and CDATA sections are passed over.

    Across the start of a range a comment is not recognised as one, nor an element as the inner of one of its own name.
    """
    name = re.escape(tag.encode())
    opening = re.compile(rb"<!--|<!\[CDATA\[|<" + name + rb"(?=[\s/>])")
    inside = re.compile(rb"<!--|<!\[CDATA\[|<" + name + rb"(?=[\s/>])|</" + name + rb"\s*>")
    tag_end = re.compile(rb"(?:[^\"'>]|\"[^\"]*\"|'[^']*')*?(/?>)")
    closers = {b"<!--": re.compile(rb"-->"), b"<![CDATA[": re.compile(rb"\]\]>")}
    data, position = _Bytes(r, r.start, _block(r, block)), r.start

    def start_tag(begin: int) -> tuple[int, bool]:
        """End of a start tag and whether it closes itself; ``>`` inside quoted values does not end it."""
        while True:
            found = tag_end.match(data.buffer, begin - data.base)
            if found:
                return data.base + found.end(), found.group(1) == b"/>"
            if not data.more():
                raise ValueError(f"{r.file}: a start tag at {begin} does not end")

    while True:
        found = data.search(opening, position, r.stop)
        if found is None:
            return
        begin, position, what = found
        if what in closers:
            end = data.search(closers[what], position)
            if end is None:
                return
            position = end[1]
            continue
        data.done(begin)
        position, closed = start_tag(position)
        depth = 0 if closed else 1
        while depth:
            found = data.search(inside, position)
            if found is None:
                raise ValueError(f"{r.file}: the element at {begin} does not end")
            _, position, what = found
            if what in closers:
                end = data.search(closers[what], position)
                if end is None:
                    raise ValueError(f"{r.file}: the element at {begin} does not end")
                position = end[1]
            elif what.startswith(b"</"):
                depth -= 1
            else:
                position, closed = start_tag(position)
                depth += not closed
        yield begin, data.buffer[begin - data.base : position - data.base]
        data.done(position)


def _lines(r: FileRange, position: int, block: int) -> Iterator[tuple[int, bytes]]:
    """``(position, line with its end)`` from a position to the end of the file."""
    data = _Bytes(r, position, _block(r, block))
    while True:
        end = data.buffer.rfind(b"\n") + 1
        if not end and data.more():
            continue
        at = data.base
        for line in (data.buffer[:end] if end else data.buffer).splitlines(keepends=True) if b"\r" not in data.buffer else _split(data.buffer[:end] if end else data.buffer):
            yield at, line
            at += len(line)
        data.drop(at)
        if not data.buffer and not data.more() or not end:
            return


def _split(text: bytes) -> list[bytes]:
    parts = [p + b"\n" for p in text.split(b"\n")]
    parts[-1] = parts[-1][:-1]
    return parts if parts[-1] else parts[:-1]


def text_records(r: FileRange, quote: bytes, block: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """``(position, bytes)`` of the records that start in a range; without ``quote`` every line is one."""
    skip = r.start > 0
    odd = r.quoted
    begin, parts = 0, []
    for at, line in _lines(r, max(r.start - 1, 0), block):
        if skip:
            # from the byte before the range on: its line break, outside quotes, would start a record at the range
            body = line[1:] if at < r.start else line
            odd ^= bool(quote) and body.count(quote) % 2 == 1
            skip = odd or not line.endswith(b"\n")
            continue
        if not parts:
            if at >= r.stop:
                return
            begin = at
        parts.append(line)
        odd ^= bool(quote) and line.count(quote) % 2 == 1
        if not odd:
            yield begin, b"".join(parts).rstrip(b"\r\n") if len(parts) == 1 else b"".join(parts).removesuffix(b"\n").removesuffix(b"\r")
            parts = []
    if parts:
        yield begin, b"".join(parts)


def _per_task(spark: SparkSession, tasks: list[list[FileRange]], rows, schema: str) -> DataFrame:
    """One task a list of ranges; ``rows(range)`` yields its batches.

    Every task is sent the places of all ranges, so they travel as packed numbers, some 21 bytes a range (29 in files of blocks); only its own become objects.
    """
    files = {r.file: r.size for t in tasks for r in t}
    names, sizes, number = list(files), list(files.values()), {f: i for i, f in enumerate(files)}
    first = np.cumsum([0, *map(len, tasks)])
    file = np.array([number[r.file] for t in tasks for r in t], dtype=np.int32)
    start = np.array([r.start for t in tasks for r in t], dtype=np.int64)
    stop = np.array([r.stop for t in tasks for r in t], dtype=np.int64)
    quoted = np.array([r.quoted for t in tasks for r in t], dtype=bool)
    offset = np.array([r.offset for t in tasks for r in t], dtype=np.int64)
    offset = offset if (offset >= 0).any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                for j in range(first[i], first[i + 1]):
                    yield from rows(FileRange(names[file[j]], sizes[file[j]], int(start[j]), int(stop[j]), bool(quoted[j]), -1 if offset is None else int(offset[j])))

    return spark.range(0, len(tasks), 1, max(len(tasks), 1)).mapInArrow(run, schema)


def _record_rows(records, encoding: str):
    def rows(r: FileRange) -> Iterator[pa.RecordBatch]:
        starts, texts, held = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.file] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(texts, pa.string())],
                                              names=["file", "start", "record"])

        for start, text in records(r):
            starts.append(start)
            texts.append(text.decode(encoding, "replace"))
            held += len(text)
            if len(starts) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield batch()
                starts, texts, held = [], [], 0
        if starts:
            yield batch()

    return rows


def block_starts(spark: SparkSession, files: Sequence[tuple[str, int]]) -> dict[str, np.ndarray]:
    """For each file of blocks two rows: the positions in the plain text at which blocks start, the last being its length, and those in the file.

    One pass over the compressed bytes, a task some ``RANGE_BYTES`` of files; 16 bytes a block come back.
    """
    def walk(r: FileRange) -> Iterator[pa.RecordBatch]:
        blocks, plain, stored = _Blocks(_Bytes(r, 0, BLOCK_BYTES).file, 0, BLOCK_BYTES), [0], [0]
        while length := sum(text for _, text in blocks.pieces()):
            plain.append(plain[-1] + length)
            stored.append(blocks.position)
        yield pa.RecordBatch.from_arrays([pa.array([r.file]), pa.array([np.array([plain, stored], dtype="<i8").tobytes()], pa.binary())], names=["file", "starts"])

    tasks = pack_ranges([FileRange(f, size, 0, size) for f, size in files if size])
    found = _per_task(spark, tasks, walk, "file string, starts binary").collect() if tasks else []
    return {r["file"]: np.frombuffer(r["starts"], dtype="<i8").reshape(2, -1) for r in found}


def read_xml_elements(spark: SparkSession, files: Sequence[tuple[str, int]], tag: str, range_bytes: int = RANGE_BYTES, encoding: str = "utf-8") -> DataFrame:
    """``(file, start, record)``: the text of every outermost ``<tag>`` element of the files (an encoding that holds ASCII as it is)."""
    starts = block_starts(spark, [x for x in files if x[0].endswith(BLOCKED)])
    files = [(f, int(starts[f][0, -1]) if f in starts else size) for f, size in files]
    size = range_size(spark, files, range_bytes)
    ranges = split_files(files, size, {f: x[:, :-1] for f, x in starts.items()})
    tasks = pack_ranges(ranges, task_size(spark, files, size))
    return _per_task(spark, tasks, _record_rows(lambda r: xml_elements(r, tag), encoding), RECORD_SCHEMA)


def quoted_starts(spark: SparkSession, ranges: Sequence[FileRange], quote: bytes, task_bytes: int = RANGE_BYTES) -> list[FileRange]:
    """The ranges with ``quoted`` set; the quotes of files of more than one range are counted in tasks, a number a range comes back."""
    parted = [r for r in ranges if r.stop < r.size]  # what comes last in its file decides nothing
    if not parted or not quote:
        return list(ranges)

    def count(r: FileRange) -> Iterator[pa.RecordBatch]:
        file, quotes = _Bytes(r, r.start, BLOCK_BYTES).file, 0
        for at in range(r.start, r.stop, BLOCK_BYTES):
            quotes += file.read_at(min(BLOCK_BYTES, r.stop - at), at).count(quote)
        yield pa.RecordBatch.from_arrays([pa.array([r.file]), pa.array([r.start], pa.int64()), pa.array([quotes], pa.int64())], names=["file", "start", "quotes"])

    counted = _per_task(spark, pack_ranges(parted, task_bytes), count, "file string, start long, quotes long").collect()
    quotes = {(c["file"], c["start"]): c["quotes"] for c in counted}
    out, odd, file = [], False, None
    for r in ranges:
        odd = odd if r.file == file else False
        out.append(FileRange(r.file, r.size, r.start, r.stop, odd))
        odd, file = odd ^ (quotes.get((r.file, r.start), 0) % 2 == 1), r.file
    return out


def read_text_records(spark: SparkSession, files: Sequence[tuple[str, int]], quote: str = '"', range_bytes: int = RANGE_BYTES, encoding: str = "utf-8") -> DataFrame:
    """``(file, start, record)``: every record of the files without its line end; quoted line breaks stay inside (no ``quote``: lines)."""
    mark = quote.encode(encoding) if quote else b""
    size = range_size(spark, files, range_bytes)
    tasks = task_size(spark, files, size)
    ranges = quoted_starts(spark, split_files(files, size), mark, tasks)
    return _per_task(spark, pack_ranges(ranges, tasks), _record_rows(lambda r: text_records(r, mark), encoding), RECORD_SCHEMA)


def first_records(spark: SparkSession, files: Sequence[tuple[str, int]], quote: str = '"', encoding: str = "utf-8", files_a_task: int = 64) -> dict[str, str]:
    """The first record of each file (header lines), read from the starts of the files only; an empty file has an empty one."""
    mark = quote.encode(encoding) if quote else b""
    ranges = [FileRange(f, size, 0, 1) for f, size in files]
    tasks = [ranges[i : i + files_a_task] for i in range(0, len(ranges), files_a_task)]
    found = _per_task(spark, tasks, _record_rows(lambda r: text_records(r, mark, 1 << 16), encoding), RECORD_SCHEMA).collect()
    by_file = {r["file"]: r["record"] for r in found}
    return {f: by_file.get(f, "") for f, _ in files}
