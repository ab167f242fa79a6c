"""Block-compressed text (``bgzip``) read by many tasks, and region pruning.

Such a file is a chain of gzip members of at most 64 KiB, each of which states
its own size in its header. A file is dealt to tasks as ranges of compressed
bytes ("slabs"). A task looks for the first block that starts in its slab, reads
blocks from there, and reads on beyond its slab until its last line is whole; a
line belongs to the slab that holds the line feed before it. So every line is
read once, whatever crosses the borders, and no task needs another's result.

Files of other kinds (plain text, a single gzip member) are left to Spark's own
text reader, which takes a gzip file in one task.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Compressed bytes of a slab: some 20 to 40 MB of text.
SLAB_BYTES = 4 * 1024 * 1024
#: Largest size of a block (fixed value of the format) and lines of a batch.
_LARGEST_BLOCK, _BATCH_BYTES = 65536, 8_000_000
_START = re.compile(rb"\x1f\x8b\x08\x04")

LINES = "path string, slab long, value string"


def _open(uri: str):
    """A seekable file of a URI (``file:``, ``hdfs:``, ``s3:``, ``gs:``)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def block_size(data: bytes, at: int) -> int:
    """Size of the block whose header starts at ``at``; 0 if none does."""
    if data[at : at + 4] != b"\x1f\x8b\x08\x04" or len(data) < at + 12:
        return 0
    end = at + 12 + struct.unpack_from("<H", data, at + 10)[0]
    place = at + 12
    while place + 6 <= min(end, len(data)):
        name, size = data[place : place + 2], struct.unpack_from("<H", data, place + 2)[0]
        if name == b"BC" and size == 2:
            return struct.unpack_from("<H", data, place + 4)[0] + 1
        place += 4 + size
    return 0


class _Blocks:
    """Blocks of a file from the first one that starts at ``start`` or later."""

    def __init__(self, source, length: int, start: int):
        self.source, self.length, self.base, self.data = source, length, start, b""
        self.at = self._first(start)

    def _need(self, place: int, size: int) -> int:
        """Index of file offset ``place`` in ``data``, with ``size`` bytes behind it."""
        if place < self.base or place + size > self.base + len(self.data):
            self.source.seek(place)
            self.data, self.base = self.source.read(max(size, 16 * _LARGEST_BLOCK)), place
        return place - self.base

    def _first(self, start: int) -> int:
        """A block start is one whose successor is a block start as well, or
        the end of the file."""
        if start == 0:
            return 0
        self._need(start, 3 * _LARGEST_BLOCK)
        for found in _START.finditer(self.data, 0, 2 * _LARGEST_BLOCK):
            size = block_size(self.data, found.start())
            after = found.start() + size
            if size and (start + after == self.length or block_size(self.data, after)):
                return start + found.start()
        return self.length

    def next(self) -> bytes:
        """The text of the next block; moves ``at`` behind it."""
        index = self._need(self.at, min(_LARGEST_BLOCK, self.length - self.at))
        size = block_size(self.data, index)
        if not size:
            raise ValueError(f"no block at byte {self.at}")
        text = zlib.decompress(self.data[index : index + size], 31)
        self.at += size
        return text


def _pieces(source, length: int, start: int, stop: int) -> Iterator[bytes]:
    """The text that belongs to a slab, in pieces that end with whole lines."""
    blocks = _Blocks(source, length, start)
    inside, rest = start == 0, []
    while blocks.at < min(stop, length):
        text = blocks.next()
        if not inside:
            cut = text.find(b"\n")
            if cut < 0:
                continue
            inside, text = True, text[cut + 1 :]
        last = text.rfind(b"\n")
        if last < 0:
            rest.append(text)
        else:
            yield b"".join([*rest, text[: last + 1]])
            rest = [text[last + 1 :]]
    if not inside:
        return
    while blocks.at < length:
        text = blocks.next()
        cut = text.find(b"\n")
        if cut >= 0:
            rest.append(text[: cut + 1])
            break
        rest.append(text)
    if any(rest):
        yield b"".join(rest)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of the slabs named by rows of path, length, slab, start, stop."""

    def batch(row: dict, lines: list[bytes]) -> pa.RecordBatch:
        value = pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines], pa.string())
        n = len(lines)
        return pa.RecordBatch.from_arrays(
            [pa.array([row["path"]] * n, pa.string()), pa.array([row["slab"]] * n, pa.int64()), value], names=["path", "slab", "value"]
        )

    for rows in batches:
        for row in rows.to_pylist():
            with _open(row["path"]) as source:
                lines, size = [], 0
                for piece in _pieces(source, row["length"], row["start"], row["stop"]):
                    lines += piece.removesuffix(b"\n").split(b"\n")
                    size += len(piece)
                    if size >= _BATCH_BYTES:
                        yield batch(row, lines)
                        lines, size = [], 0
                if lines:
                    yield batch(row, lines)


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        kinds = []
        for path in rows.column("path").to_pylist():
            with _open(path) as source:
                kinds.append(block_size(source.read(4096), 0) > 0)
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(kinds, pa.bool_())], names=["path", "length", "blocks"])


def text_files(spark: SparkSession, path: str) -> tuple[list[tuple[str, int]], list[str]]:
    """Block-compressed files with their sizes, and the other files of ``path``
    (a file, folder or pattern): a list of files, as Spark's readers keep."""
    found = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    named = found.mapInArrow(_kinds, "path string, length long, blocks boolean").collect()
    return sorted((r.path, r.length) for r in named if r.blocks), sorted(r.path for r in named if not r.blocks)


def slabs_of(spark: SparkSession, files: list[tuple[str, int]], slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """``path``, ``length``, ``slab``, ``start`` and ``stop`` of all slabs."""
    size = max(slab_bytes, 2 * _LARGEST_BLOCK)
    listed = spark.createDataFrame(files, "path string, length long")
    slabs = listed.withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))))
    return slabs.withColumns({"start": F.col("slab") * size, "stop": (F.col("slab") + 1) * size})


def slab_lines(slabs: DataFrame) -> DataFrame:
    """``path``, ``slab`` and ``value`` of all lines of the given slabs, one
    task for each few of them."""
    tasks = max(1, min(slabs.count(), 100_000))
    return slabs.select("path", "length", "slab", "start", "stop").repartition(tasks).mapInArrow(_lines, LINES)


def read_lines(spark: SparkSession, path: str, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Lines of text files as column ``value``, block-compressed ones by slabs."""
    blocks, others = text_files(spark, path)
    parts = []
    if blocks:
        parts.append(slab_lines(slabs_of(spark, blocks, slab_bytes)).select("value"))
    if others:
        parts.append(spark.read.text(others))
    if not parts:
        return spark.createDataFrame([], StructType().add("value", "string"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
