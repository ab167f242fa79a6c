"""Operator 7: token windows balanced by multiway differencing.

A document's ids (and its end id) are cut into full windows; what is left over
is cut into pieces of at most ``piece`` ids. Pieces are gathered into blocks
of about ``block_windows`` windows, and each block is dealt over its windows
by Karmarkar-Karp differencing: partial partitions are merged, always the two
with the largest imbalance, the heaviest slot of one onto the lightest of the
other, until one partition is left. While its heaviest window exceeds the
capacity, the block is dealt anew over one window more.

Defined results: a null text is empty (one piece holding the end id); repeated
rows and null ids are packed like any other row; an empty table gives no row;
other columns are left out. Every id lies in exactly one piece, and offsets in
a window have no gaps. No shuffle: a block never leaves its input partition,
and only one block is held by a task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, crc32, table, utf8_or_empty
from locusframe.llm.tokens import byte_memory, packed, spaced

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)
#: Ids left free in each window of a full block, so that near-equal windows fit.
SLACK = 6


def differencing(lengths: list[int], windows: int) -> list[list[int]]:
    """Indices of ``lengths`` dealt over ``windows`` nearly equal sums."""
    # A partial partition: its non-empty slots (sum, tree), heaviest first. A
    # tree is an index or a pair of trees.
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(lengths)]
    heapq.heapify(heap)
    made = len(lengths)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        clash = len(a) + len(b) - windows
        if clash <= 0:
            merged = a + b
        else:
            # Slot i of a meets slot windows-1-i of b, counted from the heaviest.
            free = len(a) - clash
            merged = a[:free] + b[: len(b) - clash]
            for (x, left), (y, right) in zip(a[free:], reversed(b[len(b) - clash :]), strict=True):
                merged.append((x + y, (left, right)))
        merged.sort(key=lambda slot: slot[0], reverse=True)
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heapreplace(heap, (least - merged[0][0], made, merged))
        made += 1
    dealt: list[list[int]] = []
    for _, tree in heap[0][2] if heap else []:
        leaves, open_trees = [], [tree]
        while open_trees:
            node = open_trees.pop()
            if isinstance(node, tuple):
                open_trees.extend(node)
            else:
                leaves.append(node)
        dealt.append(leaves)
    return dealt


def balanced(lengths: list[int], capacity: int) -> list[list[int]]:
    """As few windows as differencing can fill without exceeding ``capacity``."""
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        dealt = differencing(lengths, windows)
        if all(sum(lengths[i] for i in window) <= capacity for window in dealt):
            return dealt
        windows += 1


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    window: int = 1024,
    piece: int = 256,
    block_windows: int = 128,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``docs`` (doc_id, text) to windows of ``window`` ids.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers,
    null with ``keep_ids`` off.
    """
    end = packed([end_id])
    target = block_windows * (window - SLACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memory = byte_memory(vocabulary)
        next_id = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        block: list[tuple] = []
        held = 0

        def place(doc_id, ids, start, length, sequence, offset):
            part = ids[4 * start : 4 * (start + length)]
            rows.append(
                (doc_id, start, length, crc32(part), len(ids) // 4, sequence, offset, bytes(part) if keep_ids else None)
            )

        def deal():
            nonlocal next_id, held
            for members in balanced([x[3] for x in block], window):
                offset = 0
                for i in members:
                    place(*block[i], next_id, offset)
                    offset += block[i][3]
                next_id += 1
            block.clear()
            held = 0

        def flush():
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.binary())],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = memoryview(memory.pack(spaced(text)) + end)
                count = len(ids) // 4
                for start in range(0, count - window + 1, window):
                    place(doc_id, ids, start, window, next_id, 0)
                    next_id += 1
                start = count - count % window
                while start < count:
                    length = min(piece, count - start, target - held)
                    block.append((doc_id, ids, start, length))
                    held += length
                    start += length
                    if held == target:
                        deal()
                if len(rows) >= 4096:
                    yield flush()
        if block:
            deal()
        if rows:
            yield flush()

    return arrow_stage(docs.select("doc_id", utf8_or_empty("text").alias("text")), run, SCHEMA)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 byte-level ids."""
    return pack_documents(
        table(spark, sf_dir, "documents"), "byte_bpe_50k.json", end_id=0, keep_ids=False
    ).drop("ids")
