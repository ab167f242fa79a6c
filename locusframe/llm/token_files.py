"""Operator 6: token files compressed by a pair grammar.

Documents are encoded, sorted by ``doc_id`` over range partitions, and written
in shards of ``shard_ids`` ids. A shard's ids are shortened by Re-Pair: the
most frequent pairs of neighbours become nonterminals, again and again, a
batch of pairs that cannot overlap at a time. No pair crosses the end of a
document. The file keeps rules, expansion lengths and the place of every
document, so any range of ids is decoded without the rest.

File (little-endian): ``RPG1``, then unsigned 32-bit counts (first nonterminal,
rules, documents, bytes of a symbol), 64-bit counts (symbols, ids), and the
arrays: rules (2 x 32 bit), expansion lengths (32), document ids (64), null
marks of these (8), first id of each document and their total (64), first
symbol of each document and their total (64), the first id of every
``STEP``-th symbol (64), symbols (16 or 32).

Defined results: a null text is empty (its end id only); a null id sorts
first; rows with one id follow the order of their texts; an empty table
writes no file; other columns are left out.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, get_file, put_file, shared_folder, stored, table, utf8_or_empty
from locusframe.llm.tokens import packed, word_memory, words

MANIFEST = "part int, shard int, uri string, n_docs long, n_tokens long"
STEP = 1024
_HEAD = "<4s4I2Q"
#: Slots of a round's pairs, so that a pair is looked up at once.
_SLOT_BITS = 20
_SLOTS = 1 << _SLOT_BITS


class Grammar(NamedTuple):
    first: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray


def _pairs(symbols: np.ndarray, last: int) -> np.ndarray:
    """Neighbours as one number each, of 32 bits if all symbols (up to ``last``)
    fit in 16: these are sorted in half the time."""
    wide = np.dtype(np.uint32 if last < 1 << 16 else np.uint64)
    pairs = symbols[:-1].astype(wide)
    pairs <<= wide.type(4 * wide.itemsize)
    pairs |= symbols[1:]
    return pairs


def _slots(pairs: np.ndarray) -> np.ndarray:
    """Place of each pair in a table of ``_SLOTS``."""
    bits = 8 * pairs.itemsize
    return (pairs * pairs.dtype.type(0x9E3779B97F4A7C15 >> 64 - bits)) >> pairs.dtype.type(bits - _SLOT_BITS)


def _frequent_pairs(
    pairs: np.ndarray, end_id: int, least: int, most: int
) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Pairs found ``least`` times or more, most frequent first, such that no
    symbol is the left of one chosen pair and the right of another and no two
    have one slot; what their slots hold (their number from 1); and the slots
    of all pairs found so often."""
    half = 4 * pairs.itemsize
    keys = np.sort(pairs)
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    found = np.diff(start, append=len(keys))
    often = np.flatnonzero(found >= least)
    keys, found = keys[start[often]], found[often]
    inside = (keys >> keys.dtype.type(half) != end_id) & (keys & keys.dtype.type((1 << half) - 1) != end_id)
    keys, found = keys[inside], found[inside]
    hot = np.zeros(_SLOTS, bool)
    hot[_slots(keys)] = True
    keys = keys[np.argsort(-found, kind="stable")[: 4 * most]]
    slot_of = np.zeros(_SLOTS, np.uint16 if most < 1 << 16 else np.uint32)
    role: dict[int, str] = {}
    taken: set[int] = set()
    chosen = []
    for key, slot in zip(keys.tolist(), _slots(keys).tolist(), strict=True):
        a, b = key >> half, key & (1 << half) - 1
        if slot in taken:
            continue
        if a == b:
            if a in role:
                continue
            role[a] = "both"
        elif role.get(a, "left") != "left" or role.get(b, "right") != "right":
            continue
        else:
            role[a], role[b] = "left", "right"
        chosen.append((a, b))
        taken.add(slot)
        slot_of[slot] = len(chosen)
        if len(chosen) == most:
            break
    return chosen, slot_of, hot


def compress(ids: np.ndarray, first: int, end_id: int, max_rules: int, batch: int = 6144, least: int = 16) -> Grammar:
    """Grammar of ``ids`` (unsigned 32-bit, all below ``first``): pairs are
    replaced until no pair is found ``least`` times or ``max_rules`` are used."""
    symbols = ids.astype(np.uint32)
    rules: list[tuple[int, int]] = []
    lengths: list[int] = []
    fresh, hot = 0, np.ones(_SLOTS, bool)
    while True:
        room = min(batch, max_rules - len(rules))
        if room <= 0 or len(symbols) < 2:
            break
        pairs = _pairs(symbols, first + max_rules - 1)
        slots = _slots(pairs)
        # Replacing makes a pair of old symbols rarer, so only those that were
        # frequent before and pairs with a new symbol are counted.
        new = symbols >= fresh
        chosen, slot_of, hot = _frequent_pairs(pairs[hot[slots] | new[:-1] | new[1:]], end_id, least, room)
        if not chosen:
            break
        fresh = first + len(rules)
        half = pairs.dtype.type(4 * pairs.itemsize)
        named = np.array([(0, 0), *chosen], dtype=pairs.dtype)
        named = named[:, 0] << half | named[:, 1]
        place = slot_of[slots]
        at = np.flatnonzero(place)
        at = at[named[place[at]] == pairs[at]]
        # In a run of one symbol every second pair is taken.
        starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        if len(starts) < len(at):
            run_start = np.repeat(at[starts], np.diff(np.append(starts, len(at))))
            at = at[(at - run_start) % 2 == 0]
        symbols[at] = place[at].astype(np.uint32) + np.uint32(first + len(rules) - 1)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        for a, b in chosen:
            lengths.append((1 if a < first else lengths[a - first]) + (1 if b < first else lengths[b - first]))
        rules.extend(chosen)
    return Grammar(first, np.array(rules, dtype="<u4").reshape(-1, 2), np.array(lengths, dtype="<u4"), symbols)


def _expansions(first: int, rules: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all symbols one after the other, and where each one's lie."""
    size = np.concatenate([np.ones(first, np.int64), lengths.astype(np.int64)])
    start = np.concatenate([[0], np.cumsum(size)])
    flat = np.empty(start[-1], dtype=np.uint32)
    flat[:first] = np.arange(first, dtype=np.uint32)
    for i, (a, b) in enumerate(rules.tolist(), first):
        middle = start[i] + size[a]
        flat[start[i] : middle] = flat[start[a] : start[a + 1]]
        flat[middle : start[i + 1]] = flat[start[b] : start[b + 1]]
    return flat, start[:-1], size


def encode_shard(doc_ids: list, texts: list[np.ndarray], first: int, end_id: int, max_rules: int) -> bytes:
    """File content of one shard."""
    counts = np.array([len(x) for x in texts], dtype=np.int64)
    grammar = compress(np.concatenate(texts), first, end_id, max_rules)
    size = np.concatenate([np.ones(first, np.int64), grammar.lengths.astype(np.int64)])
    symbol_start = np.concatenate([[0], np.cumsum(size[grammar.symbols])])
    doc_start = np.concatenate([[0], np.cumsum(counts)])
    width = 2 if first + len(grammar.rules) <= 1 << 16 else 4
    nulls = np.array([x is None for x in doc_ids], dtype="<u1")
    head = struct.pack(_HEAD, b"RPG1", first, len(grammar.rules), len(doc_ids), width, len(grammar.symbols), int(doc_start[-1]))
    arrays = (
        grammar.rules,
        grammar.lengths,
        np.array([x or 0 for x in doc_ids], dtype="<i8"),
        nulls,
        doc_start.astype("<u8"),
        np.searchsorted(symbol_start, doc_start).astype("<u8"),
        symbol_start[:-1:STEP].astype("<u8"),
        grammar.symbols.astype(f"<u{width}"),
    )
    return head + b"".join(x.tobytes() for x in arrays)


class Shard:
    """Random access to the ids of one shard file."""

    def __init__(self, content: bytes):
        magic, first, rules, docs, width, symbols, self.n_tokens = struct.unpack_from(_HEAD, content)
        if magic != b"RPG1":
            raise ValueError("not a token file")
        at = struct.calcsize(_HEAD)

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(content, dtype, count, at)
            at += part.nbytes
            return part

        pairs, lengths = take("<u4", 2 * rules).reshape(-1, 2), take("<u4", rules)
        self._ids, self._null = take("<i8", docs), take("<u1", docs)
        self.doc_start, self.doc_symbol = take("<u8", docs + 1).astype(np.int64), take("<u8", docs + 1).astype(np.int64)
        self._marks = take("<u8", -(-symbols // STEP)).astype(np.int64)
        self._symbols = take(f"<u{width}", symbols)
        self._flat, self._at, self._size = _expansions(first, pairs, lengths)

    def doc_ids(self) -> list:
        return [None if null else x for x, null in zip(self._ids.tolist(), self._null.tolist(), strict=True)]

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self._size[symbols]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._at[symbols] - (ends - size), size) + np.arange(total)]

    def document(self, i: int) -> np.ndarray:
        return self._expand(self._symbols[self.doc_symbol[i] : self.doc_symbol[i + 1]])

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, expanding only their symbols."""
        start, stop = max(0, start), min(stop, self.n_tokens)
        if start >= stop:
            return np.empty(0, np.uint32)
        mark = int(np.searchsorted(self._marks, start, "right")) - 1
        last = int(np.searchsorted(self._marks, stop, "left"))
        found = self._expand(self._symbols[mark * STEP : last * STEP])
        return found[start - self._marks[mark] : stop - self._marks[mark]]


def write_shards(
    docs: DataFrame, vocabulary: str, vocabulary_size: int, end_id: int, shard_ids: int = 1 << 21
) -> DataFrame:
    """Write all ``docs`` (doc_id, text) in ascending order; the stored manifest."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    end = packed([end_id])
    max_rules = (1 << 16) - vocabulary_size if vocabulary_size < 1 << 16 else 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memory, part, shard = word_memory(vocabulary), TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal shard, held
            content = encode_shard(ids, texts, vocabulary_size, end_id, max_rules)
            row = [part], [shard], [put_file(folder, f"part-{part:06d}-{shard:04d}", content)], [len(ids)], [held]
            ids.clear(), texts.clear()
            shard, held = shard + 1, 0
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, types, strict=True)], names=[c.split()[0] for c in MANIFEST.split(", ")]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(np.frombuffer(memory.pack(words(text)) + end, dtype="<u4"))
                held += len(texts[-1])
                if held >= shard_ids:
                    yield flush()
        if ids:
            yield flush()

    ordered = (
        docs.select("doc_id", utf8_or_empty("text").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return stored(arrow_stage(ordered, run, MANIFEST), "token-manifest")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: the ids of all earlier shards.

    Shards are summed inside their partition; only one row per partition meets
    in the running total over partitions.
    """
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    return (
        manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(parts, "part")
        .withColumn("start", F.col("inside") + F.col("part_start"))
        .drop("inside", "part_start")
    )


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document, read back: doc_id, start, n_tokens and its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(get_file(uri))
                names, starts = shard.doc_ids(), shard.doc_start
                for low in range(0, len(names), 512):
                    high = min(low + 512, len(names))
                    part = [shard.document(i).astype("<u4").tobytes() for i in range(low, high)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[low:high], pa.int64()),
                            pa.array(starts[low:high] + base, pa.int64()),
                            pa.array([len(x) // 4 for x in part], pa.int64()),
                            pa.array(part, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    spark = manifest.sparkSession
    files = shard_starts(manifest).select("uri", "start")
    spread = files.repartition(4 * spark.sparkContext.defaultParallelism, "uri")
    return arrow_stage(spread, run, "doc_id long, start long, n_tokens long, ids binary")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through token files and back."""
    manifest = write_shards(table(spark, sf_dir, "documents"), "word_bpe_49k.json", 49_408, end_id=1)
    return read_shards(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
