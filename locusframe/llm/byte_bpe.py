"""Operator 10: byte-level BPE by longest matches and adjacent-pair checks.

A string of tokens is the merge result exactly when each two neighbours are
(``a`` then ``b`` is what merging the bytes of ``a + b`` gives). So the last
token of every prefix is the one token ending there that fits the last token
of the prefix before it. An Aho-Corasick automaton over bytes read as Latin-1
lists the tokens ending at each place, longest first; the first that fits is
kept, and the tokens are read off backwards. Whether two tokens fit is
remembered, so the work is linear in the text.

Defined results: a null text is empty and has no ids; rows, repeated or with
null ids, are encoded one by one; an empty table gives no row; other columns
are left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, table, tokenizer_path, utf8_or_empty, worker_cache
from locusframe.llm.tokens import BYTE_PATTERN, ChunkMemory, chunk_of, packed, spaced

#: Remembered pairs of a worker; beyond it the memory starts anew.
PAIR_LIMIT = 1_000_000


class PairEncoder:
    """Encoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = BYTE_PATTERN):
        import ahocorasick

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._pieces = regex.compile(pattern).findall
        self._fits: dict[tuple[int, int], bool] = {}
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self._automaton.make_automaton()

    def merge(self, piece: bytes) -> list[int]:
        """Merges one by one, lowest rank first: for short byte strings."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[x] for x in parts]

    def _fit(self, left: int, right: int) -> bool:
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= PAIR_LIMIT:
                self._fits.clear()
            if left < 0:
                known = self.merge(self.tokens[right]) == [right]
            else:
                known = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            self._fits[left, right] = known
        return known

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        # last[e]: token that ends the first e bytes; -1 at the start.
        last = [-1] * (len(piece) + 1)
        done = 0
        for end, (length, rank) in self._automaton.iter(piece.decode("latin-1")):
            end += 1
            if end > done and self._fit(last[end - length], rank):
                last[end] = rank
                done = end
        ids, end = [], len(piece)
        while end:
            ids.append(last[end])
            end -= len(self.tokens[last[end]])
        return ids[::-1]

    def chunk(self, chunk: bytes) -> bytes:
        return packed([i for piece in self._pieces(chunk.decode("utf-8", "replace")) for i in self.piece(piece.encode())])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def loaded(name: str) -> tuple[PairEncoder, ChunkMemory]:
    """The worker's encoder of a rank file and its memory of chunks."""
    key = f"ranks {name}"
    cache = worker_cache(key)
    if key not in cache:
        with open(tokenizer_path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoder = PairEncoder(ranks)
        cache[key] = encoder, ChunkMemory(lambda key: encoder.chunk(chunk_of(key)), tail_mark=b" ")
    return cache[key]


def encode_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, memory = loaded(vocabulary)
        for batch in batches:
            ids = [memory.pack(spaced(x)) for x in batch.column(1).to_pylist()]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"]
            )

    texts = docs.select(F.col("doc_id").cast("long"), utf8_or_empty("text").alias("text"))
    return arrow_stage(texts, run, "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encode_texts`` rows with ``decoded``: the bytes their ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = loaded(vocabulary)
        for batch in batches:
            texts = [encoder.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"]
            )

    return arrow_stage(encoded, run, "doc_id long, n_tokens long, ids binary, decoded binary")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to ids and back, as digests."""
    name = "byte_bpe_multi_50k.tiktoken"
    return decode_ids(encode_texts(table(spark, sf_dir, "documents"), name), name).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
