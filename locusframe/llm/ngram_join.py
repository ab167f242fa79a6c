"""Operator 9: Jaccard join of word shingle sets under several token orders.

If two sets are similar enough, then under ANY total order of tokens the
first few tokens of both share one. So a pair is verified only if its prefixes
meet under every one of ``ORDERS`` orders: the first order's prefixes are
joined, the others' are intersected. All orders put tokens that are frequent
in the corpus last and differ by a seeded hash otherwise.

Large groups of copies cost no pairs in a table: documents with equal sets are
one class from the start; then every class is verified against the smallest
document that shares its token of the smallest hash (a star per token, for
each order). What is not connected by then is joined by blocks: documents with
one such token form blocks of bounded size, pairs of blocks that share a prefix token are
searched in a task each, and only pairs of documents leave it. Blocks hold no
texts but prefixes and parity bits (``parity_bits``), which tell most sets that
differ too much; texts are read for the pairs that remain, first one for each
document and other component, then those still between two components.

A token is the 64-bit hash of a shingle; sets are compared by these.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a
text shorter than a shingle is one shingle of all its words; null and blank
texts have an empty set and no link; repeated rows are equal sets; null ids
are left unlinked with a null component; an empty table gives no row; other
columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, stored, table, utf8_or_empty, worker_cache
from locusframe.llm.graph import components
from locusframe.session import broadcast_if_small, discard, small_side

#: Token orders, as seeds of their hashes.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: A token counts as frequent from this many documents on.
FREQUENT_DOCUMENTS = 8
#: Most frequent tokens, at most so many, that the orders put last.
FREQUENT_TOKENS = 1_000_000
#: Tokens a task holds before it sorts and counts them.
_HELD_TOKENS = 6_000_000
#: Documents of a block, about.
BLOCK = 256
#: Hashes of words kept by a worker.
_WORD_LIMIT = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _WORD_LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct tokens (unsigned 64-bit) of each text of a batch."""
    hashes = worker_cache("shingle words").setdefault("hashes", _WordHashes())
    found = [text.lower().split() for text in texts]
    sizes = [len(x) for x in found]
    each = np.fromiter(map(hashes.__getitem__, chain.from_iterable(found)), np.uint64, sum(sizes))

    def tokens(part: np.ndarray, width: int) -> np.ndarray:
        token = np.full(max(0, len(part) - width + 1), width, np.uint64)
        for k in range(width):
            token = _mix(token * np.uint64(0x100000001B3) + part[k : k + len(token)])
        return token

    whole, sets, at = tokens(each, n), [], 0
    for size in sizes:
        if size >= n:
            own = np.sort(whole[at : at + size - n + 1])
            own = own[np.append(True, own[1:] != own[:-1])]
        else:
            own = tokens(each[at : at + size], size) if size else np.empty(0, np.uint64)
        sets.append(own)
        at += size
    return sets


def _as_long(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def frequent_tokens(docs: DataFrame, n: int) -> np.ndarray:
    """The most frequent tokens, sorted; at most ``FREQUENT_TOKENS``.

    Tokens found once in what a task counts at a time are not counted further:
    a frequent one is found again there. The list decides the orders alone, so
    results do not depend on it.
    """

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate(held)
        tokens.sort()
        start = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        counts = np.diff(np.append(start, len(tokens)))
        tokens, counts = _as_long(tokens[start[counts > 1]]), counts[counts > 1]
        for low in range(0, len(tokens), 100_000):
            part = slice(low, low + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(tokens[part]), pa.array(counts[part])], names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            sets = shingle_sets(batch.column(0).to_pylist(), n)
            held += sets
            size += sum(map(len, sets))
            if size >= _HELD_TOKENS:
                yield from counted(held)
                held, size = [], 0
        if held:
            yield from counted(held)

    found = arrow_stage(docs.select("text"), run, "token long, n long")
    found = found.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_DOCUMENTS)
    found = stored(found, "frequent-tokens")
    steps = found.groupBy(F.floor(F.log2("n") * 8).alias("step")).count().collect()
    total, least = 0, None
    for row in sorted(steps, key=lambda r: -r.step):
        total += row["count"]
        if total > FREQUENT_TOKENS:
            break
        least = row.step
    if least is None:
        return np.empty(0, np.uint64)
    kept = found.where(F.floor(F.log2("n") * 8) >= least).select("token").toArrow()
    discard(found)
    return np.sort(kept.column(0).to_numpy().view(np.uint64))


def _prefix_size(size: int, percent: int) -> int:
    return size - -(-size * percent // 100) + 1


def _ranks(tokens: np.ndarray, seed: int, common: np.ndarray) -> np.ndarray:
    """Place of each token in an order: frequent ones last, else by hash."""
    rank = _mix(tokens ^ np.uint64(seed)) >> np.uint64(1)
    if len(common):
        place = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        rank[common[place] == tokens] |= np.uint64(1 << 63)
    return rank


def prefix(tokens: np.ndarray, seed: int, common: np.ndarray, percent: int) -> np.ndarray:
    """The tokens of a set of which a similar set must hold one among its own."""
    size = _prefix_size(len(tokens), percent) if len(tokens) else 0
    if size >= len(tokens):
        return tokens
    return tokens[np.argpartition(_ranks(tokens, seed, common), size - 1)[:size]]


def parity_bits(tokens: np.ndarray) -> bytes:
    """A bit for each of 2**k places (64 at least, as many as tokens or up to
    twice as many): 1 if an odd number of tokens fall there. Bits of two sets
    differ in no more places than the sets have tokens apart."""
    places = max(64, 1 << (len(tokens) - 1).bit_length())
    counts = np.bincount((tokens & np.uint64(places - 1)).view(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def bits_apart(x: int, x_places: int, y: int, y_places: int) -> int:
    """Places in which parity bits differ; the larger ones are folded."""
    if x_places < y_places:
        x, x_places, y, y_places = y, y_places, x, x_places
    while x_places > y_places:
        x_places //= 2
        x = (x >> x_places) ^ (x & (1 << x_places) - 1)
    return (x ^ y).bit_count()


def digests(docs: DataFrame, n: int, percent: int, frequent) -> DataFrame:
    """Stored: doc_id, n_shingles, set_id (digest of the set), the prefix of
    the first order, the token of the smallest hash of every order (where
    copies agree even if what they share is frequent), and the parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        common, none = frequent.value, np.empty(0, np.uint64)
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), n)
            columns = [
                [len(x) for x in sets],
                [xxhash.xxh3_128_hexdigest(x.tobytes()) if len(x) else None for x in sets],
                [_as_long(prefix(x, ORDERS[0], common, percent)) for x in sets],
                [_as_long(np.array([x[np.argmin(_ranks(x, s, none))] for s in ORDERS if len(x)], np.uint64)) for x in sets],
                [parity_bits(x) if len(x) else None for x in sets],
            ]
            types = pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_shingles", "set_id", "prefix", "firsts", "bits"],
            )

    schema = "doc_id long, n_shingles long, set_id string, prefix array<long>, firsts array<long>, bits binary"
    return stored(arrow_stage(docs.select("doc_id", "text"), run, schema), "shingle-digests")


def verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int, frequent=None) -> DataFrame:
    """Stored pairs (a, b) of documents whose sets are similar enough.

    Only the texts of documents in a pair go on from the table. With
    ``frequent``, sets must share a prefix token under every order before they
    are compared.
    """
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted-documents")
    texts = stored(packed_texts(docs.join(broadcast_if_small(wanted), "doc_id", "left_semi")), "wanted-texts")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            left, right = (shingle_sets([zlib.decompress(x) for x in batch.column(k).to_pylist()], n) for k in (2, 3))
            near = []
            for x, y in zip(left, right, strict=True):
                if frequent is not None and not _prefixes_meet(x, y, frequent.value, percent):
                    near.append(False)
                    continue
                shared = len(np.intersect1d(x, y, assume_unique=True))
                near.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

    links = stored(arrow_stage(both.select("a", "b", "x", "y"), run, "a long, b long"), "verified-links")
    discard(texts, wanted)
    return links


def _prefixes_meet(x: np.ndarray, y: np.ndarray, common: np.ndarray, percent: int) -> bool:
    """True if the prefixes of two sets share a token under every order."""
    return all(
        len(np.intersect1d(prefix(x, seed, common, percent), prefix(y, seed, common, percent), assume_unique=True))
        for seed in ORDERS
    )


def packed_texts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with texts deflated: they are moved several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zlib.compress(x, 6) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "text"])

    return arrow_stage(docs.select("doc_id", "text"), run, "doc_id long, text binary")


def block_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents (a, b, their roots, apart) that may be similar, within
    groups of rows (centre, part: the group; side; doc_id; root; n_shingles;
    prefix; bits): between its sides or, in part -1, all of them.

    A group has a bounded number of documents, so a task holds few rows. Pairs
    of one root are passed over; others must share a prefix token and differ in
    few parity bits.
    """

    def searched(rows: list[dict]) -> Iterator[tuple]:
        bits = [int.from_bytes(r["bits"], "little") for r in rows]
        places = [8 * len(r["bits"]) for r in rows]
        holders: dict[int, list[int]] = {}
        for i, row in enumerate(rows):
            size, root, alone = row["n_shingles"], row["root"], row["part"] < 0
            tried: set[int] = set()
            # Side 0 comes first: its documents are only entered, the others
            # only looked up, unless the block is searched by itself.
            for token in row["prefix"]:
                if alone or row["side"]:
                    tried.update(holders.get(token, ()))
                if alone or not row["side"]:
                    holders.setdefault(token, []).append(i)
            for j in tried:
                other = rows[j]
                both = size + other["n_shingles"]
                if (
                    other["root"] != root
                    and 100 * size >= percent * other["n_shingles"]
                    and 100 * other["n_shingles"] >= percent * size
                ):
                    apart = bits_apart(bits[i], places[i], bits[j], places[j])
                    # Similar sets have no more tokens apart than this.
                    if (100 + percent) * apart <= (100 - percent) * both:
                        yield row["doc_id"], other["doc_id"], root, other["root"], apart

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in columns], names=["a", "b", "a_root", "b_root", "apart"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                if group and (row["centre"], row["part"]) != (group[0]["centre"], group[0]["part"]):
                    found += searched(group)
                    group = []
                group.append(row)
            yield batch_of(found)
        if group:
            yield batch_of(list(searched(group)))

    spread = members.repartition("centre", "part").sortWithinPartitions("centre", "part", "side")
    return arrow_stage(spread, run, "a long, b long, a_root long, b_root long, apart long")


def linked(pairs: DataFrame, docs: DataFrame, n: int, percent: int, frequent) -> DataFrame:
    """Links (a, b) among stored ``pairs`` (of ``block_pairs``) that connect
    all that any of them connects.

    The closest pair of each document and other root is verified first; the
    rest only where its two roots are not connected by then, so large groups
    of similar documents do not have all their pairs compared.
    """
    first = pairs.groupBy("a", "b_root").agg(F.min(F.struct("apart", "b")).alias("least"))
    first = stored(first.select("a", F.col("least.b").alias("b")), "first-pairs")
    near = verified(first, docs, n, percent, frequent)
    others = pairs.select("a", "b", "a_root", "b_root").distinct().join(first, ["a", "b"], "left_anti")
    met = near.join(pairs, ["a", "b"]).select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct()
    tops = stored(components(met), "tops")
    for side in ("a_root", "b_root"):
        top = tops.select(F.col("node").alias(side), F.col("root").alias(f"{side}_top"))
        others = others.join(broadcast_if_small(top), side, "left")
    rest = others.where(F.coalesce("a_root_top", "a_root") != F.coalesce("b_root_top", "b_root")).select("a", "b")
    rest = stored(rest.distinct(), "other-pairs")
    return near if rest.isEmpty() else near.union(verified(rest, docs, n, percent, frequent))


def _sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return (100 * x >= percent * y) & (100 * y >= percent * x)


def classes(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of all ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8_or_empty("text").alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, n))
    digest = digests(docs, n, percent, frequent)
    known = digest.where("set_id is not null and doc_id is not null")
    # One document of each set of tokens goes on.
    heads = stored(known.groupBy("set_id").agg(F.min("doc_id").alias("doc_id")), "set-heads")

    # A star for each order's first token.
    firsts = known.select("doc_id", "set_id", "n_shingles", F.posexplode("firsts").alias("order", "token"))
    firsts = stored(firsts.join(heads, ["set_id", "doc_id"], "left_semi").drop("set_id").distinct(), "first-tokens")
    centres = firsts.groupBy("order", "token").agg(
        F.min(F.struct("doc_id", "n_shingles")).alias("centre"), F.count("*").alias("size")
    )
    stars = (
        firsts.join(centres.where("size > 1"), ["order", "token"])
        .where(F.col("centre.doc_id") < F.col("doc_id"))
        .where(_sizes_fit(F.col("n_shingles"), F.col("centre.n_shingles"), percent))
        .select(F.col("centre.doc_id").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )
    near = verified(stored(stars, "stars"), docs, n, percent)
    roots = components(near)

    # Blocks: documents with one first token, about BLOCK at most.
    sized = firsts.where("order = 0").groupBy("token").agg(F.ceil(F.count("*") / BLOCK).alias("chunks"))
    rooted = (
        firsts.where("order = 0")
        .join(sized, "token")
        .join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("root", "doc_id").alias("root"),
            F.xxhash64("token", F.pmod(F.xxhash64("doc_id"), "chunks")).alias("block"),
        )
    )
    rooted = stored(rooted, "blocks")
    # Pairs of blocks that share a prefix token and are not of one root.
    postings = (
        known.select("doc_id", "prefix")
        .join(broadcast_if_small(rooted), "doc_id")
        .select("root", "n_shingles", "block", F.explode("prefix").alias("token"))
    )
    ranges = [f(c).alias(f"{c}_{k}") for c in ("root", "n_shingles") for k, f in (("low", F.min), ("high", F.max))]
    split = postings.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    split = small_side(split.select("token"), "mixed-tokens")
    mixed = stored(postings.join(split, "token", "left_semi").groupBy("token", "block").agg(*ranges), "mixed-blocks")
    left, right = mixed.alias("l"), mixed.alias("r")
    other_roots = (F.col("l.root_low") != F.col("r.root_high")) | (F.col("l.root_high") != F.col("r.root_low"))
    fit = (100 * F.col("l.n_shingles_high") >= percent * F.col("r.n_shingles_low")) & (
        100 * F.col("r.n_shingles_high") >= percent * F.col("l.n_shingles_low")
    )
    pairs = (
        left.join(right, F.col("l.token") == F.col("r.token"))
        .where((F.col("l.block") <= F.col("r.block")) & other_roots & fit)
        .select(F.col("l.block").alias("left"), F.col("r.block").alias("right"))
        .distinct()
    )
    pairs = stored(pairs, "block-pairs")
    # A group: one block and, in parts of about BLOCK documents, all smaller
    # blocks that it is paired with; or (part -1) one block with itself.
    sizes = rooted.groupBy("block").agg(F.count("*").alias("size"))
    weighed = pairs.join(sizes.select(F.col("block").alias("left"), F.col("size").alias("l")), "left").join(
        sizes.select(F.col("block").alias("right"), F.col("size").alias("r")), "right"
    )
    swap = F.col("r") > F.col("l")
    ordered = weighed.where("left <> right").select(
        F.when(swap, F.col("right")).otherwise(F.col("left")).alias("centre"),
        F.when(swap, F.col("left")).otherwise(F.col("right")).alias("block"),
        F.least("l", "r").alias("size"),
    )
    parts = ordered.groupBy("centre").agg(F.ceil(F.sum("size") / BLOCK).alias("parts"))
    around = ordered.join(parts, "centre").select(
        "centre", F.pmod(F.xxhash64("block"), "parts").alias("part"), "block", F.lit(1).alias("side")
    )
    around = stored(around, "block-groups")
    middle = around.select("centre", "part").distinct().select("centre", "part", F.col("centre").alias("block"), F.lit(0))
    alone = pairs.where("left = right").select("left", F.lit(-1).cast("long"), "left", F.lit(0))
    sides = stored(around.union(middle).union(alone), "group-sides")
    # Ids meet their groups first, so that sketches move as little as possible.
    placed = rooted.join(broadcast_if_small(sides), "block").select("doc_id", "root", "centre", "part", "side")
    placed = stored(placed, "group-members")
    # Halves of tokens do to find pairs: what they add is told apart later.
    halves = F.transform("prefix", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("prefix")
    members = known.select("doc_id", "n_shingles", halves, "bits").join(broadcast_if_small(placed), "doc_id")
    similar = stored(block_pairs(members, percent), "similar-pairs")
    discard(mixed, pairs, around, sides, placed)
    more = linked(similar, docs, n, percent, frequent)
    joined = components(near.union(more))

    by_set = heads.join(joined.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").select(
        "set_id", F.coalesce("root", "doc_id").alias("component_id")
    )
    return digest.select("doc_id", "n_shingles", "set_id").join(by_set, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, three-word shingles, similarity of 0.9."""
    return classes(table(spark, sf_dir, "documents"), n=3, percent=90)
