"""EM of groups too large for one task, on blocks of genotype patterns.

The pairs of a group are shuffled once, by pattern, into blocks: one row each,
with whole patterns, the block's haplotypes once each, and pairs as integers.
Haplotypes are then numbered within their group, so that frequencies are one
array per group, at most ``max_haps`` numbers long, which every step broadcasts.
A task weighs the pairs of its blocks and adds up haplotype copies in an array;
what leaves it are the parts of that array, each a chunk of neighbouring
haplotypes. So a step shuffles one short row per task and chunk, and the common
haplotype of a group is no shuffle key anywhere. Groups go through the steps in
lots whose frequencies stay near ``STATE_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from locusframe.config import Thresholds
from locusframe.session import discard, materialize

STEPS_PER_ROUND = 5
#: Haplotypes of a chunk, bytes of frequencies broadcast at a time, and numbers
#: of the arrays that a task holds before it hands them on.
CHUNK, STATE_BYTES, _HELD = 4096, 32 * 1024 * 1024, 8_000_000
#: Pairs this near to a pattern's best are as good as it.
TIE = 1e-9


def expected_copies(a: np.ndarray, b: np.ndarray, load: np.ndarray, size: int) -> np.ndarray:
    """Copies of each haplotype when pair (a, b) counts ``load`` individuals."""
    return np.bincount(a, load, size) + np.bincount(b, load, size)


def posteriors(f: np.ndarray, a: np.ndarray, b: np.ndarray, pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair posteriors under frequencies ``f``, and pattern likelihoods. A pair
    of two different haplotypes can arise in two ways."""
    weight = f[a] * f[b] * np.where(a == b, 1.0, 2.0)
    like = np.bincount(pattern, weight)
    return weight / np.maximum(like, 1e-300)[pattern], like


def trimmed(post: np.ndarray, pattern: np.ndarray, min_pp: float) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the pairs of at least ``min_pp`` and their posteriors scaled to
    one. A pattern whose pairs all fall below keeps its best ones."""
    best = np.zeros(pattern.max() + 1)
    np.maximum.at(best, pattern, post)
    keep = post >= np.minimum(min_pp, best * (1 - TIE))[pattern]
    kept = np.where(keep, post, 0.0)
    return keep, (kept / np.bincount(pattern, kept)[pattern])[keep]


def _block_rows(rows: pd.DataFrame, group: list[str]) -> pd.DataFrame:
    out = []
    for key, part in rows.groupby(group, sort=False):
        pattern, patterns = pd.factorize(part["pattern"])
        hap, haps = pd.factorize(pd.concat([part["h1"], part["h2"]], ignore_index=True))
        n = np.zeros(len(patterns))
        n[pattern] = part["n"]
        post = part["post"].to_numpy(float)
        post = post / np.bincount(pattern, post)[pattern]
        out.append([*key, list(patterns), n, list(haps), pattern, hap[: len(part)], hap[len(part) :], post])
    return pd.DataFrame(out, columns=[*group, "patterns", "n", "haps", "pattern", "a", "b", "post"])


def _cut(group: list[str]):
    """Sorted pairs to blocks of whole patterns, about one for each batch."""
    by = [*group, "pattern"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if rows.empty:
                continue
            # The last pattern may go on in the next batch.
            last = (rows[by] == rows[by].iloc[-1]).all(axis=1).to_numpy()
            whole, held = rows[~last], rows[last]
            if len(whole):
                yield _block_rows(whole, group)
        if held is not None and len(held):
            yield _block_rows(held, group)

    return cut


def pattern_blocks(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Stored blocks of ``pairs`` (group, pattern, n, h1, h2, post)."""
    ints, doubles, texts = ArrayType(IntegerType()), ArrayType(DoubleType()), ArrayType(StringType())
    kinds = [("patterns", texts), ("n", doubles), ("haps", texts), ("pattern", ints), ("a", ints), ("b", ints), ("post", doubles)]
    schema = StructType([pairs.schema[g] for g in group] + [StructField(name, kind) for name, kind in kinds])
    by = [*group, "pattern"]
    dealt = pairs.select(*by, "n", "h1", "h2", "post").repartition(*by).sortWithinPartitions(*by)
    return materialize(dealt.mapInPandas(_cut(group), schema).withColumn("block", F.monotonically_increasing_id()), "pattern-blocks")


def numbered(blocks: DataFrame, group: list[str], max_haps: float) -> tuple[DataFrame, DataFrame]:
    """Stored blocks with ``codes``, the numbers of their haplotypes, and
    ``size`` and ``total`` (haplotypes, individuals) of each group. A haplotype
    comes once from each block, however many pairs have it."""
    found = blocks.select(*group, "block", F.posexplode("haps").alias("at", "h"))
    names = found.select(*group, "h").distinct()
    order = Window.partitionBy(*group).orderBy("h")
    names = materialize(names.withColumn("code", F.row_number().over(order) - 1), "haplotype-numbers")
    people = blocks.select(*group, F.aggregate("n", F.lit(0.0), lambda s, x: s + x).alias("n")).groupBy(*group).agg(F.sum("n").alias("total"))
    sizes = materialize(names.groupBy(*group).agg(F.count("*").alias("size")).join(people, group), "group-sizes")
    most = sizes.agg(F.max("size")).first()[0]
    if most > max_haps:
        raise ValueError(f"{most} candidate haplotypes in one group exceed {max_haps:g}")
    codes = (
        found.join(names, [*group, "h"])
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("at", "code"))).alias("_c"))
        .select("block", F.col("_c.code").alias("codes"))
    )
    out = materialize(blocks.join(codes, "block"), "numbered-blocks")
    discard(names)
    return out, sizes


def _copies(group: list[str], given: bool):
    """Copies of the haplotypes of a task, by chunk; from the posteriors the
    blocks came with (``given``) or from the frequencies ``f``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}

        def release() -> Iterator[pd.DataFrame]:
            rows = []
            for key, (total, copies, f, seen) in held.items():
                for chunk in np.flatnonzero(seen):
                    part = slice(chunk * CHUNK, (chunk + 1) * CHUNK)
                    rows.append([*key, int(chunk), total, copies[part], f[part]])
            held.clear()
            yield pd.DataFrame(rows, columns=[*group, "chunk", "total", "copies", "old"])

        for batch in batches:
            for row in batch.itertuples(index=False):
                key = tuple(getattr(row, g) for g in group)
                if key not in held:
                    if sum(len(x[1]) for x in held.values()) + row.size > _HELD:
                        yield from release()
                    f = np.zeros(row.size) if given else np.asarray(row.f)
                    held[key] = [row.total, np.zeros(row.size), f, np.zeros(-(-row.size // CHUNK), dtype=bool)]
                _, copies, f, seen = held[key]
                codes, pattern = np.asarray(row.codes), np.asarray(row.pattern)
                a, b = np.asarray(row.a), np.asarray(row.b)
                post = np.asarray(row.post) if given else posteriors(f[codes], a, b, pattern)[0]
                copies[codes] += expected_copies(a, b, np.asarray(row.n)[pattern] * post, len(codes))
                seen[codes // CHUNK] = True
        yield from release()

    return run


def _added(group: list[str]):
    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        f = np.sum(rows["copies"].to_list(), axis=0) / (2 * rows["total"].iloc[0])
        worst = float(np.abs(f - rows["old"].iloc[0]).max())
        return pd.DataFrame([[*key, rows["total"].iloc[0], f, worst]], columns=[*group, "chunk", "total", "f", "worst"])

    return add


def _step(blocks: DataFrame, state: DataFrame, group: list[str], given: bool = False) -> DataFrame:
    """New frequencies of each group: ``total``, ``size``, ``f``, ``worst``."""
    keys = StructType([blocks.schema[g] for g in group]).fields
    number = [StructField("chunk", IntegerType()), StructField("total", DoubleType())]
    arrays = ArrayType(DoubleType())
    summed = StructType([*keys, *number, StructField("copies", arrays), StructField("old", arrays)])
    solved = StructType([*keys, *number, StructField("f", arrays), StructField("worst", DoubleType())])
    needed = ["codes", "pattern", "a", "b", "n"] + (["post"] if given else [])
    near = blocks.select(*group, *needed).join(F.broadcast(state.drop("worst")), group)
    parts = near.mapInPandas(_copies(group, given), summed).groupBy(*group, "chunk").applyInPandas(_added(group), solved)
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "f"))), lambda x: x["f"]))
    new = parts.groupBy(*group).agg(F.max("total").alias("total"), whole.alias("f"), F.max("worst").alias("worst"))
    return new.withColumn("size", F.size("f"))


def _trim_blocks(group: list[str], min_pp: float):
    def trim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a, b, pattern = np.asarray(row.a), np.asarray(row.b), np.asarray(row.pattern)
                post, like = posteriors(np.asarray(row.f)[np.asarray(row.codes)], a, b, pattern)
                keep, post = trimmed(post, pattern, min_pp)
                haps, kept = np.asarray(row.haps, dtype=object), pattern[keep]
                out = {g: [getattr(row, g)] * len(kept) for g in group}
                out |= {"pattern": np.asarray(row.patterns, dtype=object)[kept], "n": np.asarray(row.n)[kept].astype("int64")}
                out |= {"h1": haps[a[keep]], "h2": haps[b[keep]], "post": post, "_sum": like[kept]}
                yield pd.DataFrame(out)

    return trim


def settle_blocks(
    pairs: DataFrame, group: list[str], limits: Thresholds, schema: StructType, tolerance: float, max_rounds: int,
    state_bytes: int = STATE_BYTES,
) -> DataFrame:
    """EM to convergence of every group of ``pairs``; posteriors, trimmed."""
    blocks, sizes = numbered(pattern_blocks(pairs, group), group, limits.max_haps)
    lots = max(1, -(-8 * int(sizes.agg(F.sum("size")).first()[0]) // state_bytes))
    lot = F.pmod(F.xxhash64(*group), F.lit(lots))
    out: list[DataFrame] = []
    for number in range(lots):
        state = sizes.filter(lot == number)
        state = materialize(_step(blocks, state, group, given=True), "frequencies")
        for _ in range(max_rounds):
            for _ in range(STEPS_PER_ROUND):
                state = _step(blocks, state, group)
            judged = materialize(state, "frequencies")
            near = blocks.join(F.broadcast(judged.filter(F.col("worst") < tolerance).select(*group, "f")), group)
            out.append(near.mapInPandas(_trim_blocks(group, limits.min_pp), schema))
            state = judged.filter(F.col("worst") >= tolerance)
            if state.isEmpty():
                break
        else:
            raise RuntimeError("haplotype frequencies did not settle")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found
