"""Hard negatives by slot-decomposed selection.

For each anchor and each of its positives, the best rows of other labels whose
score lies between a share of the positive's score and that score. These windows
of one anchor overlap, so they are not searched one by one:

1. **Positives.** The best rows of the anchor's own label; their scores are the
   windows' upper limits.
2. **Slots.** The limits, in descending order, split the scores into disjoint
   slots: slot i holds scores up to limit i and above limit i + 1. A row of
   another label lies in one slot at most. It is passed over if it is below the
   lower limit that belongs to its slot's own limit, which is the lowest lower
   limit of all windows that slot i takes part in.
3. **Combiners.** Each task keeps the best few rows of each (anchor, slot) and
   sends only these; Spark cuts what meets by the same rule.
4. **Suffix merges.** The window of limit i is the merge of slots i and below.
   Slots in descending order are already merged, so a window's rows are the
   first ones from its slot on, cut at its lower limit.

Rows are scored in matrix products of blocks; anchors go around in blocks of at
most ``BLOCK_ANCHORS`` rows, one pass over the rows for each, so neither what is
broadcast nor what a task holds grows with the table. Labels are compared inside
a block, so a label of any size is spread over all tasks. Scores are products of
whole numbers, exact as doubles up to 2^53; beyond that the block is multiplied
with Python's integers, and scores outside 64 bits take the nearest 64-bit value.

Defined results: rows with a null id, label or vector, or with a component that
is null or not finite, take no part. Rows equal in id, label and vector count
once; different rows of one id all count, but are never positives of an anchor
with that id. Vectors are compared with vectors of their own length only. Fewer
positives or negatives than asked for are returned as they are; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, stored, table
from locusframe.session import discard

#: Anchors of a pass (8 bytes a component) and of one matrix product, and rows
#: of an Arrow batch.
BLOCK_ANCHORS, TILE_ANCHORS, TILE_ROWS = 16_384, 512, 4_096

POSITIVES, NEGATIVES = 5, 5
#: A negative reaches this share of the positive's score, in percent.
LEAST_PERCENT = 80

_FOUND = "anchor long, slot int, score long, vec_id long"
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Stored distinct rows (``vec_id``, ``label``, ``v``) that take part;
    ``v`` holds whole numbers as doubles."""
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * scale)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
        .where(F.coalesce(fine, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("scaled"))
    )
    # floor() of a double is a long in Spark; doubles of 2^53 and more are whole.
    floored = F.transform("scaled", lambda x: F.when(F.abs(x) < float(_EXACT), F.floor(x).cast("double")).otherwise(x))
    return stored(rows.select("vec_id", "label", floored.alias("v")).distinct(), "vectors")


def anchor_blocks(rows: DataFrame, every: int, block_anchors: int = BLOCK_ANCHORS) -> tuple[DataFrame, int]:
    """Stored anchors (``anchor``, ``block``, ``vec_id``, ``label``, ``v``), ids
    divisible by ``every``, and the number of their blocks, none of which is
    larger than ``block_anchors``."""
    anchors = stored(rows.where(F.col("vec_id") % every == 0).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    total, parts = anchors.count(), 1
    block = F.lit(0)
    while total:
        largest = anchors.groupBy(block.alias("block")).count().agg(F.max("count")).first()[0]
        if largest <= block_anchors:
            break
        parts = max(parts + 1, -(-parts * largest // block_anchors))
        block = F.pmod(F.xxhash64("anchor"), F.lit(parts))
    return anchors.withColumn("block", block), parts if total else 0


def _matrix(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors by vector length."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    sizes = np.diff(offsets)
    out = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out[int(size)] = at, values[offsets[at][:, None] + np.arange(size)]
    return out


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers."""
    size = left.shape[1]
    top = (np.abs(left).max(initial=0)) * (np.abs(right).max(initial=0)) * max(size, 1)
    if top < _EXACT:
        return np.rint(left @ right.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in left], dtype=object).reshape(left.shape)
    other = np.array([[int(x) for x in row] for row in right], dtype=object).reshape(right.shape)
    return np.clip(exact.dot(other.T), -_LONG, _LONG).astype(np.int64)


def best_of(found: list[np.ndarray], keep: int) -> list[np.ndarray]:
    """Columns (anchor, slot, score, vec_id) cut to the ``keep`` first rows of
    each (anchor, slot): higher scores first, ties by smaller id."""
    anchor, slot, score, vec = found
    order = np.lexsort((vec, -score, slot, anchor))
    anchor, slot, score, vec = anchor[order], slot[order], score[order], vec[order]
    n = len(anchor)
    new = np.ones(n, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
    rank = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.arange(0)
    kept = rank < keep
    return [anchor[kept], slot[kept], score[kept], vec[kept]]


def _first_ties(score: np.ndarray, allowed: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's allowed scores the ``keep`` highest; the columns stand in
    order of id, so of equal scores the first are taken."""
    if score.shape[1] <= keep:
        return allowed
    masked = np.where(allowed, score, -_LONG - 1)
    edge = np.partition(masked, -keep, axis=1)[:, -keep][:, None]
    tie = allowed & (masked == edge)
    return (allowed & (masked > edge)) | (tie & (np.cumsum(tie, axis=1) <= keep))


class Anchors:
    """A block of anchors as arrays, sent to the tasks of a pass."""

    def __init__(self, rows: pa.Table, limits: pa.Table | None = None):
        vectors = rows.column("v").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.float64()))
        self.number = rows.column("anchor").to_numpy()
        self.vec_id = rows.column("vec_id").to_numpy()
        self.label = rows.column("label").to_numpy()
        self.by_size = _matrix(vectors)
        if limits is not None:
            # Distinct upper limits of each anchor, descending; unused ones at
            # the end are below every score.
            lists = limits.column("limits").to_pylist()
            self.limits = np.full((len(self.number), max([1, *map(len, lists)])), -_LONG - 1, dtype=np.int64)
            place = {x: i for i, x in enumerate(self.number.tolist())}
            for anchor, scores in zip(limits.column("anchor").to_pylist(), lists, strict=True):
                self.limits[place[anchor], : len(scores)] = scores


def _below_share(score: np.ndarray, limit: np.ndarray, percent: int) -> np.ndarray:
    """100 * score < percent * limit, without leaving 64 bits."""
    if max(np.abs(score).max(initial=0), np.abs(limit).max(initial=0)) < _LONG // 200:
        return 100 * score < percent * limit
    return 100 * score.astype(object) < percent * limit.astype(object)


def _positives(own: Anchors, at: np.ndarray, score: np.ndarray, vec: np.ndarray, label: np.ndarray, keep: int):
    allowed = (own.label[at][:, None] == label) & (own.vec_id[at][:, None] != vec)
    row, column = np.nonzero(_first_ties(score, allowed, keep))
    return [own.number[at[row]], np.zeros(len(row), np.int32), score[row, column], vec[column]]


def _negatives(own: Anchors, at: np.ndarray, score: np.ndarray, vec: np.ndarray, label: np.ndarray, percent: int):
    limits = own.limits[at]
    lowest = np.where(limits >= 0, limits, _LONG).min(axis=1)
    allowed = (own.label[at][:, None] != label) & (score <= limits[:, :1]) & (score >= 0)
    allowed &= ~_below_share(score, np.where(lowest == _LONG, 0, lowest)[:, None], percent)
    row, column = np.nonzero(allowed)
    value = score[row, column]
    # The slot is that of the smallest limit that is not below the score.
    slot = (limits[row] >= value[:, None]).sum(axis=1) - 1
    near = ~_below_share(value, limits[row, slot], percent)
    row, column, value, slot = row[near], column[near], value[near], slot[near]
    return [own.number[at[row]], slot.astype(np.int32), value, vec[column]]


def _pass(broadcast, pick, keep: int):
    """Best rows of a task for each (anchor, slot) of the broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = broadcast.value
        best = [np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)]
        for batch in batches:
            vec = batch.column("vec_id").to_numpy()
            label = batch.column("label").to_numpy()
            for size, (at, vectors) in _matrix(batch.column("v")).items():
                if size not in own.by_size:
                    continue
                order = np.argsort(vec[at], kind="stable")
                at, vectors = at[order], vectors[order]
                mine, matrix = own.by_size[size]
                for first in range(0, len(mine), TILE_ANCHORS):
                    tile = slice(first, first + TILE_ANCHORS)
                    found = pick(own, mine[tile], _scores(matrix[tile], vectors), vec[at], label[at])
                    if len(found[0]):
                        best = best_of([np.concatenate(x) for x in zip(best, found, strict=True)], keep)
        if len(best[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["anchor", "slot", "score", "vec_id"])

    return run


def _cut(found: DataFrame, keep: int) -> DataFrame:
    """What the tasks of a pass sent, cut by the same rule: at most ``keep``
    rows from each task meet in a group."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def _search(rows: DataFrame, own: Anchors, pick, keep: int, label: str) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(own)
    out = stored(_cut(arrow_stage(rows, _pass(held, pick, keep), _FOUND, TILE_ROWS), keep), label)
    held.destroy()
    return out


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = LEAST_PERCENT,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores
    for the anchors (ids divisible by ``every``) of ``vectors`` (``vec_id``,
    ``label``, ``embedding``); see the module text."""
    rows = prepared(vectors)
    anchors, blocks = anchor_blocks(rows, every, block_anchors)
    out = None
    for block in range(blocks):
        members = anchors.where(F.col("block") == block).drop("block")
        local = members.toArrow()
        near = _search(rows, Anchors(local), lambda *x: _positives(*x, positives), positives, "positives")
        limits = near.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
        far = _search(rows, Anchors(local, limits.toArrow()), lambda *x: _negatives(*x, percent), negatives, "slots")
        part = _windows(members.select("anchor", F.col("vec_id").alias("anchor_id")), near, far, negatives, percent)
        part = stored(part, "negatives")
        discard(near, far)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.sparkSession.createDataFrame([], _RESULT)
    return out


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _windows(members: DataFrame, near: DataFrame, far: DataFrame, negatives: int, percent: int) -> DataFrame:
    """The rows of every window, as suffixes of the anchor's merged slots (at
    most ``negatives`` rows for each of its limits)."""
    entry = F.struct((-F.col("score")).alias("down"), F.col("vec_id").alias("negative_id"), "slot")
    merged = far.groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("merged"))
    limit = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    suffix = F.slice(F.filter("merged", lambda x: -x["down"] <= F.col("positive_score")), 1, negatives)
    least = F.col("positive_score").cast("decimal(38,0)") * percent
    return (
        limit.join(merged, "anchor")
        .join(members, "anchor")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(suffix).alias("place", "x"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            F.col("x.negative_id").alias("negative_id"),
            "positive_score",
            (-F.col("x.down")).alias("negative_score"),
        )
        .where(F.col("negative_score").cast("decimal(38,0)") * 100 >= least)
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the given vectors, a seventh of them relabelled."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", label.alias("label"), "embedding"))


OP12_SQL = f"""
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS a, a.label AS a_label, b.vec_id AS b, b.label AS b_label,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND len(a.v) = len(b.v)
), pos AS (
  SELECT a, b, score FROM s WHERE a_label = b_label AND a <> b
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES}
), neg AS (
  SELECT p.a, p.b AS positive_id, p.score AS positive_score, s.b AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM pos p JOIN s ON s.a = p.a AND s.a_label <> s.b_label
   AND 100 * s.score <= 100 * p.score AND 100 * s.score >= {LEAST_PERCENT} * p.score
)
SELECT a AS anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= {NEGATIVES}
"""
