"""Operator 5: exact near-duplicate vectors by cover trees.

Vectors of one label (and length) are dealt over chunks of about ``CHUNK``;
each pair of chunks is a task of its own, so no label meets in one task. A
chunk's cover tree is nested: each level's centres are those of the level
above and more, at half the radius. Two trees are walked together, level by
level. A pair of nodes is dropped when its centres are farther apart than the
threshold and both covering radii, counted whole when all its points must be
near enough, and opened otherwise; pairs of leaves are verified by the cosine
itself. Copies so cost one pair of nodes, not a pair of vectors each.

Unstructured vectors of many dimensions leave little to drop above the level
where every point is its own centre: then all pairs of a label are looked at
once. That is the method's cost on such data.

Defined results: null, zero-length, zero and non-finite vectors, vectors with a
null component, and vectors without a label have no link; rows with one
``vec_id`` are one vector (its smallest label and embedding); a null id is
left unlinked with a null component; an empty table gives no row; other
columns are left out.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import stored, table
from locusframe.llm.graph import components

#: Vectors of a chunk, about.
CHUNK = 1024
#: Radius of the finest level; its nodes are the leaves.
_FINEST = 2.0**-7
#: Room for rounding in the bounds; what falls within it is verified.
_ROOM = 1e-7


class Level(NamedTuple):
    """Nodes of a level: their centres, covering radii and sizes, and where
    the children of each lie in the next level (sorted by parent)."""

    centre: np.ndarray
    radius: np.ndarray
    size: np.ndarray
    first_child: np.ndarray


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def build_tree(unit: np.ndarray) -> tuple[list[Level], np.ndarray]:
    """Levels from the root down, and the points in the order of the leaves
    (the points below a node are consecutive)."""
    count = len(unit)
    owner = np.zeros(count, np.int64)  # centre of each point at this level
    away = _distances(unit, unit[:1])[:, 0]
    raw: list[tuple[np.ndarray, np.ndarray]] = [(owner.copy(), away.copy())]
    centres = [0]
    radius = 1.0
    while radius >= _FINEST:
        far = np.flatnonzero(away > radius)
        while len(far):
            new = int(far[0])
            centres.append(new)
            # A new centre takes points of its own parent only: the tree stays nested.
            near = _distances(unit, unit[new : new + 1])[:, 0]
            closer = (near < away) & (raw[-1][0] == raw[-1][0][new])
            owner[closer], away[closer] = new, near[closer]
            far = far[away[far] > radius]
        raw.append((owner.copy(), away.copy()))
        radius /= 2
    order = np.lexsort([o for o, _ in reversed(raw)])
    levels = []
    for depth, (owners, aways) in enumerate(raw):
        own = owners[order]
        start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        finer = raw[min(depth + 1, len(raw) - 1)][0][order]
        child = np.cumsum(np.append(True, finer[1:] != finer[:-1])) - 1
        levels.append(
            Level(
                own[start],
                np.maximum.reduceat(aways[order], start),
                np.diff(np.append(start, count)),
                np.append(child[start], child[-1] + 1),
            )
        )
    return levels, order


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (count[i] of them), one after the other."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _product(a_first, a_count, b_first, b_count) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of two spans, for each row."""
    left = _spans(a_first, a_count)
    times = np.repeat(b_count, a_count)
    return np.repeat(left, times), _spans(np.repeat(b_first, a_count), times)


def _pair_distances(x: np.ndarray, y: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Distances of centres u of x to centres v of y."""
    us, ui = np.unique(u, return_inverse=True)
    vs, vi = np.unique(v, return_inverse=True)
    if len(u) * 8 > len(us) * len(vs):
        return _distances(x[us], y[vs])[ui, vi]
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", x[u], y[v])))


def dual_traversal(a, b, threshold: float, same: bool):
    """Links between the points of two chunks ((raw vectors, tree) each).

    Returns counts of links by point of ``a`` and of ``b`` and edges (point of
    a, point of b) that connect what is linked. With ``same`` both are one
    chunk and a point is no link of itself.
    """
    (raw_a, unit_a, (levels_a, order_a)), (raw_b, unit_b, (levels_b, order_b)) = a, b
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    norm_a, norm_b = np.linalg.norm(raw_a, axis=1), np.linalg.norm(raw_b, axis=1)
    counts_a, counts_b = np.zeros(len(raw_a), np.int64), np.zeros(len(raw_b), np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    u = v = np.zeros(1, np.int64)
    for depth, (la, lb) in enumerate(zip(levels_a, levels_b, strict=True)):
        start_a = np.append(0, np.cumsum(la.size))
        start_b = np.append(0, np.cumsum(lb.size))
        d = _pair_distances(unit_a, unit_b, la.centre[u], lb.centre[v])
        cover = la.radius[u] + lb.radius[v]
        keep = d <= reach + cover + _ROOM
        u, v, d, cover = u[keep], v[keep], d[keep], cover[keep]
        whole = d + cover < reach - _ROOM
        if whole.any():
            uw, vw = u[whole], v[whole]
            add_a, add_b = np.zeros(len(la.size) + 1, np.int64), np.zeros(len(lb.size) + 1, np.int64)
            np.add.at(add_a, uw, lb.size[vw])
            np.add.at(add_b, vw, la.size[uw])
            counts_a[order_a] += np.repeat(add_a[:-1], la.size)
            counts_b[order_b] += np.repeat(add_b[:-1], lb.size)
            # Stars: all of u to the first of v, all of v to the first of u.
            edges.append((order_a[_spans(start_a[uw], la.size[uw])], order_b[np.repeat(start_b[vw], la.size[uw])]))
            edges.append((order_a[np.repeat(start_a[uw], lb.size[vw])], order_b[_spans(start_b[vw], lb.size[vw])]))
        u, v = u[~whole], v[~whole]
        if depth + 1 < len(levels_a):
            u, v = _product(
                la.first_child[u], la.first_child[u + 1] - la.first_child[u],
                lb.first_child[v], lb.first_child[v + 1] - lb.first_child[v],
            )
        else:
            for low in range(0, len(u), 4096):
                p, q = _product(
                    start_a[u[low : low + 4096]], la.size[u[low : low + 4096]],
                    start_b[v[low : low + 4096]], lb.size[v[low : low + 4096]],
                )
                p, q = order_a[p], order_b[q]
                for at in range(0, len(p), 1 << 18):
                    x, y = p[at : at + (1 << 18)], q[at : at + (1 << 18)]
                    cosine = np.einsum("ij,ij->i", raw_a[x], raw_b[y]) / (norm_a[x] * norm_b[y])
                    near = cosine >= threshold
                    x, y = x[near], y[near]
                    counts_a += np.bincount(x, minlength=len(raw_a))
                    counts_b += np.bincount(y, minlength=len(raw_b))
                    edges.append((x, y))
    if same:
        # Every ordered pair was found, and every point with itself.
        counts_a = counts_a - 1
    return counts_a, counts_b, edges


def _least_reachable(count: int, edges: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest point reachable from each."""
    label = np.arange(count)
    if not edges:
        return label
    x, y = (np.concatenate(side) for side in zip(*edges, strict=True))
    while True:
        least = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        label = label[label]
        if (label == before).all():
            return label


def _chunk_block(group: pa.Table) -> pa.Table:
    """One row per chunk: its ids and vectors, sorted by id."""
    ids = group.column("vec_id").to_numpy()
    order = np.argsort(ids)
    vectors = np.array(group.column("embedding").to_pylist(), dtype="<f8")[order]
    head = group.slice(0, 1).select(["label", "dims", "chunk", "chunks"])
    head = head.append_column("ids", pa.array([ids[order].astype("<i8").tobytes()], pa.binary()))
    return head.append_column("vectors", pa.array([vectors.tobytes()], pa.binary()))


def near_vectors(vectors: DataFrame, threshold: float, chunk: int = CHUNK) -> DataFrame:
    """Per linked vector and chunk pair: vec_id, links found there, and the
    smallest vec_id connected there (stored)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = vectors.where("vec_id is not null and label is not null and embedding is not null").where(
        finite & F.exists("embedding", lambda x: x != 0)
    )
    sound = sound.select("vec_id", "label", F.size("embedding").alias("dims"), "embedding")
    sizes = sound.groupBy("label", "dims").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    dealt = sound.join(sizes, ["label", "dims"]).withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks").cast("long")).cast("int")
    )
    label_type = dict(vectors.dtypes)["label"]
    blocks = dealt.groupBy("label", "dims", "chunk").applyInArrow(
        _chunk_block, f"label {label_type}, dims int, chunk int, chunks int, ids binary, vectors binary"
    )
    # A chunk goes to each pair that it is part of.
    paired = stored(blocks, "vector-chunks").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    paired = paired.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})

    def links(group: pa.Table) -> pa.Table:
        parts = []
        for row in group.sort_by("chunk").select(["ids", "vectors", "dims"]).to_pylist():
            raw = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dims"])
            scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
            unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
            parts.append((np.frombuffer(row["ids"], "<i8"), (scaled, unit, build_tree(unit))))
        same = len(parts) == 1
        (ids_a, a), (ids_b, b) = parts[0], parts[-1]
        counts_a, counts_b, edges = dual_traversal(a, b, threshold, same)
        if same:
            ids, counts, shift = ids_a, counts_a, 0
        else:
            ids, counts, shift = np.concatenate([ids_a, ids_b]), np.concatenate([counts_a, counts_b]), len(ids_a)
        # Points in the order of their ids, so that the smallest point has the smallest id.
        rank = np.empty(len(ids), np.int64)
        by_id = np.argsort(ids, kind="stable")
        rank[by_id] = np.arange(len(ids))
        label = _least_reachable(len(ids), [(rank[x], rank[y + shift]) for x, y in edges])
        linked = np.flatnonzero(counts > 0)
        return pa.table(
            {"vec_id": ids[linked], "n": counts[linked], "root": ids[by_id][label[rank[linked]]]},
            schema=pa.schema([("vec_id", pa.int64()), ("n", pa.int64()), ("root", pa.int64())]),
        )

    found = paired.groupBy("label", "dims", "i", "j").applyInArrow(links, "vec_id long, n long, root long")
    return stored(found, "vector-links")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id and kept of all ``vectors`` (vec_id,
    label, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    single = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v"))
    single = single.select("vec_id", "v.label", "v.embedding")
    found = near_vectors(single, threshold, chunk)
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    roots = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    ids = rows.select("vec_id").where("vec_id is not null").distinct().union(rows.select("vec_id").where("vec_id is null"))
    return (
        ids.join(counts, "vec_id", "left")
        .join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("root", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine of 0.98 or more within a label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


OP5_SQL = """
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
    WITH RECURSIVE r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a)
    SELECT a, min(b) AS root FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN reach ON reach.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
