"""Joint fit of haplotype phase and regression, trait by trait.

The posterior of a haplotype pair is taken proportional to its prior times
the normal density of the trait given the pair (Lake et al. 2003, Hum.
Hered. 55:56-65).

Individuals are shuffled once: sorted by (group, genotype pattern) they are cut
into blocks, one row each, that hold the traits and covariates of at most
``BLOCK_ROWS`` individuals of one pattern and, once, the pattern's haplotype
pairs. A round sends the models' coefficients and haplotype frequencies to the
blocks as a broadcast; each task weighs the pairs of its blocks for all traits
at once and emits one vector of sums per model, and one small solve per model
follows. Nothing per individual moves or is sorted in a round. Models that have
settled leave the loop; they go through it in lots whose state stays below
``STATE_BYTES``. Standard errors come from Louis' information, which subtracts
what the unknown phase hides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.operators.glm import (
    _GROUP_DDL,
    GROUP,
    ModelFit,
    Responses,
    _cell_frame,
    _finish_models,
    _intercept_shift,
    _join_subjects,
    inverse_by_sweep,
    tidy_coefficients,
)
from locusframe.session import broadcast_if_small, materialize, tasks_for

MODEL = [*GROUP, "y_index"]
_MODEL_DDL = f"{_GROUP_DDL}, y_index int"
TOLERANCE = 1e-6
MAX_ROUNDS = 200
# Individuals of a block, and bytes of the models' state broadcast at a time.
BLOCK_ROWS, STATE_BYTES = 2048, 32 * 1024 * 1024
# Largest number of doubles of one array of weights or scores.
_BLOCK = 4_000_000
# Model groups whose sums one task holds before it hands them on.
_HELD_GROUPS = 16


def _pair_terms(fit: ModelFit) -> DataFrame:
    """The pairs of each pattern as arrays: haplotype indexes ``a1`` and ``a2``
    and term positions ``t1`` and ``t2``; the base has position 0. Their
    length is bounded by the trimming of pairs (1 / min_pp)."""
    position = fit.pooled.join(fit.terms.select(*GROUP, "term", "position"), [*GROUP, "term"], "left")
    named = position.select(
        *GROUP, "hap", F.col("hap_index").cast("int"), F.coalesce("position", F.lit(0)).alias("position")
    )
    pairs = fit.haplotypes.pairs.select(*GROUP, "pattern", "h1", "h2")
    for side in ("1", "2"):
        pairs = pairs.join(
            named.withColumnsRenamed(
                {"hap": f"h{side}", "hap_index": f"a{side}", "position": f"t{side}"}
            ),
            [*GROUP, f"h{side}"],
        )
    parts = ("a1", "a2", "t1", "t2")
    packed = pairs.groupBy(*GROUP, "pattern").agg(F.collect_list(F.struct(*parts)).alias("_p"))
    return materialize(packed.select(*GROUP, "pattern", *[F.col(f"_p.{c}").alias(c) for c in parts]), "pair-terms")


def _cut_blocks(size: int):
    """Sorted individuals to block rows; ``y`` and ``c`` hold the values of one
    individual after another."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, part in batch.groupby([*GROUP, "pattern"], sort=False):
                for at in range(0, len(part), size):
                    some = part.iloc[at : at + size]
                    y, c = np.concatenate(some["y"].to_list()), np.concatenate(some["c"].to_list())
                    rows.append([*key, len(some), y, c])
            yield pd.DataFrame(rows, columns=[*GROUP, "pattern", "n", "y", "c"])

    return cut


def subject_blocks(genotypes: DataFrame, responses: Responses, fit: ModelFit, size: int = BLOCK_ROWS) -> DataFrame:
    """Stored blocks: the only shuffle of individuals. A pattern that very many
    share is spread over tasks, as the individual is part of the sort key; the
    number of tasks follows that of the individuals."""
    subjects = _join_subjects(genotypes, responses.rows).select(*GROUP, "pattern", "iid", "y", "c")
    order = [*GROUP, "pattern", "iid"]
    cohorts = responses.traits.select("dataset", "cohort").distinct().count()
    tasks = tasks_for(genotypes.sparkSession, genotypes.count() * cohorts)
    ranged = subjects.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("iid")
    blocks = ranged.mapInPandas(_cut_blocks(size), f"{_GROUP_DDL}, pattern string, n int, y array<double>, c array<double>")
    return materialize(blocks.join(broadcast_if_small(_pair_terms(fit)), [*GROUP, "pattern"]), "joint-blocks")


@dataclass
class _Pairs:
    """Pairs of a block: haplotypes, term counts and number of ways."""

    a1: np.ndarray
    a2: np.ndarray
    h: np.ndarray
    ways: np.ndarray


def _pairs(row, terms: int) -> _Pairs:
    a1, a2 = np.asarray(row.a1, dtype=int), np.asarray(row.a2, dtype=int)
    h = np.zeros((len(a1), terms))
    h[:, 0] = 1.0
    for t in (np.asarray(row.t1, dtype=int), np.asarray(row.t2, dtype=int)):
        inside = np.flatnonzero(t > 0)
        h[inside, t[inside]] += 1.0
    return _Pairs(a1, a2, h, np.where(a1 == a2, 1.0, 2.0))


@dataclass
class _Models:
    """State of the models of one group: one row per trait in each array."""

    y_index: np.ndarray
    beta: np.ndarray
    sigma2: np.ndarray
    f: np.ndarray

    @classmethod
    def of(cls, models) -> "_Models":
        return cls(
            np.array([m["y_index"] for m in models], dtype=int),
            np.array([m["beta"] for m in models], dtype=float),
            np.array([m["sigma2"] for m in models], dtype=float),
            np.array([m["f"] for m in models], dtype=float),
        )


def _values(row, models: _Models) -> tuple[np.ndarray, np.ndarray]:
    """Traits of the models and covariates of a block's individuals."""
    y = np.asarray(row.y, dtype=float).reshape(row.n, -1)[:, models.y_index]
    return y, np.asarray(row.c, dtype=float).reshape(row.n, -1)


def _weights(pairs: _Pairs, models: _Models, part: slice, y: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors and residuals by trait, individual and pair."""
    beta, f = models.beta[part], models.f[part]
    m = pairs.h.shape[1]
    offset = (y[:, part] - c @ beta[:, m:].T).T
    residual = offset[:, :, None] - (beta[:, :m] @ pairs.h.T)[:, None, :]
    prior = np.log(np.maximum(pairs.ways * f[:, pairs.a1 - 1] * f[:, pairs.a2 - 1], 1e-300))
    log_w = prior[:, None, :] - residual**2 / (2 * models.sigma2[part])[:, None, None]
    w = np.exp(log_w - log_w.max(axis=2, keepdims=True))
    return w / w.sum(axis=2, keepdims=True), residual


def _block_sums(row, models: _Models) -> np.ndarray:
    """One vector per trait: weighted X'X, X'y, y'y and haplotype copies."""
    y, c = _values(row, models)
    traits, p = models.beta.shape
    pairs = _pairs(row, p - c.shape[1])
    m, n_haps = pairs.h.shape[1], models.f.shape[1]
    out = np.zeros((traits, p * p + p + 1 + n_haps))
    step = max(1, _BLOCK // (len(y) * len(pairs.a1)))
    for at in range(0, traits, step):
        part = slice(at, at + step)
        w, _ = _weights(pairs, models, part, y, c)
        per_pair = w.sum(axis=1)
        xx = np.empty((len(w), p, p))
        xx[:, :m, :m] = np.matmul(pairs.h.T, per_pair[:, :, None] * pairs.h)
        xx[:, :m, m:] = np.matmul(pairs.h.T, np.matmul(w.transpose(0, 2, 1), c))
        xx[:, m:, :m] = xx[:, :m, m:].transpose(0, 2, 1)
        xx[:, m:, m:] = c.T @ c
        weighed = np.matmul(y[:, part].T[:, None, :], w)[:, 0, :]
        copies = np.zeros((n_haps, len(w)))
        np.add.at(copies, pairs.a1 - 1, per_pair.T)
        np.add.at(copies, pairs.a2 - 1, per_pair.T)
        out[part, : p * p] = xx.reshape(len(w), -1)
        out[part, p * p : p * p + m] = weighed @ pairs.h
        out[part, p * p + m : p * p + p] = (c.T @ y[:, part]).T
        out[part, p * p + p] = (y[:, part] ** 2).sum(axis=0)
        out[part, p * p + p + 1 :] = copies.T
    return out


def _round_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the blocks of a task, one row per model."""
    held: dict[tuple, list] = {}

    def release() -> Iterator[pd.DataFrame]:
        for key, (models, sums) in held.items():
            rows = [[*key, int(y), s, b] for y, s, b in zip(models.y_index, sums, models.beta)]
            yield pd.DataFrame(rows, columns=[*MODEL, "sums", "old"])
        held.clear()

    for batch in batches:
        for row in batch.itertuples(index=False):
            key = tuple(getattr(row, c) for c in GROUP)
            if key not in held:
                if len(held) >= _HELD_GROUPS:
                    yield from release()
                held[key] = [_Models.of(row.models), 0.0]
            held[key][1] = held[key][1] + _block_sums(row, held[key][0])
    yield from release()


_STATE = f"{_MODEL_DDL}, n double, rank int, beta array<double>, sigma2 double, f array<double>, settled boolean"


def _solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """New state of one model from the sums of the tasks."""
    sums, old = np.sum(rows["sums"].to_list(), axis=0), np.asarray(rows["old"].iloc[0])
    p = len(old)
    xx, xy, yy = sums[: p * p].reshape(p, p), sums[p * p : p * p + p], sums[p * p + p]
    inverse, used = inverse_by_sweep(xx)
    beta = inverse @ xy
    n, rank = xx[0, 0], int(used.sum())
    sigma2 = max((yy - beta @ xy) / (n - rank), 1e-300)
    scale = np.sqrt(sigma2 * np.diag(inverse))
    change = (np.abs(beta - old) / (np.abs(beta) + scale + 1e-300)).max()
    row = [*key, n, rank, beta, sigma2, sums[p * p + p + 1 :] / (2 * n), bool(change < TOLERANCE)]
    return pd.DataFrame([row], columns=[*MODEL, "n", "rank", "beta", "sigma2", "f", "settled"])


def _with_models(blocks: DataFrame, state: DataFrame) -> DataFrame:
    """Blocks beside the state of their group's models, which is broadcast: a
    lot is formed so that it fits."""
    packed = state.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("y_index", "beta", "sigma2", "f"))).alias("models"))
    return blocks.join(F.broadcast(packed), GROUP)


def _lots(state: DataFrame, state_bytes: int) -> tuple[DataFrame, int]:
    """``state`` with ``lot``, and the number of lots: models, dealt by hash,
    whose state stays near ``state_bytes`` together."""
    size = state.agg(F.sum(8 * (F.size("beta") + F.size("f")) + 64)).first()[0] or 0
    lots = max(1, -(-int(size) // state_bytes))
    return state.withColumn("lot", F.pmod(F.xxhash64(*MODEL), F.lit(lots))), lots


def _settled(blocks: DataFrame, state: DataFrame) -> DataFrame:
    """Rounds over one lot until every model has settled."""
    done: list[DataFrame] = []
    for _ in range(MAX_ROUNDS):
        sums = _with_models(blocks, state).mapInPandas(_round_sums, f"{_MODEL_DDL}, sums array<double>, old array<double>")
        moved = materialize(sums.groupBy(*MODEL).applyInPandas(_solve, _STATE), "joint-state")
        done.append(moved.filter("settled"))
        state = moved.filter("not settled")
        if state.isEmpty():
            out = done[0]
            for part in done[1:]:
                out = out.unionByName(part)
            return out.drop("settled")
    raise RuntimeError("joint fit did not settle")


def fit_joint(
    genotypes: DataFrame,
    responses: Responses,
    fit: ModelFit,
    block_rows: int = BLOCK_ROWS,
    state_bytes: int = STATE_BYTES,
) -> DataFrame:
    """Coefficients of the joint fit, started from ``fit``."""
    blocks = subject_blocks(genotypes, responses, fit, block_rows)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("hap_index").cast("int").alias("i"), F.col("freq").alias("f"))))
    freqs = fit.pooled.groupBy(*GROUP).agg(ordered.alias("_f")).select(*GROUP, F.col("_f.f").alias("f"))
    state = fit.models.select(
        *MODEL, F.col("centred").alias("beta"), (F.col("rss") / F.col("df_residual")).alias("sigma2")
    ).join(freqs, GROUP)
    state, lots = _lots(materialize(state, "state"), state_bytes)
    found, spread = [], []
    for lot in range(lots):
        settled = materialize(_settled(blocks, state.filter(F.col("lot") == lot).drop("lot")), "joint-models")
        found.append(settled)
        spread.append(_with_models(blocks, settled).mapInPandas(_information_cells, _CELL_DDL))
    for more, cells in zip(found[1:], spread[1:]):
        found[0], spread[0] = found[0].unionByName(more), spread[0].unionByName(cells)
    summed = spread[0].groupBy(*MODEL, "kind", "i", "j").agg(F.sum("s").alias("s"))
    return _louis(summed, found[0], responses, fit)


def _information(pairs: _Pairs, models: _Models, t: int, y: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Observed information of trait ``t`` over [coefficients, haplotypes of the
    block], and the haplotype indexes of the last part."""
    part, sigma2 = slice(t, t + 1), models.sigma2[t]
    w, residual = (x[0] for x in _weights(pairs, models, part, y, c))
    haps, local = np.unique(np.concatenate([pairs.a1, pairs.a2]), return_inverse=True)
    n_pairs, m = pairs.h.shape
    p = m + c.shape[1]
    f = models.f[t][haps - 1]
    counts = np.zeros((n_pairs, len(haps)))
    for side in (local[:n_pairs], local[n_pairs:]):
        counts[np.arange(n_pairs), side] += 1.0
    per_pair = w.sum(axis=0)
    total = np.zeros((p + len(haps), p + len(haps)))
    total[:m, :m] = (pairs.h * per_pair[:, None]).T @ pairs.h
    total[:m, m:p] = pairs.h.T @ (w.T @ c)
    total[m:p, :m] = total[:m, m:p].T
    total[m:p, m:p] = c.T @ c
    total[:p, :p] /= sigma2
    total[range(p, len(total)), range(p, len(total))] = per_pair @ (counts / f**2)
    if n_pairs == 1:
        return total, haps
    size = max(1, _BLOCK // (n_pairs * len(total)))
    for at in range(0, len(y), size):
        some = slice(at, at + size)
        v, r, cs = w[some], residual[some] / sigma2, c[some]
        score = np.concatenate(
            [
                r[:, :, None] * pairs.h[None, :, :],
                r[:, :, None] * cs[:, None, :],
                np.broadcast_to(counts / f, (len(v), n_pairs, len(haps))),
            ],
            axis=2,
        )
        mean = (v[:, :, None] * score).sum(axis=1)
        flat = (np.sqrt(v)[:, :, None] * score).reshape(-1, score.shape[2])
        total -= flat.T @ flat - mean.T @ mean
    return total, haps


def _information_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Information cells of a batch of blocks; haplotype rows are numbered
    -index."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            models = _Models.of(row.models)
            y, c = _values(row, models)
            pairs = _pairs(row, models.beta.shape[1] - c.shape[1])
            for t, y_index in enumerate(models.y_index):
                total, haps = _information(pairs, models, t, y, c)
                p = len(total) - len(haps)
                index = np.concatenate([np.arange(p), -haps])
                i, j = np.triu_indices(len(total))
                key = (*[getattr(row, g) for g in GROUP], int(y_index))
                yield _cell_frame(MODEL, key, [(np.full(len(i), "info"), index[i], index[j], total[i, j])])


_CELL_DDL = f"{_MODEL_DDL}, kind string, i int, j int, s double"


def _louis(cells: DataFrame, state: DataFrame, responses: Responses, fit: ModelFit) -> DataFrame:
    """Coefficients with standard errors from the summed information."""
    means = responses.means

    def variances(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        p = int(part["i"].max()) + 1
        haps = np.unique(-part.loc[part["j"] < 0, "j"].to_numpy())
        place = {h: p + k for k, h in enumerate(haps)}
        total = np.zeros((p + len(haps), p + len(haps)))
        i = np.array([v if v >= 0 else place[-v] for v in part["i"]])
        j = np.array([v if v >= 0 else place[-v] for v in part["j"]])
        total[i, j] = part["s"]
        total[j, i] = part["s"]
        # Frequencies sum to one: the last haplotype is the dependent one.
        free = np.zeros((p + len(haps) - 1, p + len(haps)))
        free[:, :-1] = np.eye(p + len(haps) - 1)
        free[p:, -1] = -1.0
        inverse, used = inverse_by_sweep(free @ total @ free.T)
        variance = np.diag(inverse)[:p].copy()
        shift = _intercept_shift(p, means)
        variance[0] = shift @ inverse[:p, :p] @ shift
        return pd.DataFrame(
            [[*key, np.where(used[:p], variance, np.nan)]], columns=[*MODEL, "variance"]
        )

    spread = cells.groupBy(*MODEL).applyInPandas(variances, f"{_MODEL_DDL}, variance array<double>")
    models = state.select(*MODEL, "n", "rank", F.col("beta").alias("centred"), F.lit(0.0).alias("rss")).join(
        spread, MODEL
    )
    finished = _finish_models(models, responses)
    # The variances carry the dispersion already.
    finished = finished.withColumn("rss", F.col("df_residual").cast("double"))
    joint = ModelFit(fit.haplotypes, fit.pooled, fit.terms, materialize(finished, "joint-models"))
    return tidy_coefficients(joint, responses.covariates)
