"""Gaussian haplotype models of all traits at once.

Work per individual is one pass of small matrix products inside the task
that holds the row; tasks emit sums of products ("cells"), Spark adds the
cells up, and one p x p inverse per model group remains. Traits observed on
the same individuals form a cohort and share the design part, so a group is
(locus, dataset, cohort), however many traits it has.

Covariates and traits are centred first; the intercept and its variance are
moved back afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from locusframe.config import Thresholds
from locusframe.functions.student import t_two_sided
from locusframe.operators.haplotypes import (
    HaplotypeFit,
    em_haplotypes,
    genotype_patterns,
    haplotype_terms,
    pattern_copies,
    pool_and_base,
)
from locusframe.session import broadcast_if_small, materialize
from locusframe.sources.tables import value_columns

GROUP = ["locus", "dataset", "cohort"]
_GROUP_DDL = "locus string, dataset string, cohort string"
# Model groups whose sums one task holds before it hands them on.
_HELD_GROUPS = 16
# Most individuals (by cohort) whose traits are broadcast.
BROADCAST_ROWS = 200_000


@dataclass
class Responses:
    """rows: dataset, cohort, iid, y array, c array (both centred).
    traits: dataset, cohort, y_index, trait_pos, trait_name, y_mean."""

    rows: DataFrame
    traits: DataFrame
    covariates: list[str]
    means: list[float]


@dataclass
class ModelFit:
    haplotypes: HaplotypeFit
    pooled: DataFrame
    terms: DataFrame
    models: DataFrame


#: Most levels of a text covariate.
MAX_LEVELS = 100


def covariate_design(covariates: DataFrame) -> tuple[DataFrame, list[str]]:
    """Complete rows as design columns, and their terms.

    Numbers are one column each. A text covariate is a factor: one 0/1 column
    for each level but the first in sorted order, named by covariate and level.
    """
    given = value_columns(covariates)
    complete = covariates.dropna("any", subset=given)
    text = [f.name for f in covariates.schema if f.name in given and isinstance(f.dataType, StringType)]
    columns: dict[str, Column] = {}
    for name in given:
        if name not in text:
            columns[name] = F.col(f"`{name}`").cast("double")
            continue
        levels = [r[0] for r in complete.select(f"`{name}`").distinct().limit(MAX_LEVELS + 1).collect()]
        if len(levels) > MAX_LEVELS:
            raise ValueError(f"covariate {name} has more than {MAX_LEVELS} levels")
        for level in sorted(levels)[1:]:
            columns[f"{name}{level}"] = (F.col(f"`{name}`") == level).cast("double")
    return complete.select("iid", *[c.alias(n) for n, c in columns.items()]), list(columns)


def prepare_responses(traits: DataFrame, covariates: DataFrame | None) -> Responses:
    """Long traits (dataset, iid, trait_name, trait) to one row per
    individual and cohort. Rows with a missing trait or covariate drop out.
    ``trait_pos`` is the order of the traits; without it, they go by name.

    Cohorts are found by an order-free fingerprint of the individuals with a
    value. This pass does not depend on the loci.
    """
    present = traits.filter(F.col("trait").isNotNull())
    if "trait_pos" not in present.columns:
        present = present.withColumn("trait_pos", F.lit(0))
    names: list[str] = []
    means: list[float] = []
    if covariates is not None:
        complete, names = covariate_design(covariates)
        row = complete.agg(*[F.avg(f"`{c}`").alias(c) for c in names]).first()
        if names and row[names[0]] is None:
            raise ValueError("no individual has a value of every covariate")
        means = [float(row[c]) for c in names]
        vector = F.array(*[F.col(f"`{c}`").cast("double") - m for c, m in zip(names, means)])
        present = present.join(complete.select("iid", vector.alias("c")), "iid")
    else:
        present = present.withColumn("c", F.array().cast("array<double>"))
    ids = F.col("iid")
    cohort = F.concat_ws(
        ":", F.count("*").cast("string"),
        F.hex(F.bit_xor(F.xxhash64(ids))), F.hex(F.bit_xor(F.xxhash64(F.lit(1), ids))),
    )
    found = present.groupBy("dataset", "trait_name").agg(
        cohort.alias("cohort"), F.avg("trait").alias("y_mean"), F.min("trait_pos").alias("trait_pos")
    )
    order = Window.partitionBy("dataset", "cohort").orderBy("trait_name")
    found = materialize(found.withColumn("y_index", F.row_number().over(order) - 1), "traits")
    values = F.array_sort(
        F.collect_list(F.struct("y_index", (F.col("trait") - F.col("y_mean")).alias("v")))
    )
    rows = (
        present.drop("trait_pos").join(broadcast_if_small(found), ["dataset", "trait_name"])
        .groupBy("dataset", "cohort", "iid")
        .agg(F.transform(values, lambda s: s["v"]).alias("y"), F.first("c").alias("c"))
    )
    return Responses(materialize(rows, "responses"), found, names, means)


def _join_subjects(genotypes: DataFrame, responses: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Individuals of every locus with their traits; the trait side is
    broadcast while it is small, so that loci stay where they are. Beyond
    ``most`` rows both sides are shuffled: packed files of either may look
    small to the planner, whose broadcast would pass all rows to the driver."""
    if responses.count() <= most:
        return genotypes.join(broadcast_if_small(responses), "iid")
    return genotypes.join(responses.hint("merge"), "iid")


def pattern_design(fit: HaplotypeFit, pooled: DataFrame, terms: DataFrame) -> DataFrame:
    """Expected copies per genotype pattern as array ``x`` in term order."""
    keys = fit.keys
    copies = pattern_copies(fit, pooled).join(
        terms.select(*keys, "term", "position"), [*keys, "term"], "left"
    )
    sizes = terms.groupBy(*keys).agg(F.count("*").cast("int").alias("_k"))
    # Entries of the base have no position and fall out of the filter.
    entries = F.collect_list(F.when(F.col("position").isNotNull(), F.struct("position", "copies")))
    packed = copies.groupBy(*keys, "pattern").agg(F.map_from_entries(entries).alias("_m"))
    x = F.when(
        F.col("_k") > 0,
        F.transform(
            F.sequence(F.lit(1), F.col("_k")),
            lambda i: F.coalesce(F.col("_m")[i], F.lit(0.0)),
        ),
    ).otherwise(F.array().cast("array<double>"))
    return (
        packed.join(sizes, keys, "left")
        .withColumn("_k", F.coalesce("_k", F.lit(0)))
        .select(*keys, "pattern", x.alias("x"))
    )


def _triangle(kind: str, block: np.ndarray) -> tuple[np.ndarray, ...]:
    i, j = np.triu_indices(block.shape[0])
    return np.full(len(i), kind), i, j, block[i, j]


def _rectangle(kind: str, block: np.ndarray) -> tuple[np.ndarray, ...]:
    i, j = np.indices(block.shape)
    return np.full(i.size, kind), i.ravel(), j.ravel(), block.ravel()


def _cell_frame(columns: list[str], key: tuple, parts: list[tuple]) -> pd.DataFrame:
    kind, i, j, s = (np.concatenate(x) for x in zip(*parts))
    frame = pd.DataFrame({"kind": kind, "i": i.astype("int32"), "j": j.astype("int32"), "s": s})
    for position, (name, value) in enumerate(zip(columns, key)):
        frame.insert(position, name, value)
    return frame


def _partial_gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of products of the rows of a task, per model group."""
    held: dict[tuple, list[np.ndarray]] = {}

    def release() -> Iterator[pd.DataFrame]:
        for key, (xx, xy, yy) in held.items():
            yy_index = np.arange(len(yy))
            parts = [
                _triangle("xx", xx),
                _rectangle("xy", xy),
                (np.full(len(yy), "yy"), yy_index, yy_index, yy),
            ]
            yield _cell_frame(GROUP, key, parts)
        held.clear()

    for batch in batches:
        for key, rows in batch.groupby(GROUP, sort=False):
            one = np.ones((len(rows), 1))
            z = np.hstack([one, np.vstack(rows["x"]), np.vstack(rows["c"])])
            y = np.vstack(rows["y"])
            sums = [z.T @ z, z.T @ y, (y * y).sum(axis=0)]
            if key in held:
                held[key] = [a + b for a, b in zip(held[key], sums)]
            else:
                if len(held) >= _HELD_GROUPS:
                    yield from release()
                held[key] = sums
    yield from release()


def gram_cells(subjects: DataFrame, design: DataFrame) -> DataFrame:
    """(kind, i, j, s) sums of X'X, X'Y and the squares of Y per group."""
    rows = subjects.join(broadcast_if_small(design), [*GROUP, "pattern"]).select(*GROUP, "x", "c", "y")
    partial = rows.sortWithinPartitions(*GROUP).mapInPandas(
        _partial_gram, f"{_GROUP_DDL}, kind string, i int, j int, s double"
    )
    return partial.groupBy(*GROUP, "kind", "i", "j").agg(F.sum("s").alias("s"))


def inverse_by_sweep(a: np.ndarray, tolerance: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of a symmetric matrix and the mask of usable columns.

    Columns that depend on earlier ones are left out (their rows are 0).
    """
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    m = a / np.outer(scale, scale)
    used = np.zeros(len(a), dtype=bool)
    for k in range(len(a)):
        pivot = m[k, k]
        if pivot <= tolerance:
            continue
        used[k] = True
        column = m[:, k].copy()
        m = m - np.outer(column, column) / pivot
        m[k, :] = m[:, k] = column / pivot
        m[k, k] = -1.0 / pivot
    inverse = np.where(np.outer(used, used), -m, 0.0) / np.outer(scale, scale)
    return inverse, used


def _square(rows: pd.DataFrame) -> np.ndarray:
    size = int(rows["j"].max()) + 1
    a = np.zeros((size, size))
    a[rows["i"], rows["j"]] = rows["s"]
    a[rows["j"], rows["i"]] = rows["s"]
    return a


def _intercept_shift(size: int, means: list[float]) -> np.ndarray:
    """Row vector that turns centred coefficients into the intercept."""
    shift = np.zeros(size)
    shift[0] = 1.0
    if means:
        shift[size - len(means):] = -np.asarray(means)
    return shift


def _invert_groups(cells: DataFrame, keys: list[str], keys_ddl: str, means: list[float]) -> DataFrame:
    """n, rank, inverse (flat) and coefficient variances (without sigma^2)."""

    def invert(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a = _square(rows)
        inverse, used = inverse_by_sweep(a)
        variance = np.diag(inverse).copy()
        shift = _intercept_shift(len(a), means)
        variance[0] = shift @ inverse @ shift
        return pd.DataFrame(
            [[*key, a[0, 0], int(used.sum()), inverse.ravel(), np.where(used, variance, np.nan)]],
            columns=[*keys, "n", "rank", "inverse", "variance"],
        )

    ddl = f"{keys_ddl}, n double, rank int, inverse array<double>, variance array<double>"
    return cells.filter(F.col("kind") == "xx").groupBy(*keys).applyInPandas(invert, ddl)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)


def solve_cells(cells: DataFrame, means: list[float]) -> DataFrame:
    """Coefficients and residual sum of squares of every trait."""
    xy = F.array_sort(F.collect_list(F.when(F.col("kind") == "xy", F.struct("i", "s"))))
    sums = (
        cells.filter(F.col("kind") != "xx")
        .groupBy(*GROUP, F.col("j").alias("y_index"))
        .agg(
            F.transform(xy, lambda s: s["s"]).alias("xy"),
            F.max(F.when(F.col("kind") == "yy", F.col("s"))).alias("yy"),
        )
    )
    inverse = _invert_groups(cells, GROUP, _GROUP_DDL, means)
    p = F.size("xy")
    beta = F.transform(
        F.sequence(F.lit(0), p - 1),
        lambda i: _dot(F.slice("inverse", i * p + 1, p), F.col("xy")),
    )
    solved = sums.join(inverse, GROUP).withColumn("centred", beta)
    return solved.select(
        *GROUP, "y_index", "n", "rank", "centred", "variance",
        (F.col("yy") - _dot(F.col("centred"), F.col("xy"))).alias("rss"),
        (F.col("yy") - F.col("xy")[0] * F.col("xy")[0] / F.col("n")).alias("null_deviance"),
    )


def haplotype_models(
    genotypes: DataFrame,
    responses: Responses,
    limits: Thresholds = Thresholds(),
) -> ModelFit:
    """Fit every trait of every dataset on the haplotypes of every locus.

    genotypes: locus, iid, pattern. Haplotypes are estimated on the
    individuals a cohort has, once per cohort.
    """
    members = responses.rows.select("dataset", "cohort", "iid")
    patterns = genotype_patterns(_join_subjects(genotypes, members), GROUP)
    fit = em_haplotypes(patterns, GROUP, limits)
    pooled = materialize(pool_and_base(fit.haplotypes, GROUP, limits.min_freq), "pooled")
    terms = haplotype_terms(pooled, GROUP)
    design = materialize(pattern_design(fit, pooled, terms), "design")
    cells = materialize(gram_cells(_join_subjects(genotypes, responses.rows), design), "cells")
    models = _finish_models(solve_cells(cells, responses.means), responses)
    return ModelFit(fit, pooled, terms, materialize(models, "models"))


def _finish_models(solved: DataFrame, responses: Responses) -> DataFrame:
    """Trait names, residual df and the intercept on the original scale."""
    named = solved.join(broadcast_if_small(responses.traits), ["dataset", "cohort", "y_index"])
    k = len(responses.means)
    shift = F.lit(0.0)
    for offset, mean in enumerate(responses.means):
        shift = shift + F.element_at("centred", offset - k) * mean
    intercept = F.col("y_mean") + F.col("centred")[0] - shift
    beta = F.concat(F.array(intercept), F.slice("centred", 2, F.size("centred")))
    return named.withColumn("beta", beta).withColumn(
        "df_residual", (F.col("n") - F.col("rank")).cast("bigint")
    )


def tidy_coefficients(fit: ModelFit, covariates: list[str]) -> DataFrame:
    """term, estimate, std_error, statistic, p_value of every model."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "term", "kind")))
    haps = fit.terms.groupBy(*GROUP).agg(ordered.alias("_haps"))
    empty = F.array().cast("array<struct<position:int,term:string,kind:string>>")

    def entry(term: str, kind: str) -> Column:
        return F.struct(F.lit(term).alias("term"), F.lit(kind).alias("kind"))

    tail = F.array(*[entry(c, "covariate") for c in covariates]) if covariates else F.array().cast(
        "array<struct<term:string,kind:string>>"
    )
    middle = F.transform(
        F.coalesce("_haps", empty), lambda s: F.struct(s["term"].alias("term"), s["kind"].alias("kind"))
    )
    names = F.concat(F.array(entry("(Intercept)", "intercept")), middle, tail)
    sigma2 = F.col("rss") / F.col("df_residual")
    rows = fit.models.join(haps, GROUP, "left").select(
        *GROUP, "trait_name", "df_residual", sigma2.alias("_s2"),
        F.posexplode(F.arrays_zip(names.alias("t"), F.col("beta"), F.col("variance"))).alias("_i", "_z"),
    )
    usable = F.col("_z.variance").isNotNull() & ~F.isnan("_z.variance")
    out = rows.select(
        *GROUP, "trait_name", F.col("_z.t.term").alias("term"), F.col("_z.t.kind").alias("term_kind"),
        F.when(usable, F.col("_z.beta")).alias("estimate"),
        F.when(usable, F.sqrt(F.col("_s2") * F.col("_z.variance"))).alias("std_error"),
        "df_residual",
    )
    return with_p_values(out)


def with_p_values(rows: DataFrame) -> DataFrame:
    statistic = F.when(F.col("std_error") > 0, F.col("estimate") / F.col("std_error"))
    return rows.withColumn("statistic", statistic).withColumn(
        "p_value", t_two_sided("statistic", F.col("df_residual").cast("double"))
    )


def model_glance(fit: ModelFit) -> DataFrame:
    """One row of fit statistics per model."""
    n, rss = F.col("n"), F.col("rss")
    log_lik = -n / 2 * (F.log(2 * math.pi * rss / n) + 1)
    params = F.col("rank") + 1
    return fit.models.select(
        *GROUP, "trait_name", "null_deviance",
        (n - 1).cast("bigint").alias("df_null"),
        log_lik.alias("log_lik"),
        (-2 * log_lik + 2 * params).alias("aic"),
        (-2 * log_lik + F.log(n) * params).alias("bic"),
        rss.alias("deviance"),
        "df_residual",
        n.cast("bigint").alias("nobs"),
    )
