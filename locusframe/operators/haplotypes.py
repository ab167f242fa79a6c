"""Haplotype frequencies by EM with progressive insertion of sites.

Individuals with the same genotypes are counted once (``pattern``, ``n``).
Haplotype pairs are enumerated a batch of sites at a time, the EM runs to
convergence, and pairs below ``min_pp`` are trimmed before the next batch,
which keeps the pairs of a pattern within a few times 1 / min_pp.

All groups (loci, cohorts) and all restarts move through the batches
together as ordinary key columns, one Spark job per batch. Within a batch

* a group of at most ``GROUP_ROWS`` pair rows iterates inside one task, so
  thousands of loci run side by side without a shuffle per iteration;
* a larger group is shuffled once into blocks of patterns; a step sends the
  frequencies to the blocks and sums up haplotype copies (``em_blocks``).

Both ways compute the same numbers. The driver sees row counts only.

A haplotype is a string of allele codes, one character per site: 1 = REF,
2 = ALT. Genotype patterns hold 0/1/2 copies of ALT, ``.`` for missing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from locusframe.config import Thresholds
from locusframe.functions.labels import pad_haplotype_label
from locusframe.operators.em_blocks import STEPS_PER_ROUND, expected_copies, posteriors, settle_blocks, trimmed
from locusframe.session import broadcast_if_small, materialize

SEED = 777
TOLERANCE = 1e-7
MAX_ROUNDS = 1000
# Largest number of pair rows of a group that one task takes.
GROUP_ROWS = 200_000
# Attempts within this of the best log-likelihood are as good as it.
CLOSE = 1e-4


@dataclass
class HaplotypeFit:
    """haplotypes: keys, hap, freq. pairs: keys, pattern, n, h1, h2, post.
    starts: keys, attempt, loglik, chosen."""

    keys: list[str]
    haplotypes: DataFrame
    pairs: DataFrame
    starts: DataFrame


def genotype_patterns(genotypes: DataFrame, keys: list[str]) -> DataFrame:
    """Identical genotype vectors counted once, with map-side combine."""
    return genotypes.groupBy(*keys, "pattern").agg(F.count("*").alias("n"))


def _phase_options(call: Column, same: Column) -> Column:
    """Allele pairs to append for one site; each unordered pair only once."""

    def pairs(*codes: str) -> Column:
        return F.array(
            *[F.struct(F.lit(c[0]).alias("a"), F.lit(c[1]).alias("b")) for c in codes]
        )

    return (
        F.when(call == "0", pairs("11"))
        .when(call == "2", pairs("22"))
        .when((call == "1") & same, pairs("12"))
        .when(call == "1", pairs("12", "21"))
        .when((call == ".") & same, pairs("11", "12", "22"))
        .when(call == ".", pairs("11", "12", "21", "22"))
        .otherwise(F.array(F.struct(F.lit("").alias("a"), F.lit("").alias("b"))))
    )


def insert_sites(pairs: DataFrame, first: int, count: int) -> DataFrame:
    """Extend every pair by the sites ``first .. first + count - 1``, sharing
    its posterior evenly. Pairs stay distinct and ordered (h1 <= h2): once
    the two strings differ their order is settled, and while they are equal
    only ordered extensions are made."""
    for site in range(first, first + count):
        options = _phase_options(F.substring("pattern", site + 1, 1), F.col("h1") == F.col("h2"))
        rest = [c for c in pairs.columns if c not in ("h1", "h2", "post")]
        pairs = (
            pairs.withColumn("_options", options)
            .select(
                *rest, "h1", "h2", (F.col("post") / F.size("_options")).alias("post"),
                F.explode("_options").alias("_o"),
            )
            .select(
                *rest,
                F.concat("h1", "_o.a").alias("h1"),
                F.concat("h2", "_o.b").alias("h2"),
                "post",
            )
        )
    return pairs


def diplotype_expand(patterns: DataFrame, keys: list[str], n_sites: int) -> DataFrame:
    """All haplotype pairs consistent with each pattern, without trimming.
    Doubles with each heterozygous site: for short regions only."""
    start = patterns.select(
        *keys, "pattern", "n", F.lit("").alias("h1"), F.lit("").alias("h2"), F.lit(1.0).alias("post")
    )
    return insert_sites(start, 0, n_sites).drop("post")


def _uniform(*parts: Column) -> Column:
    """Reproducible number in (0, 1) from row content, not from partitions."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1_000_003)) + 1) / F.lit(1_000_004.0)


def _sides(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per pair and distinct haplotype with its number of copies."""
    one = F.array(F.struct(F.col("h1").alias("h"), F.lit(2).alias("copies")))
    two = F.array(
        F.struct(F.col("h1").alias("h"), F.lit(1).alias("copies")),
        F.struct(F.col("h2").alias("h"), F.lit(1).alias("copies")),
    )
    return pairs.select(*keep, F.inline(F.when(F.col("h1") == F.col("h2"), one).otherwise(two)))


def _totals(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Number of individuals of each group."""
    counted = pairs.groupBy(*group, "pattern").agg(F.first("n").alias("n"))
    return counted.groupBy(*group).agg(F.sum("n").alias("_total"))


def _frequencies(pairs: DataFrame, group: list[str], totals: DataFrame) -> DataFrame:
    """M step from stored posteriors: expected copies over 2 N."""
    copies = _sides(pairs, [*group, "n", "post"]).groupBy(*group, "h").agg(
        F.sum(F.col("n") * F.col("post") * F.col("copies")).alias("c")
    )
    return copies.join(totals, group).select(*group, "h", (F.col("c") / (2 * F.col("_total"))).alias("f"))


def _settle_group(max_haps: float, min_pp: float):
    """Grouped-map function: EM to convergence, posteriors, trimming."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        pattern, _ = pd.factorize(rows["pattern"])
        hap, names = pd.factorize(pd.concat([rows["h1"], rows["h2"]], ignore_index=True))
        if len(names) > max_haps:
            raise ValueError(f"{len(names)} candidate haplotypes in one group exceed {max_haps:g}")
        a, b = hap[: len(rows)], hap[len(rows):]
        n = rows["n"].to_numpy(float)
        post = rows["post"].to_numpy(float)
        post = post / np.bincount(pattern, post)[pattern]
        copies = 2.0 * (n / np.bincount(pattern)[pattern]).sum()
        f_old = np.zeros(len(names))
        for step in range(MAX_ROUNDS * STEPS_PER_ROUND + 1):
            f = expected_copies(a, b, n * post, len(names)) / copies
            post, like = posteriors(f, a, b, pattern)
            # Tested where the steps on blocks are tested: after each round.
            if step and step % STEPS_PER_ROUND == 0 and np.abs(f - f_old).max() < TOLERANCE:
                break
            f_old = f
        else:
            raise RuntimeError("haplotype frequencies did not settle")
        keep, post = trimmed(post, pattern, min_pp)
        return rows.drop(columns="post")[keep].assign(post=post, _sum=like[pattern[keep]])

    return settle


def _settle(
    grown: DataFrame, group: list[str], limits: Thresholds, group_rows: int, rows: int
) -> DataFrame:
    """Trimmed posteriors of every group at convergence."""
    fields = [*group, "pattern", "n", "h1", "h2", "post"]
    schema = StructType([grown.schema[f] for f in fields] + [StructField("_sum", DoubleType())])
    in_task = _settle_group(limits.max_haps, limits.min_pp)
    if rows <= group_rows:
        return grown.select(*fields).groupBy(*group).applyInPandas(in_task, schema)
    sizes = materialize(grown.groupBy(*group).agg(F.count("*").alias("_rows")), "sizes")
    fits = sizes.filter(F.col("_rows") <= group_rows).select(*group)
    wide = sizes.filter(F.col("_rows") > group_rows).select(*group)
    small = (
        grown.select(*fields).join(fits, group, "left_semi").groupBy(*group).applyInPandas(in_task, schema)
    )
    if wide.isEmpty():
        return small
    large = grown.select(*fields).join(wide, group, "left_semi")
    return small.unionByName(settle_blocks(large, group, limits, schema, TOLERANCE, MAX_ROUNDS))


def em_haplotypes(
    patterns: DataFrame,
    keys: list[str],
    limits: Thresholds = Thresholds(),
    seed: int = SEED,
    group_rows: int = GROUP_ROWS,
) -> HaplotypeFit:
    """Estimate haplotype frequencies and pair posteriors of every group.

    The first attempt starts from equal shares. Further ones perturb the
    start of each batch with numbers hashed from (seed, attempt, row); the
    attempt with the best likelihood wins, the earlier one on a tie.
    """
    group = [*keys, "attempt"]
    attempts = F.sequence(F.lit(1), F.lit(int(limits.n_try)))
    pairs = patterns.select(
        *keys, F.explode(attempts).alias("attempt"), "pattern", "n",
        F.lit("").alias("h1"), F.lit("").alias("h2"), F.lit(1.0).alias("post"),
        F.lit(1.0).alias("_sum"),
    )
    finished: list[DataFrame] = []
    first, batch = 0, int(limits.n_batch)
    while True:
        # One job per batch: the previous batch settles, the next is inserted.
        grown, rows, n_sites = _grow(pairs, group, first, batch, limits, seed)
        # Rows whose last site was in before this batch are final.
        finished.append(grown.filter(F.length("pattern") <= first).drop("pair"))
        growing = grown.filter(F.length("pattern") > first)
        pairs = _settle(growing, group, limits, group_rows, rows)
        first += batch
        if first >= n_sites:
            break
    final = materialize(pairs, "settled")
    for more in finished[1:]:
        final = final.unionByName(more)
    return _choose(final, keys)


def _grow(
    pairs: DataFrame, group: list[str], first: int, count: int, limits: Thresholds, seed: int
) -> tuple[DataFrame, int, int]:
    """Stored pairs after inserting a batch of sites, their number and the
    number of sites of the longest pattern."""
    grown = insert_sites(pairs, first, count)
    if limits.n_try > 1:
        draw = F.when(F.col("attempt") == 1, F.lit(1.0)).otherwise(
            _uniform(F.lit(seed), F.col("attempt"), F.col("pattern"), F.col("h1"), F.col("h2"))
        )
        draw = F.when(F.length("pattern") > first, draw).otherwise(F.lit(1.0))
        # The shares of a pattern are scaled to 1 where they are used.
        grown = grown.withColumn("post", F.col("post") * draw)
    size = Observation()
    stored = materialize(
        grown.withColumn("pair", F.monotonically_increasing_id()).observe(
            size, F.count("*").alias("rows"), F.max(F.length("pattern")).alias("sites")
        ),
        "pairs",
    )
    return stored, size.get["rows"], size.get["sites"] or 0


def _choose(final: DataFrame, keys: list[str]) -> HaplotypeFit:
    """Best attempt of each group, its pairs and haplotype frequencies."""
    group = [*keys, "attempt"]
    by_pattern = final.groupBy(*group, "pattern").agg(
        F.first("n").alias("n"), F.first("_sum").alias("like")
    )
    fits = by_pattern.groupBy(*group).agg(F.sum(F.col("n") * F.log("like")).alias("loglik"))
    # At most ``n_try`` rows of a group meet here. The earliest attempt within
    # a tolerance of the best wins.
    every = Window.partitionBy(*keys)
    close = F.col("loglik") >= F.max("loglik").over(every) - CLOSE
    first = F.min(F.when(F.col("_close"), F.col("attempt"))).over(every)
    starts = fits.withColumn("_close", close).withColumn("chosen", F.col("attempt") == first).drop("_close")
    starts = materialize(starts, "attempts")
    winner = broadcast_if_small(starts.filter("chosen").select(*group))
    pairs = materialize(final.join(winner, group).select(*keys, "pattern", "n", "h1", "h2", "post"), "posteriors")
    haplotypes = _frequencies(pairs, keys, _totals(pairs, keys))
    return HaplotypeFit(
        keys, haplotypes.select(*keys, F.col("h").alias("hap"), F.col("f").alias("freq")), pairs, starts
    )


def pool_and_base(haplotypes: DataFrame, keys: list[str], min_freq: float) -> DataFrame:
    """Add index, kind (base / haplotype / rare), term and label.

    Haplotypes rarer than ``min_freq`` share the term "rare"; the most
    frequent one is the base. The index is the rank among all haplotypes of
    the group in string order.
    """
    by_freq = Window.partitionBy(*keys).orderBy(F.desc("freq"), "hap")
    by_name = Window.partitionBy(*keys).orderBy("hap")
    kind = (
        F.when(F.col("_rank") == 1, "base")
        .when(F.col("freq") < min_freq, "rare")
        .otherwise("haplotype")
    )
    term = (
        F.when(F.col("kind") == "base", F.lit("haplo.base"))
        .when(F.col("kind") == "rare", F.lit("haplo_genotype.rare"))
        .otherwise(F.concat(F.lit("haplo_genotype."), F.col("hap_index").cast("string")))
    )
    return (
        haplotypes.withColumn("_rank", F.row_number().over(by_freq))
        .withColumn("hap_index", F.row_number().over(by_name))
        .withColumn("kind", kind)
        .withColumn("term", term)
        .withColumn("label", pad_haplotype_label(F.col("term")))
        .drop("_rank")
    )


def haplotype_terms(pooled: DataFrame, keys: list[str]) -> DataFrame:
    """Design terms of each group: haplotypes by index, then "rare".

    At most 1 / min_freq rows per group. ``position`` starts at 1, after the
    intercept; the base has no term.
    """
    terms = (
        pooled.filter(F.col("kind") != "base")
        .groupBy(*keys, "term", "label", "kind")
        .agg(F.min("hap_index").alias("hap_index"))
    )
    order = Window.partitionBy(*keys).orderBy((F.col("kind") == "rare").cast("int"), "hap_index")
    return terms.withColumn("position", F.row_number().over(order)).drop("hap_index")


def haplotype_table(pooled: DataFrame, keys: list[str]) -> DataFrame:
    """Haplotypes of each model: label, alleles, frequency. The rare ones are
    one row with ``*`` at every site; the base comes last."""
    rows = pooled.groupBy(*keys, "label", "kind", F.when(F.col("kind") != "rare", F.col("hap")).alias("hap")).agg(
        F.sum("freq").alias("hap_freq"), F.first(F.length("hap")).alias("_sites"),
        F.min("hap_index").alias("_index"),
    )
    alleles = F.coalesce("hap", F.repeat(F.lit("*"), F.col("_sites")))
    last = F.when(F.col("kind") == "base", 2).when(F.col("kind") == "rare", 1).otherwise(0)
    order = Window.partitionBy(*keys).orderBy(last, "_index")
    return rows.select(
        *keys, F.row_number().over(order).alias("hap_pos"),
        F.col("label").alias("haplotype"), alleles.alias("alleles"), "hap_freq",
    )


def pattern_copies(fit: HaplotypeFit, pooled: DataFrame) -> DataFrame:
    """Expected copies of each term for each genotype pattern: a property of
    the pattern, so it is computed once however many individuals share it."""
    sides = _sides(fit.pairs, [*fit.keys, "pattern", "post"]).withColumnRenamed("h", "hap")
    named = sides.join(
        pooled.select(*fit.keys, "hap", "term", "label", "kind"), [*fit.keys, "hap"]
    )
    return named.groupBy(*fit.keys, "pattern", "term", "label", "kind").agg(
        F.sum(F.col("post") * F.col("copies")).alias("copies")
    )


def haplotype_design(genotypes: DataFrame, copies: DataFrame, keys: list[str]) -> DataFrame:
    """Expected copies per individual and non-base term."""
    return genotypes.join(copies.filter(F.col("kind") != "base"), [*keys, "pattern"]).select(
        *keys, "iid", "label", "copies"
    )
