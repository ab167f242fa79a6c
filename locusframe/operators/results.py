"""Harmonised haplotype names, tidy and significant results, distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.functions.labels import pad_haplotype_label, significant
from locusframe.session import broadcast_if_small, materialize

MODEL = ["locus", "dataset"]
REFERENCE = "Ref."
RARE = "Hrare"

# Traits of a block: a task computes the distances of two blocks at a time.
TRAIT_BLOCK = 128
# Bytes of the blocks that are broadcast together, and pairs of blocks that a
# task computes.
LOT_BYTES, TASK_PAIRS = 32 * 1024 * 1024, 500

# Non-haplotype terms as older result files name them (fixed pattern).
LEGACY_TERM_PATTERN = "(Intercept)|PC|Sex|Age|rare"


def drop_rare(haplotypes: DataFrame, column: str = "haplotype") -> DataFrame:
    return haplotypes.filter(F.col(column) != RARE)


def drop_reference(rows: DataFrame, column: str = "haplo") -> DataFrame:
    return rows.filter(F.col(column) != REFERENCE)


def term_exclude(coefficients: DataFrame, by_name: bool = False) -> DataFrame:
    """Haplotype terms only: by their kind, or by name as older files need."""
    if by_name:
        return coefficients.filter(~F.rlike("term", F.lit(LEGACY_TERM_PATTERN)))
    return coefficients.filter(F.col("term_kind") == "haplotype")


def nominal_significance(rows: DataFrame, level: float = 0.05) -> DataFrame:
    return rows.withColumn("associated", significant(F.col("p_value"), level))


def per_trait(haplotypes: DataFrame, traits: DataFrame) -> DataFrame:
    """Haplotype rows of a cohort repeated for each of its traits."""
    return haplotypes.join(traits.select("dataset", "cohort", "trait_pos", "trait_name"), ["dataset", "cohort"])


def trait_order(haplotypes: DataFrame) -> list[str]:
    """Columns that traits are ordered by: their place in the phenotype table
    if the rows carry it, then their name."""
    return [c for c in ("trait_pos", "trait_name") if c in haplotypes.columns]


def signature(alleles: Column) -> Column:
    return F.concat_ws("_", F.split(alleles, ""))


def haplotype_dictionary(haplotypes: DataFrame) -> DataFrame:
    """(locus, dataset, trait_name, haplotype, haplo): the same allele vector
    gets the same name H1, H2, ... in every trait, in order of appearance
    (traits in their order, then rows); the base stays "Ref.".

    Numbering needs one row per distinct vector, at most a few hundred per
    locus and dataset, whatever the number of traits.
    """
    common = drop_rare(haplotypes).withColumn("_sig", signature(F.col("alleles")))
    seen = (
        common.filter(F.col("haplotype") != REFERENCE)
        .groupBy(*MODEL, "_sig")
        .agg(F.min(F.struct(*trait_order(common), "hap_pos")).alias("_first"))
    )
    order = Window.partitionBy(*MODEL).orderBy("_first")
    names = seen.select(
        *MODEL, "_sig", F.concat(F.lit("H"), F.row_number().over(order).cast("string")).alias("_name")
    )
    haplo = F.when(F.col("haplotype") == REFERENCE, F.lit(REFERENCE)).otherwise(F.col("_name"))
    return common.join(names, [*MODEL, "_sig"], "left").select(
        *MODEL, "trait_name", "haplotype", haplo.alias("haplo")
    )


def distinct_haplotypes(haplotypes: DataFrame) -> DataFrame:
    return haplotypes.select(*MODEL, signature(F.col("alleles")).alias("signature")).distinct()


def haplotype_identity_check(haplotypes: DataFrame) -> DataFrame:
    """Whether a haplotype name means the same alleles in every trait."""
    return haplotypes.groupBy(*MODEL, "haplotype").agg(
        (F.min("alleles") == F.max("alleles")).alias("identical")
    )


def haplotype_right_join(coefficients: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Results of the dictionary's haplotypes; those without a coefficient
    (the reference) come with null effects."""
    effects = (
        term_exclude(nominal_significance(coefficients))
        .withColumn("haplotype", pad_haplotype_label(F.col("term")))
        .select(
            *MODEL, "trait_name", "haplotype", "estimate", "std_error", "statistic", "p_value", "associated"
        )
    )
    return effects.join(dictionary, [*MODEL, "trait_name", "haplotype"], "right")


def result_order(rows: DataFrame) -> DataFrame:
    """By haplotype name in byte order (H1, H10, H2), then p-value."""
    return rows.orderBy(*MODEL, "haplo", F.col("p_value").asc_nulls_last(), "trait_name")


def tidied_results(joined: DataFrame) -> DataFrame:
    return result_order(
        drop_reference(joined).select(
            *MODEL, "trait_name", "haplo", "estimate", "std_error", "statistic", "p_value"
        )
    )


def significant_results(joined: DataFrame) -> DataFrame:
    return result_order(
        joined.filter(F.col("associated") == "Yes").select(
            *MODEL, "trait_name", "haplo", "estimate", "std_error", "p_value", "associated"
        )
    )


def several_haplotypes(tidied: DataFrame) -> DataFrame:
    """Rows of models with more than one haplotype."""
    several = tidied.groupBy(*MODEL).agg((F.count_distinct("haplo") > 1).alias("_several")).filter("_several")
    return tidied.join(broadcast_if_small(several.select(*MODEL)), MODEL, "left_semi")


def effect_distance(tidied: DataFrame, item: str = "haplo", along: str = "trait_name") -> DataFrame:
    """Euclidean distance between every two rows of the effect matrix (or,
    with the arguments exchanged, every two columns).

    A missing effect leaves its column out and the sum is scaled up in
    proportion. Matching is by equal (locus, dataset, ``along``), where a
    haplotype name occurs once and names number at most 1 / min_freq. Between
    traits (``item="trait_name"``) the join grows with the square of a model's
    traits: ``trait_distance`` is for many. A model with a single haplotype has
    no distances on either side.
    """
    tidied = several_haplotypes(tidied)
    cells = tidied.filter(F.col("estimate").isNotNull()).select(*MODEL, item, along, "estimate")
    width = tidied.groupBy(*MODEL).agg(F.count_distinct(along).alias("_width"))
    left = cells.withColumnsRenamed({item: "first", "estimate": "_a"})
    right = cells.withColumnsRenamed({item: "second", "estimate": "_b"})
    pairs = left.join(right, [*MODEL, along]).filter(F.col("first") < F.col("second"))
    gap = F.pow(F.col("_a") - F.col("_b"), F.lit(2.0))
    return (
        pairs.groupBy(*MODEL, "first", "second")
        .agg(F.sum(gap).alias("_sum"), F.count("*").alias("_used"))
        .join(width, MODEL)
        .select(
            *MODEL, "first", "second",
            F.sqrt(F.col("_sum") * F.col("_width") / F.col("_used")).alias("distance"),
        )
    )


def _cut_traits(size: int):
    """Sorted traits to blocks: names of traits and haplotypes, effects by trait
    and haplotype one after another, and which of them are given."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            for key, part in rows.groupby(MODEL, sort=False):
                for at in range(0, len(part), size):
                    some = part.iloc[at : at + size]
                    places = {name: i for i, name in enumerate(sorted({x for names in some.haplos for x in names}))}
                    effects = np.zeros((len(some), len(places)))
                    given = np.zeros(effects.shape, dtype=bool)
                    for i, (names, values) in enumerate(zip(some.haplos, some.effects)):
                        own = [places[x] for x in names]
                        effects[i, own], given[i, own] = values, True
                    columns = [*key, some.trait_name.to_list(), list(places), effects.ravel(), given.ravel()]
                    yield pa.RecordBatch.from_arrays([pa.array([c]) for c in columns], names=[*MODEL, "names", "haplos", "effects", "given"])

    return cut


def _block_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances of the traits of two blocks, each pair of traits once."""

    def half(row: dict, side: str) -> tuple:
        names, haplos = row[f"{side}_names"], row[f"{side}_haplos"]
        shape = len(names), len(haplos)
        return (
            pa.array(names, pa.string()), haplos,
            np.array(row[f"{side}_effects"], dtype=float).reshape(shape), np.array(row[f"{side}_given"], dtype=bool).reshape(shape),
        )

    for batch in batches:
        for at in range(batch.num_rows):
            (row,) = batch.slice(at, 1).to_pylist()
            names, haplos, effects, given = half(row, "low")
            others, other_haplos, other_effects, other_given = half(row, "high")
            gaps, used = np.zeros((len(names), len(others))), np.zeros((len(names), len(others)), dtype=int)
            there = {name: i for i, name in enumerate(other_haplos)}
            for i, name in enumerate(haplos):
                if name in there:
                    j = there[name]
                    both = given[:, i, None] & other_given[None, :, j]
                    gaps += np.where(both, (effects[:, i, None] - other_effects[None, :, j]) ** 2, 0.0)
                    used += both
            some = np.triu(used, 1) if row["low"] == row["high"] else used
            first, second = np.nonzero(some)
            far = np.sqrt(gaps[first, second] * row["width"] / used[first, second])
            model = [pa.repeat(pa.scalar(row[c], pa.string()), len(far)) for c in MODEL]
            yield pa.RecordBatch.from_arrays(
                [*model, names.take(pa.array(first)), others.take(pa.array(second)), pa.array(far)], names=[*MODEL, "first", "second", "distance"]
            )


def trait_blocks(tidied: DataFrame, block: int) -> DataFrame:
    """Stored blocks of at most ``block`` traits of a model, in the order of
    their names: ``block``, ``names``, ``haplos``, ``effects``, ``given`` and
    ``width``, the number of the model's haplotypes."""
    rows = several_haplotypes(materialize(tidied.select(*MODEL, "trait_name", "haplo", "estimate"), "effects"))
    width = rows.groupBy(*MODEL).agg(F.count_distinct("haplo").alias("width"))
    traits = (
        rows.filter(F.col("estimate").isNotNull() & F.col("trait_name").isNotNull() & F.col("haplo").isNotNull())
        .groupBy(*MODEL, "trait_name")
        .agg(F.collect_list("haplo").alias("haplos"), F.collect_list("estimate").alias("effects"))
    )
    order = [*MODEL, "trait_name"]
    ranged = traits.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{c} string" for c in MODEL) + ", names array<string>, haplos array<string>, effects array<double>, given array<boolean>"
    blocks = ranged.mapInArrow(_cut_traits(block), schema).withColumn("block", F.monotonically_increasing_id())
    return materialize(materialize(blocks, "trait-blocks").join(F.broadcast(width), MODEL), "trait-blocks")


def trait_distance(
    tidied: DataFrame, block: int = TRAIT_BLOCK, lot_bytes: int = LOT_BYTES, task_pairs: int = TASK_PAIRS
) -> DataFrame:
    """``effect_distance`` between the traits of each model, for many traits.

    A trait is one row with its effects (at most 1 / min_freq of them). Traits
    are sorted and cut into blocks, one row each; every block meets those from
    itself on, which are broadcast in lots of about ``lot_bytes``, and a task
    computes the distances of two blocks as one array. So no trait is copied on
    disk or shuffled for the blocks it meets, and a task holds two blocks.
    The result has a row per pair of traits of a model that share a haplotype
    with effects in both; NaN effects give NaN. Null traits and haplotypes have
    no distances. The number of pairs is the square of a model's traits.
    """
    blocks = trait_blocks(tidied, block)
    counts = blocks.groupBy(*MODEL).agg(
        F.count("*").alias("n"), F.sum(9 * F.size("effects") + 32 * (F.size("names") + F.size("haplos"))).alias("bytes")
    )
    size = counts.agg(F.sum(F.col("n") * (F.col("n") + 1) / 2).alias("pairs"), F.sum("bytes").alias("bytes")).first()
    lots, tasks = max(1, -(-int(size.bytes or 0) // lot_bytes)), max(1, -(-int(size.pairs or 0) // task_pairs))
    parts = ("block", "names", "haplos", "effects", "given")
    low = blocks.select(*MODEL, "width", F.col("block").alias("low"), *[F.col(c).alias(f"low_{c}") for c in parts[1:]])
    high = blocks.select(*MODEL, F.col("block").alias("high"), *[F.col(c).alias(f"high_{c}") for c in parts[1:]])
    dealt = low.repartition(tasks, "low")
    lot = F.pmod(F.xxhash64("high"), F.lit(lots))
    schema = ", ".join(f"{c} string" for c in MODEL) + ", first string, second string, distance double"
    found = [
        dealt.join(F.broadcast(high.filter(lot == number)), MODEL).filter(F.col("low") <= F.col("high")).mapInArrow(_block_distances, schema)
        for number in range(lots)
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
