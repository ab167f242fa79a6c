"""Pivot, unpivot and nested-to-rows operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.genotype import round_dosage
from locusframe.session import TASK_ROWS, broadcast_if_small, spread
from locusframe.sources.tables import value_columns


def genotype_pivot(dosage: DataFrame, snp_ids: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Individuals by variants matrix of dosages for export; absent cells are
    null and a repeated (iid, variant) fails.

    Cells are dealt by individual first, to as many tasks as their number asks
    for: nothing could be combined before the shuffle, where a task would hold
    an entry for each cell it reads.
    """
    cell = F.when(
        F.count("dosage") > 1, F.raise_error(F.lit("repeated individual and variant"))
    ).otherwise(F.first("dosage", ignorenulls=True))
    dealt = spread(dosage.select("locus", "iid", "snp_id", "dosage"), "locus", "iid", task_rows=task_rows)
    return dealt.groupBy("locus", "iid").pivot("snp_id", snp_ids).agg(cell)


SITE_KEY = ["locus", "chrom", "pos", "ref", "alt"]


def site_dictionary(variants: DataFrame) -> DataFrame:
    """Variants of each locus (one row each, with snp_id) and their 0-based
    index in file order. A region's variants fit one row."""
    packed = variants.groupBy("locus").agg(
        F.array_sort(F.collect_set(F.struct("pos", "ref", "alt", "chrom", "snp_id"))).alias("sites")
    )
    return packed.select("locus", F.posexplode("sites").alias("site_index", "site")).select(
        "locus", "site_index", "site.snp_id", "site.chrom", "site.pos", "site.ref", "site.alt"
    )


# Sites per 64-bit word of packed genotypes, two bits each; the spare bits keep
# sums of repeated cells from wrapping around.
_WORD = 24
_MISSING = 3


def genotype_vectors(dosage: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per locus and individual with ``pattern``: one character per
    site in file order, 0/1/2 copies or ``.`` for missing.

    ``sites`` also selects the variants and is broadcast while small. Codes
    are packed two bits each and added up per word of 24 sites, so tasks
    combine a whole run of variants into one row per individual before the
    shuffle. A word whose presence bits add up to more than their union has
    a repeated (iid, variant), which fails. Absent sites read ``.``.
    """
    index = broadcast_if_small(sites.select(*SITE_KEY, "site_index"))
    copies = round_dosage(F.col("dosage"))
    code = F.when(copies.between(0, 2), copies).otherwise(F.lit(_MISSING)).cast("bigint")
    shift = (F.col("site_index") % _WORD * 2).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
    words = (
        dosage.select(*SITE_KEY, "iid", code.alias("code"))
        .join(index, SITE_KEY)
        .select(
            "locus", "iid", F.floor(F.col("site_index") / _WORD).cast("int").alias("word"),
            (F.col("code") * bit).alias("codes"), bit.alias("seen"),
        )
        .groupBy("locus", "iid", "word")
        .agg(F.sum("codes").alias("codes"), F.sum("seen").alias("added"), F.bit_or("seen").alias("seen"))
        .withColumn(
            "codes",
            F.when(F.col("added") == F.col("seen"), F.col("codes")).otherwise(
                F.raise_error(F.lit("repeated individual and variant"))
            ),
        )
    )
    people = words.groupBy("locus", "iid").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.struct("codes", "seen")))).alias("words")
    )

    def letter(i: Column) -> Column:
        word = F.col("words")[F.floor(i / _WORD).cast("int")]
        at = (i % _WORD * 2).cast("int")
        present = F.call_function("shiftright", word["seen"], at).bitwiseAND(1) == 1
        value = F.call_function("shiftright", word["codes"], at).bitwiseAND(3)
        return F.when(present & (value != _MISSING), value.cast("string")).otherwise(F.lit("."))

    sizes = sites.groupBy("locus").agg(F.count("*").cast("int").alias("n_sites"))
    pattern = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n_sites") - 1), letter), "")
    return people.join(broadcast_if_small(sizes), "locus").select("locus", "iid", pattern.alias("pattern"))


def trait_unpivot(phenotypes: DataFrame, keep: list[str] | None = None, position: str | None = None) -> DataFrame:
    """Trait columns to (trait_name, trait) rows; ``keep`` columns stay. With
    ``position``, a column of that name holds the trait's place in the file."""
    ids = ["iid", *(keep or [])]
    traits = [c for c in value_columns(phenotypes) if c not in ids]
    if position is None:
        return phenotypes.unpivot(ids, traits, "trait_name", "trait")
    cells = [F.struct(F.lit(t).alias("trait_name"), F.col(f"`{t}`").alias("trait")) for t in traits]
    long = phenotypes.select(*[f"`{c}`" for c in ids], F.posexplode(F.array(*cells)).alias(position, "_t"))
    return long.select(*[f"`{c}`" for c in ids], position, "_t.trait_name", "_t.trait")


def haplotype_unpivot(haplotypes: DataFrame, sites: DataFrame) -> DataFrame:
    """Haplotype rows to one row per variant with its allele code (1/2)."""
    keep = [c for c in haplotypes.columns if c != "alleles"]
    cells = haplotypes.select(
        *keep, F.posexplode(F.split("alleles", "")).alias("site_index", "code")
    ).withColumn("code", F.col("code").try_cast("int"))
    names = sites.select("locus", "site_index", "snp_id")
    return cells.join(names, ["locus", "site_index"]).drop("site_index")


def effect_matrix(tidied: DataFrame, traits: list[str]) -> DataFrame:
    """Haplotype by trait matrix of estimates; ``_`` reads ``:`` in names."""
    rows = tidied.filter(F.col("haplo") != "Ref.").withColumn(
        "trait_name", F.replace("trait_name", F.lit("_"), F.lit(":"))
    )
    shown = [t.replace("_", ":") for t in traits]
    keys = [k for k in ("locus", "dataset") if k in tidied.columns]
    return rows.groupBy(*keys, "haplo").pivot("trait_name", shown).agg(F.first("estimate"))


def nest_by(rows: DataFrame, keys: list[str], fields: list[str], name: str) -> DataFrame:
    """Rows of a group as one array of structs. For groups of bounded size,
    such as the coefficients of one model."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def unnest(nested: DataFrame, column: str) -> DataFrame:
    """Array of structs back to rows."""
    keep = [c for c in nested.columns if c != column]
    return nested.select(*keep, F.inline(column))
