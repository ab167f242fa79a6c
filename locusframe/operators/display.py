"""The haplotype table as it is shown: alleles, annotation, differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.functions.genotype import differs_from_reference, is_snp, shown_allele
from locusframe.functions.keys import (
    position_key,
    position_key_from_snp_id,
    position_key_from_variant,
)
from locusframe.functions.labels import axis_label, blank_to_label, clean_consequence, clean_snp_label
from locusframe.operators.reshape import haplotype_unpivot
from locusframe.operators.results import MODEL, REFERENCE, drop_rare, haplotype_dictionary, trait_order
from locusframe.session import broadcast_if_small


def first_trait(haplotypes: DataFrame) -> DataFrame:
    """Haplotypes of the first trait of each locus and dataset."""
    first = haplotypes.groupBy(*MODEL).agg(F.min_by("trait_name", F.struct(*trait_order(haplotypes))).alias("trait_name"))
    return haplotypes.join(first, [*MODEL, "trait_name"])


def example_haplotypes(haplotypes: DataFrame) -> DataFrame:
    """First trait, no rare row, harmonised names."""
    example = drop_rare(first_trait(haplotypes))
    names = haplotype_dictionary(example)
    return example.join(names, [*MODEL, "trait_name", "haplotype"]).select(
        *MODEL, "trait_name", F.col("haplo").alias("haplotype"), "hap_pos", "alleles"
    )


def display_annotation(summary: DataFrame, clean=clean_consequence) -> DataFrame:
    """locus, snpid, variant, annot, gene of the annotation summary."""
    return summary.select(
        "locus",
        position_key_from_variant(F.col("variant")).alias("snpid"),
        "variant",
        clean(F.col("most_severe_consequence")).alias("annot"),
        blank_to_label(F.col("gene_symbol")).alias("gene"),
    )


def allele_cells(haplotypes: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per shown haplotype and variant with its CHROM:POS key."""
    order = sites.select("locus", "snp_id", "site_index")
    cells = haplotype_unpivot(haplotypes, sites)
    return (
        cells.join(broadcast_if_small(order), ["locus", "snp_id"])
        .withColumn("snpid", position_key_from_snp_id(F.col("snp_id")))
    )


def annotation_left_join(cells: DataFrame, annotation: DataFrame) -> DataFrame:
    return cells.join(broadcast_if_small(annotation), ["locus", "snpid"], "left")


def frequency_left_join(cells: DataFrame, frequencies: DataFrame) -> DataFrame:
    keyed = frequencies.select(
        "locus", position_key(F.col("chrom"), F.col("pos")).alias("snpid"), "ref", "alt", "af"
    )
    return cells.join(broadcast_if_small(keyed), ["locus", "snpid"], "left")


def alleles_relabel(cells: DataFrame) -> DataFrame:
    """Swap REF/ALT and AF for code 2 and add the shown allele."""
    flip = F.col("code") == 2
    return (
        cells.withColumnsRenamed({"ref": "ref_org", "alt": "alt_org", "af": "af_org"})
        .withColumn("ref", F.when(flip, F.col("alt_org")).otherwise(F.col("ref_org")))
        .withColumn("alt", F.when(flip, F.col("ref_org")).otherwise(F.col("alt_org")))
        .withColumn("af", F.when(flip, 1 - F.col("af_org")).otherwise(F.col("af_org")))
        .withColumn(
            "allele",
            shown_allele(F.col("code"), F.col("ref_org"), F.col("alt_org"), F.col("af_org")),
        )
    )


def distinct_per_site(cells: DataFrame) -> DataFrame:
    """Distinct haplotypes and shown alleles (null counts as a value) per
    trait and site. A site has one row per common haplotype."""
    site = Window.partitionBy(*MODEL, "trait_name", "snpid")
    alleles = F.size(F.collect_set("allele").over(site)) + F.max(
        F.col("allele").isNull().cast("int")
    ).over(site)
    return (
        cells.withColumn("n_haplo", F.size(F.collect_set("haplotype").over(site)))
        .withColumn("n_allele", alleles)
        .withColumn("diallelic", F.when(F.col("n_allele") == 1, F.lit("")).otherwise(F.col("allele")))
        .withColumn("snp_label", clean_snp_label(F.col("snp_id")))
    )


def reference_self_join(cells: DataFrame) -> DataFrame:
    """Each cell beside the reference haplotype's code at the same site.

    Equal reference rows (several annotations of a site) are counted first,
    in ``ref_copies``, instead of being matched one by one: a plain
    many-to-many join would square the annotations of a site.
    """
    reference = (
        cells.filter(F.col("haplotype") == REFERENCE)
        .groupBy(
            *MODEL, "snpid",
            F.col("haplotype").alias("haplotype_ref"), F.col("code").alias("code_ref"),
        )
        .agg(F.count("*").alias("ref_copies"))
    )
    return cells.join(reference, [*MODEL, "snpid"], "left")


def mark_differences(cells: DataFrame) -> DataFrame:
    differs = differs_from_reference(F.col("code"), F.col("code_ref"))
    shown = (F.col("haplotype") == REFERENCE) | F.col("differs_ref")
    return cells.withColumn("differs_ref", differs).withColumn(
        "true_allele", F.when(shown, F.col("allele")).when(~shown, F.lit(""))
    )


def first_appearance_rank(rows: DataFrame, label: str, order: list[str], name: str) -> DataFrame:
    """1-based rank of each label by the first row it appears in."""
    firsts = rows.groupBy(*MODEL, label).agg(F.min(F.struct(*order)).alias("_at"))
    by_first = Window.partitionBy(*MODEL).orderBy("_at")
    ranks = firsts.select(*MODEL, label, F.row_number().over(by_first).alias(name))
    return rows.join(ranks, [*MODEL, label])


def axis_labels(cells: DataFrame) -> DataFrame:
    labelled = cells.withColumn("xlab_annot", axis_label(F.col("gene"), F.col("annot")))
    order = ["hap_pos", "site_index", "variant"]
    ranked = first_appearance_rank(labelled, "xlab_annot", order, "xlab_rank")
    return first_appearance_rank(ranked, "snp_label", order, "snp_rank")


def varying_filter(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("n_allele") == 2)


def shrink_varying_biallelic(cells: DataFrame) -> DataFrame:
    return varying_filter(cells).filter(is_snp(F.col("ref"), F.col("alt")))


def plot_counts(cells: DataFrame) -> DataFrame:
    """Numbers of haplotypes, sites, varying sites, varying biallelic sites."""
    varying = F.col("n_allele") == 2
    short = varying & is_snp(F.col("ref"), F.col("alt"))
    return cells.groupBy(*MODEL).agg(
        F.count_distinct("haplotype").alias("n_haplotypes"),
        F.count_distinct("snpid").alias("n_snps"),
        F.count_distinct(F.when(varying, F.col("snpid"))).alias("n_varying"),
        F.count_distinct(F.when(short, F.col("snpid"))).alias("n_varying_biallelic"),
    )


def display_table(
    haplotypes: DataFrame, sites: DataFrame, annotation: DataFrame, frequencies: DataFrame
) -> DataFrame:
    """The whole chain for the first trait of every locus and dataset."""
    cells = allele_cells(example_haplotypes(haplotypes), sites)
    cells = frequency_left_join(annotation_left_join(cells, annotation), frequencies)
    cells = distinct_per_site(alleles_relabel(cells))
    return axis_labels(mark_differences(reference_self_join(cells)))
