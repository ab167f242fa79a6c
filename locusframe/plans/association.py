"""Dosage rows and trait tables to tidy haplotype associations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.config import Thresholds
from locusframe.operators.glm import (
    GROUP,
    ModelFit,
    Responses,
    haplotype_models,
    prepare_responses,
    tidy_coefficients,
)
from locusframe.operators.haplotypes import haplotype_table
from locusframe.operators.joint import fit_joint
from locusframe.operators.reshape import genotype_vectors, site_dictionary, trait_unpivot
from locusframe.operators.results import haplotype_dictionary, haplotype_right_join, per_trait
from locusframe.operators.variants import (
    allele_count_band_filter,
    allele_count_derive,
    locus_profile,
    non_variant_select,
    profile_counts,
    profile_variants,
    sample_counts,
    variant_column_select,
)
from locusframe.session import materialize


@dataclass
class Association:
    sites: DataFrame
    genotypes: DataFrame
    responses: Responses
    fit: ModelFit
    coefficients: DataFrame
    haplotypes: DataFrame
    dictionary: DataFrame
    results: DataFrame
    profile: DataFrame


def kept_variants(dosage: DataFrame, min_ac: float) -> DataFrame:
    """Dosage rows of the variants inside the allele count band."""
    counts = sample_counts(dosage)
    return allele_count_band_filter(allele_count_derive(dosage, counts), min_ac)


def banded_variants(profile: DataFrame, min_ac: float, frequencies: DataFrame | None = None) -> DataFrame:
    """Variants inside the allele count band, one row each.

    The band is a property of the variant, so it is decided on one row per
    variant: on ``frequencies`` (locus, chrom, pos, ref, alt, af) when that
    table is at hand, else on the variants of the profile.
    """
    if frequencies is None:
        variants = profile_variants(profile)
    else:
        variants = frequencies.select("locus", "chrom", "pos", "ref", "alt", "af").distinct()
    return allele_count_band_filter(allele_count_derive(variants, profile_counts(profile)), min_ac)


def kept_sites(
    dosage: DataFrame, min_ac: float, frequencies: DataFrame | None = None, profile: DataFrame | None = None
) -> DataFrame:
    """Indexed sites of the haplotypes: inside the band, with a genotype
    column name (numbered chromosome, plain alleles)."""
    profile = locus_profile(dosage) if profile is None else profile
    banded = banded_variants(profile, min_ac, frequencies)
    return materialize(site_dictionary(variant_column_select(banded, "snp_id")), "sites")


def rejected_variants(
    dosage: DataFrame, min_ac: float, frequencies: DataFrame | None = None, profile: DataFrame | None = None
) -> DataFrame:
    """Variants inside the band whose name keeps them out of the haplotypes
    (such as those of chromosome X), counted per locus."""
    profile = locus_profile(dosage) if profile is None else profile
    banded = banded_variants(profile, min_ac, frequencies)
    return non_variant_select(banded, "snp_id").groupBy("locus").agg(F.count("*").alias("n_rejected"))


def long_traits(phenotypes: dict[str, DataFrame]) -> DataFrame:
    """Wide phenotype tables of all datasets as one long table, in which
    ``trait_pos`` is a trait's place among the columns of its table."""
    parts = [
        trait_unpivot(table, position="trait_pos").withColumn("dataset", F.lit(name))
        for name, table in sorted(phenotypes.items())
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_association(
    dosage: DataFrame,
    phenotypes: dict[str, DataFrame],
    covariates: DataFrame | None,
    limits: Thresholds = Thresholds(),
    frequencies: DataFrame | None = None,
    joint: bool = False,
) -> Association:
    """All loci and datasets in one go; see ``Association`` for the parts.

    With ``joint``, coefficients come from the joint fit of phase and
    regression; else the posteriors of the haplotype estimation stay fixed.
    """
    profile = locus_profile(dosage)
    sites = kept_sites(dosage, limits.min_ac, frequencies, profile)
    genotypes = materialize(genotype_vectors(dosage, sites), "genotypes")
    responses = prepare_responses(long_traits(phenotypes), covariates)
    fit = haplotype_models(genotypes, responses, limits)
    tidy = fit_joint(genotypes, responses, fit) if joint else tidy_coefficients(fit, responses.covariates)
    coefficients = materialize(tidy, "coefficients")
    haplotypes = per_trait(haplotype_table(fit.pooled, GROUP), responses.traits)
    dictionary = haplotype_dictionary(haplotypes)
    results = haplotype_right_join(coefficients, dictionary)
    return Association(
        sites, genotypes, responses, fit, coefficients, haplotypes, dictionary, results, profile
    )
