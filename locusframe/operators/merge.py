"""Joins of genotypes with traits and covariates, merge counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.operators.variants import (
    allele_count_band_filter,
    allele_count_derive,
    locus_profile,
    profile_counts,
    profile_variants,
)


def genotype_phenotype_join(genotypes: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """Inner join by individual; Catalyst picks the strategy by size."""
    return genotypes.join(phenotypes, "iid")


def covariate_join(merged: DataFrame, covariates: DataFrame | None) -> DataFrame:
    """Inner join by individual, or nothing when covariates are off."""
    return merged if covariates is None else merged.join(covariates, "iid")


def model_terms(haplotypes: list[str], covariates: list[str], rare: bool) -> list[tuple[str, str]]:
    """Ordered (term, kind) list of the design ``trait ~ haplotypes + covariates``."""
    terms = [("(Intercept)", "intercept")]
    terms += [(h, "haplotype") for h in haplotypes]
    terms += [("rare", "rare")] if rare else []
    return terms + [(c, "covariate") for c in covariates]


def merged_counts(
    dosage: DataFrame,
    min_ac: float,
    trait_counts: dict[str, int],
    n_covariates: int | None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Counts of the merged-data report per locus and dataset, read from the
    ``locus_profile`` of the dosage rows (made here unless it is given).

    ``n_snps`` counts distinct CHROM:POS, ``n_kept`` distinct kept variants.
    ``legacy_*`` are one larger, as older reports count the id column too.
    """
    profile = locus_profile(dosage) if profile is None else profile
    counts = profile_counts(profile)
    kept = (
        allele_count_band_filter(allele_count_derive(profile_variants(profile), counts), min_ac)
        .select("locus", "snp_id")
        .distinct()
        .groupBy("locus")
        .agg(F.count("*").alias("n_kept"))
    )
    datasets = F.array(
        *[
            F.struct(F.lit(name).alias("dataset"), F.lit(n).cast("bigint").alias("n_traits"))
            for name, n in sorted(trait_counts.items())
        ]
    )
    n_cov = F.lit(n_covariates).cast("bigint")
    return (
        counts.join(kept, "locus", "left")
        .select(
            "locus", "n_sample", "n_snps",
            F.lit(min_ac).alias("min_ac"),
            (F.col("n_sample") - min_ac).alias("max_ac"),
            F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
            F.inline(datasets),
        )
        .withColumns(
            {
                "n_covariates": n_cov,
                "legacy_n_traits": F.col("n_traits") + 1,
                "legacy_n_covariates": n_cov + 1,
            }
        )
    )


def _plain(number: Column) -> Column:
    """Numbers as a report prints them: no trailing ``.0``."""
    return F.regexp_replace(number.cast("string"), r"\.0$", "")


def summary_text(counts: DataFrame, legacy: bool = False) -> DataFrame:
    """The three report sentences of each locus and dataset.

    The sentence wording and spacing are fixed values of the report format.
    """
    traits = F.col("legacy_n_traits" if legacy else "n_traits").cast("string")
    covars = F.col("legacy_n_covariates" if legacy else "n_covariates").cast("string")
    low, high = _plain(F.col("min_ac")), _plain(F.col("max_ac"))
    first = F.concat(
        F.lit("Minimum allele count (AC) is set to "), low,
        F.lit(" . Given "), F.col("n_sample").cast("string"),
        F.lit(" samples, variants with AC below "), low,
        F.lit(" and above "), high, F.lit(" are removed."),
    )
    second = F.concat(
        F.lit("\nOf "), F.col("n_snps").cast("string"),
        F.lit(" variants, "), F.col("n_kept").cast("string"),
        F.lit(" left with minor allele count > "), low,
        F.lit(" for building haplotypes.\n"),
    )
    head = F.concat(
        F.lit("Merged data comprised "), F.col("n_kept").cast("string"), F.lit(" variants, "), traits
    )
    third = F.when(
        F.col("n_covariates").isNull(), F.concat(head, F.lit(" traits.\n"))
    ).otherwise(F.concat(head, F.lit(" traits, and "), covars, F.lit(" covariates.\n")))
    return counts.select("locus", "dataset", F.concat_ws("\n\n", first, second, third).alias("text"))


