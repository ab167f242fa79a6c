"""Region restriction, allele counts and counting of samples and variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.functions.genotype import fold_frequency
from locusframe.functions.keys import is_snp_id, position_key, snp_id
from locusframe.session import materialize, small_side

BIN_WIDTH = 1_000_000


def region_filter(variants: DataFrame, chrom: str, beg: int, end: int, by_overlap: bool = True) -> DataFrame:
    """Variants of one region, by record overlap or by start position. The
    comparisons on ``chrom`` and ``pos`` reach a Parquet scan."""
    same = (F.col("chrom") == chrom) & (F.col("pos") <= end)
    if by_overlap:
        return variants.filter(same & (F.col("pos") + F.length("ref") - 1 >= beg))
    return variants.filter(same & (F.col("pos") >= beg))


def region_interval_join(
    variants: DataFrame, regions: DataFrame, by_overlap: bool = True, bin_width: int = BIN_WIDTH
) -> DataFrame:
    """Every (region, variant) pair whose intervals meet, in one pass.

    Both sides are cut into position bins, which makes this an equi-join on
    (chrom, bin): hashed against a broadcast region table while that is
    small, shuffled otherwise. Bins spread a heavy chromosome over many
    keys. A pair meeting in several bins is kept only in the first one. A
    variant ends at ``stop`` if it has such a column, else where REF ends.
    """
    end = F.col("stop") if "stop" in variants.columns else F.col("pos") + F.length("ref") - 1
    last = end if by_overlap else F.col("pos")
    first_bin = F.floor(F.col("pos") / bin_width)
    left = variants.withColumn("_last", last).withColumn("_vbin", first_bin)
    if by_overlap:
        left = left.withColumn(
            "_bin", F.explode(F.sequence("_vbin", F.floor(F.col("_last") / bin_width)))
        )
    else:
        left = left.withColumn("_bin", F.col("_vbin"))
    right = regions.select(
        "locus", "chrom", "beg", "end",
        F.floor(F.col("beg") / bin_width).alias("_rbin"),
        F.explode(
            F.sequence(F.floor(F.col("beg") / bin_width), F.floor(F.col("end") / bin_width))
        ).alias("_bin"),
    )
    # Catalyst does not count what explode adds: the true size decides.
    right = small_side(right, "region-bins")
    meets = (F.col("pos") <= F.col("end")) & (F.col("_last") >= F.col("beg"))
    once = F.col("_bin") == F.greatest("_vbin", "_rbin")
    joined = left.join(right, ["chrom", "_bin"]).filter(meets & once)
    return joined.select("locus", "beg", "end", *variants.columns)


def region_variant_count(region_variants: DataFrame) -> DataFrame:
    return region_variants.groupBy("locus").agg(F.count("*").alias("n_variants"))


def locus_dataset_cross(regions: DataFrame, datasets: list[str]) -> DataFrame:
    """Each locus with each dataset named in the configuration."""
    names = F.array(*[F.lit(d) for d in datasets])
    return regions.withColumn("dataset", F.explode(names))


def sample_counts(dosage: DataFrame) -> DataFrame:
    """Distinct individuals per locus. The distinct combines before the
    shuffle and spreads a heavy locus over its individuals."""
    return (
        dosage.select("locus", "iid").distinct().groupBy("locus").agg(F.count("iid").alias("n_sample"))
    )


def site_counts(dosage: DataFrame) -> DataFrame:
    """Distinct CHROM:POS per locus."""
    return (
        dosage.select("locus", position_key(F.col("chrom"), F.col("pos")).alias("site"))
        .distinct()
        .groupBy("locus")
        .agg(F.count("site").alias("n_snps"))
    )


def sample_variant_counts(dosage: DataFrame) -> DataFrame:
    """n_sample and n_snps per locus: two plain distincts, each reading only
    its own columns, instead of one multi-distinct aggregate."""
    return sample_counts(dosage).join(site_counts(dosage), "locus")


def locus_profile(dosage: DataFrame) -> DataFrame:
    """Individuals and variants of every locus in one scan of the dosage rows:
    one row per (locus, iid), and one per (locus, chrom, pos, ref, alt, af) with
    a null ``iid``; ``is_sample`` tells them apart.

    Both sets combine before the shuffle, so it carries a task's distinct rows.
    The stored table has a row per individual and variant instead of one per
    cell; counts, band and rejects are read from it.
    """
    variant = ["locus", "chrom", "pos", "ref", "alt", "af"]
    sets = dosage.groupingSets([["locus", "iid"], variant], *dict.fromkeys(["locus", "iid", *variant]))
    rows = sets.agg(F.grouping("iid").alias("_variant"))
    return materialize(rows.select("iid", *variant, (F.col("_variant") == 0).alias("is_sample")), "locus-profile")


def profile_counts(profile: DataFrame) -> DataFrame:
    """n_sample and n_snps (distinct CHROM:POS) per locus."""
    return profile.groupBy("locus").agg(
        F.count("iid").alias("n_sample"),
        F.count_distinct(F.when(~F.col("is_sample"), position_key(F.col("chrom"), F.col("pos")))).alias("n_snps"),
    )


def profile_variants(profile: DataFrame) -> DataFrame:
    """Distinct variants with their frequencies."""
    return profile.filter(~F.col("is_sample")).select("locus", "chrom", "pos", "ref", "alt", "af")


def allele_count_derive(dosage: DataFrame, n_samples: DataFrame, ploidy_factor: int = 1) -> DataFrame:
    """Add snp_id, maf and ac = af * n_sample.

    ``ploidy_factor=1`` gives the established count (not 2n); the band below
    is symmetric, so it acts on the ALT frequency.
    """
    af = F.col("af")
    counts = small_side(n_samples.select("locus", "n_sample"), "sample-counts")
    return dosage.join(counts, "locus").select(
        *dosage.columns,
        "n_sample",
        snp_id(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")).alias("snp_id"),
        fold_frequency(af).alias("maf"),
        (af * F.col("n_sample") * ploidy_factor).alias("ac"),
    )


def allele_count_band_filter(derived: DataFrame, min_ac: float) -> DataFrame:
    """Keep min_ac < ac < n_sample - min_ac, both strict; null drops."""
    return derived.filter((F.col("ac") > min_ac) & (F.col("ac") < F.col("n_sample") - min_ac))


def variant_column_select(named: DataFrame, column: str = "name") -> DataFrame:
    """Rows whose name is a genotype column name."""
    return named.filter(is_snp_id(F.col(column)))


def non_variant_select(named: DataFrame, column: str = "name") -> DataFrame:
    """Rows whose name is not a genotype column name (and not the id)."""
    return named.filter(~is_snp_id(F.col(column)) & (F.col(column) != "IID"))
