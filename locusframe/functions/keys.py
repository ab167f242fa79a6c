"""Variant and region keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_variant_key(key: Column) -> Column:
    """``CHROM:POS:REF:ALT`` to a struct; null unless it has four parts and
    an integer position."""
    parts = F.split(F.trim(key), ":")
    pos = parts[1].try_cast("bigint")
    return F.when(
        (F.size(parts) == 4) & pos.isNotNull(),
        F.struct(
            parts[0].alias("chrom"),
            pos.alias("pos"),
            parts[2].alias("ref"),
            parts[3].alias("alt"),
        ),
    )


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws(":", chrom, pos.cast("string"), ref, alt)


def snp_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """``chr{CHROM}_{POS}_{REF}_{ALT}``, the genotype column name."""
    return F.concat(
        F.lit("chr"), F.concat_ws("_", chrom, pos.cast("string"), ref, alt)
    )


def position_key(chrom: Column, pos: Column) -> Column:
    return F.concat_ws(":", chrom, pos.cast("string"))


def position_key_from_snp_id(key: Column) -> Column:
    """``5:123`` out of ``chr5_123_A_G``; null when there is no match."""
    hit = F.regexp_extract(key, "([0-9]+)_([0-9]+)", 0)
    return F.when(hit != "", F.replace(hit, F.lit("_"), F.lit(":")))


def position_key_from_variant(key: Column) -> Column:
    """``5:123`` out of ``5:123:A:G``; null when there is no match."""
    hit = F.regexp_extract(key, "([0-9]+):([0-9]+)", 0)
    return F.when(hit != "", hit)


def lookup_allele(ref: Column, alt: Column) -> Column:
    """Allele under which an annotation service files a variant: inserted
    suffix for insertions, ``-`` for deletions, else the ALT allele."""
    longer = F.length(alt) > F.length(ref)
    shorter = F.length(ref) > F.length(alt)
    return (
        F.when(longer & F.startswith(alt, ref), F.substring(alt, F.length(ref) + 1, F.length(alt)))
        .when(shorter & F.startswith(ref, alt), F.lit("-"))
        .otherwise(alt)
    )


def region_string(chrom: Column, beg: Column, end: Column) -> Column:
    return F.format_string("%s:%d-%d", chrom, beg, end)


# Names accepted as genotype columns (fixed pattern, case-insensitive,
# unanchored). Chromosomes outside 0-99 and symbolic alleles do not match.
SNP_ID_PATTERN = "(?i)chr[0-9]{0,2}_[0-9]+_[ATCG]+_[ATCG]+"


def is_snp_id(name: Column) -> Column:
    return F.rlike(name, F.lit(SNP_ID_PATTERN))
