"""Dosage rounding, allele codes and the displayed allele."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_dosage(dosage: Column) -> Column:
    """Nearest integer, halves to even."""
    return F.bround(dosage, 0).cast("int")


def genotype_to_alleles(genotype: Column) -> Column:
    """0/1/2 copies to a pair of allele codes (1 = REF, 2 = ALT)."""
    return (
        F.when(genotype == 0, F.array(F.lit(1), F.lit(1)))
        .when(genotype == 1, F.array(F.lit(1), F.lit(2)))
        .when(genotype == 2, F.array(F.lit(2), F.lit(2)))
    )


def missing_code(code: Column) -> Column:
    """Allele codes 0 and null both mean missing."""
    return F.when(code != 0, code)


def fold_frequency(af: Column) -> Column:
    """Minor frequency: ``af`` up to one half, else ``1 - af``."""
    return F.when(af <= 0.5, af).otherwise(1 - af)


def shown_allele(code: Column, ref: Column, alt: Column, af: Column) -> Column:
    """Displayed allele, from the flipped alleles and flipped frequency.

    Code 2 swaps REF/ALT and sets AF to 1 - AF first; the choice is then made
    on the flipped values, so at AF = 0.5 both codes show the original ALT.
    """
    flipped = code == 2
    new_ref = F.when(flipped, alt).otherwise(ref)
    new_alt = F.when(flipped, ref).otherwise(alt)
    new_af = F.when(flipped, 1 - af).otherwise(af)
    return (
        F.when((code == 1) & (new_af >= 0.5), new_alt)
        .when((code == 1) & (new_af < 0.5), new_ref)
        .when((code == 2) & (new_af < 0.5), new_alt)
        .when((code == 2) & (new_af >= 0.5), new_ref)
    )


def is_snp(ref: Column, alt: Column) -> Column:
    return (F.length(ref) == 1) & (F.length(alt) == 1)


def differs_from_reference(code: Column, ref_code: Column) -> Column:
    return (code != ref_code) | ref_code.isNull()
