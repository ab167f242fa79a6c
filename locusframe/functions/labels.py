"""Consequence, haplotype and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_consequence(term: Column) -> Column:
    """Short consequence: no ``_variant``, ``UTR3'`` / ``UTR5'`` for UTRs."""
    out = F.regexp_replace(term, "_variant", "")
    out = F.regexp_replace(out, "3_prime_UTR|3_prime_utr", "UTR3'")
    return F.regexp_replace(out, "5_prime_UTR|5_prime_utr", "UTR5'")


def clean_consequence_legacy(term: Column) -> Column:
    """Older form with a one-character class after ``3_prime_``, so that
    ``3_prime_UTR`` turns into ``UTR3'TR``. Kept for parity only."""
    out = F.regexp_replace(term, "_variant", "")
    out = F.regexp_replace(out, "3_prime_[UTR|utr]", "UTR3'")
    return F.regexp_replace(out, "5_prime_UTR|5_prime_utr", "UTR5'")


def spaced(term: Column) -> Column:
    return F.replace(term, F.lit("_"), F.lit(" "))


def pad_haplotype_label(term: Column) -> Column:
    """``haplo_genotype.7`` to ``H007``, ``haplo.base`` to ``Ref.``."""
    index = F.regexp_extract(term, r"\.(\d{1,2})(?!\d)", 1)
    padded = F.when(
        index != "",
        F.regexp_replace(
            term, F.lit(r"\.\d{1,2}(?!\d)"), F.concat(F.lit("."), F.lpad(index, 3, "0"))
        ),
    ).otherwise(term)
    padded = F.regexp_replace(padded, "haplo_genotype.", "H")
    return F.regexp_replace(padded, "haplo.base", "Ref.")


def clean_snp_label(name: Column) -> Column:
    """Drop ``chr_``, then turn the first ``_`` into ``:``."""
    out = F.regexp_replace(name, "^(.*?)chr_", "$1")
    return F.regexp_replace(out, "^([^_]*)_", "$1:")


def blank_to_label(text: Column, label: str = "NA") -> Column:
    return F.when(text == "", F.lit(label)).otherwise(text)


def axis_label(gene: Column, annot: Column) -> Column:
    """``gene_annot``; a missing part reads ``NA``."""
    na = F.lit("NA")
    return F.concat(F.coalesce(gene, na), F.lit("_"), F.coalesce(annot, na))


def trait_display_name(trait: Column) -> Column:
    return F.replace(trait, F.lit("_"), F.lit(":"))


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("YES")).otherwise(F.lit("NO"))


def default_blank(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def significant(p_value: Column, level: float = 0.05) -> Column:
    """``Yes`` up to and including ``level``, else ``No``; null stays null."""
    return F.when(p_value <= level, F.lit("Yes")).when(p_value > level, F.lit("No"))
