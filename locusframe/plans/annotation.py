"""Variant keys to annotation summary and consequence counts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from locusframe.operators.annotate import (
    annotate_variants,
    count_percentages,
    gene_counts,
    rank_by_count,
    split_variant_keys,
    summarize_annotations,
)


def annotate_keys(keys: DataFrame, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(annotated variants, rejected keys)."""
    good, bad = split_variant_keys(keys)
    return annotate_variants(good, lookup), bad


def consequence_table(documents: DataFrame) -> DataFrame:
    """Counts, percentages, labels and order per locus, consequence, gene."""
    summary = summarize_annotations(documents)
    return rank_by_count(count_percentages(gene_counts(summary)))
