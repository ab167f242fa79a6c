"""Result tables and exports. Layouts are partitioned by locus (and
dataset), so a consumer of one locus reads one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.functions.keys import variant_key
from locusframe.sources.annotation import SUMMARY_COLUMNS

_DOSAGE = ("iid", "chrom", "pos", "marker_id", "ref", "alt", "af", "dosage")
_FREQUENCY = ("chrom", "pos", "id", "ref", "alt", "af")


def _clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Range clustering: rows of a locus lie together, and a heavy locus is
    cut by the further columns instead of landing in one task."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_dosage(dosage: DataFrame, path: str) -> None:
    """Parquet, by locus, sorted by position for range pruning."""
    _clustered(dosage, "locus", "pos", "iid").write.partitionBy("locus").parquet(path)


def export_dosage(dosage: DataFrame, path: str) -> None:
    """Headerless tab-separated text by locus, null as ``.``."""
    rows = _clustered(dosage.select("locus", *_DOSAGE), "locus", "pos", "iid")
    rows.write.partitionBy("locus").csv(path, sep="\t", nullValue=".")


def export_frequencies(frequencies: DataFrame, path: str) -> None:
    rows = _clustered(frequencies.select("locus", *_FREQUENCY), "locus", "pos")
    rows.write.partitionBy("locus").csv(path, sep="\t", nullValue=".")


def export_variant_keys(variants: DataFrame, path: str) -> None:
    keys = _clustered(variants, "locus", "pos").select(
        "locus", variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")).alias("value")
    )
    keys.write.partitionBy("locus").text(path)


def write_merged(merged: DataFrame, path: str) -> None:
    _clustered(merged, "locus", "dataset", "iid").write.partitionBy("locus", "dataset").parquet(path)


def write_summary_text(text: DataFrame, path: str) -> None:
    text.select("locus", "dataset", F.col("text").alias("value")).write.partitionBy(
        "locus", "dataset"
    ).text(path)


def write_associations(coefficients: DataFrame, haplotypes: DataFrame, path: str) -> None:
    """Two flat tables; responses, model objects and fit statistics stay out."""
    by = ("locus", "dataset")
    _clustered(coefficients, *by, "trait_name").write.partitionBy(*by).parquet(f"{path}/coefficients")
    _clustered(haplotypes, *by, "trait_name", "hap_pos").write.partitionBy(*by).parquet(
        f"{path}/haplotypes"
    )


def write_tidied(tidied: DataFrame, path: str) -> None:
    order = ("locus", "dataset", "haplo", "p_value")
    _clustered(tidied, *order).write.partitionBy("locus", "dataset").parquet(path)


def write_significant_csv(rows: DataFrame, path: str) -> None:
    """CSV with dotted headers, no quoting, no row names."""
    named = _clustered(rows, "locus", "dataset", "haplo", "p_value").withColumnsRenamed(
        {"std_error": "std.error", "p_value": "p.value"}
    )
    named.write.partitionBy("locus", "dataset").csv(
        path, header=True, quote="\u0000", escapeQuotes=False
    )


def write_annotation_json(documents: DataFrame, path: str) -> None:
    """One JSON object per line, so that reading stays splittable."""
    documents.write.json(path)


def write_annotation_summary(summary: DataFrame, path: str) -> None:
    extra = [c for c in summary.columns if c not in SUMMARY_COLUMNS]
    writer = summary.select(*extra, *SUMMARY_COLUMNS).write
    if extra:
        writer = writer.partitionBy(*extra)
    writer.csv(path, sep="\t", header=True, emptyValue="", nullValue="")

