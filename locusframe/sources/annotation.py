"""Variant annotation documents and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TRANSCRIPT_DDL = (
    "struct<consequence_terms: array<string>, biotype: string, protein_start: bigint, "
    "amino_acids: string, hgvsp: string, gene_symbol: string, gene_id: string, "
    "transcript_id: string, canonical: int, hgnc_id: string, impact: string, "
    "sift_prediction: string, polyphen_prediction: string>"
)
COLOCATED_DDL = (
    "struct<id: string, clin_sig: array<string>, "
    "frequencies: map<string, map<string, double>>>"
)
ANNOTATION_DDL = (
    "variant string, annotation array<struct<most_severe_consequence: string, "
    "input_ref_allele: string, input_alt_allele: string, "
    f"transcript_consequences: array<{TRANSCRIPT_DDL}>, "
    f"colocated_variants: array<{COLOCATED_DDL}>>>"
)

SUMMARY_COLUMNS = (
    "variant", "rs_ids", "ref_allele", "alt_allele", "most_severe_consequence",
    "all_consequences", "coding_consequences", "protein_changes", "impact",
    "gene_id", "gene_symbol", "transcript_id", "canonical_transcript", "biotype",
    "hgnc_id", "clinical_significance", "sift_prediction", "polyphen_prediction",
    "gnomad_af", "gnomad_afr_af", "gnomad_eur_af", "gnomad_eas_af",
)
FREQUENCY_COLUMNS = SUMMARY_COLUMNS[-4:]


def scan_annotations(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Annotation records, one JSON object per line. ``multi_line`` reads
    files that hold one JSON array each (per-locus documents)."""
    return spark.read.schema(ANNOTATION_DDL).json(path, multiLine=multi_line)


def scan_annotation_summary(spark: SparkSession, path: str) -> DataFrame:
    """22-column tab-separated summary with header; blanks stay ''."""
    schema = T.StructType(
        [
            T.StructField(c, T.DoubleType() if c in FREQUENCY_COLUMNS else T.StringType())
            for c in SUMMARY_COLUMNS
        ]
    )
    table = spark.read.csv(path, sep="\t", header=True, schema=schema)
    return table.fillna("", subset=[c for c in SUMMARY_COLUMNS if c not in FREQUENCY_COLUMNS])


def scan_legacy_annotation(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CHROM, POS, POS37, Gene, Gene_ID, VEP_annot table."""
    ddl = "chrom string, pos bigint, pos37 bigint, gene string, gene_id string, vep_annot string"
    return spark.read.csv(path, sep="\t", header=False, schema=ddl)
