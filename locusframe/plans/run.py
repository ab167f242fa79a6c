"""A whole run from one configuration mapping: region list, VCF, phenotype
tables and covariates in; dosage, haplotypes, results and report data out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.config import Thresholds, optional_path
from locusframe.functions.keys import variant_key
from locusframe.operators.annotate import summarize_annotations
from locusframe.operators.display import display_annotation, display_table
from locusframe.operators.merge import covariate_join, genotype_phenotype_join, merged_counts, summary_text
from locusframe.operators.results import significant_results, tidied_results
from locusframe.operators.variants import region_interval_join
from locusframe.plans.annotation import annotate_keys
from locusframe.plans.association import Association, rejected_variants, run_association
from locusframe.plans.report import report_sections, report_table, write_report
from locusframe.session import materialize
from locusframe.sinks import tables as sinks
from locusframe.sources.lookup import open_lookup, store_lookup
from locusframe.sources.quality import regions_without_variants, require_text_input
from locusframe.sources.tables import (
    dataset_catalog,
    scan_covariates,
    scan_phenotypes,
    scan_regions,
    value_columns,
)
from locusframe.sources.vcf import (
    explode_samples,
    read_vcf_lines,
    read_vcf_regions,
    vcf_index,
    vcf_samples,
    vcf_variants,
)


@dataclass
class Extraction:
    dosage: DataFrame
    frequencies: DataFrame
    empty_regions: DataFrame


def stored_index(spark: SparkSession, vcf_path: str, index_path: str) -> DataFrame:
    """The slab index at ``index_path``, made there first if it is missing."""
    try:
        return spark.read.parquet(index_path)
    except AnalysisException:
        vcf_index(spark, vcf_path).write.parquet(index_path)
        return spark.read.parquet(index_path)


def extract_regions(
    spark: SparkSession, vcf_path: str, regions: DataFrame, out: str, index_path: str | None = None
) -> Extraction:
    """Variants of all regions in one pass over the VCF, stored by locus.

    Regions meet the packed variant rows, which are stored once and exploded
    to samples afterwards. With ``index_path``, only the slabs of
    block-compressed files that meet a region are read. Missing or empty input
    fails.
    """

    def read(session: SparkSession, path: str) -> DataFrame:
        if index_path is None:
            return read_vcf_lines(session, path)
        return read_vcf_regions(session, path, regions, stored_index(session, path, index_path))

    lines = require_text_input(spark, vcf_path, read)
    hits = materialize(region_interval_join(vcf_variants(lines), regions).drop("beg", "end", "info"), "region-hits")
    sites = hits.select("locus", "chrom", "pos", F.col("marker_id").alias("id"), "ref", "alt", "af")
    sites.write.partitionBy("locus").parquet(f"{out}/variants")
    sinks.write_dosage(explode_samples(hits, vcf_samples(lines)), f"{out}/dosage")
    variants = spark.read.schema(sites.schema).parquet(f"{out}/variants")
    dosage = spark.read.parquet(f"{out}/dosage").withColumn("locus", F.col("locus").cast("string"))
    return Extraction(dosage, variants, regions_without_variants(regions, variants))


def read_phenotypes(spark: SparkSession, datasets: str, files: str) -> dict[str, DataFrame]:
    """Phenotype tables by dataset name from the two comma lists."""
    config = spark.createDataFrame([(datasets, files)], ["datasets", "phenotype_files"])
    # One row per phenotype table of the configuration.
    return {r.data_type: scan_phenotypes(spark, r.data_path) for r in dataset_catalog(config).collect()}


def run_config(spark: SparkSession, config: Mapping[str, object]) -> Association:
    """Run everything named in ``config`` and write to ``path_workspace``.

    Keys: datasets, phenotype_files, covariates_file, path_loci, path_vcf,
    path_workspace, thresholds, joint (phase and regression fitted together;
    true unless set to false), annotation_lookup (Parquet with chrom, pos,
    allele, annotation; variants are annotated where it is given),
    annotation_store (place of that lookup stored by position, which later runs
    read without shuffling it; made from annotation_lookup if missing), vcf_index
    (place of the slab index of a block-compressed VCF; made if missing).
    """
    out = str(config["path_workspace"]).rstrip("/")
    limits = Thresholds.from_mapping(config.get("thresholds") or {})
    regions = scan_regions(spark, str(config["path_loci"]))
    index = optional_path(config.get("vcf_index"))
    extracted = extract_regions(spark, str(config["path_vcf"]), regions, f"{out}/genotype", index)
    phenotypes = read_phenotypes(spark, str(config["datasets"]), str(config["phenotype_files"]))
    covariates = scan_covariates(spark, optional_path(config.get("covariates_file")))
    joint = str(config.get("joint", True)).lower() != "false"
    run = run_association(extracted.dosage, phenotypes, covariates, limits, extracted.frequencies, joint)

    counts = merged_counts(
        extracted.dosage,
        limits.min_ac,
        {name: len(value_columns(table)) for name, table in phenotypes.items()},
        None if covariates is None else len(value_columns(covariates)),
        run.profile,
    )
    sinks.export_variant_keys(extracted.frequencies, f"{out}/keys")
    sinks.write_summary_text(summary_text(counts), f"{out}/summary")
    sinks.write_associations(run.coefficients.drop("cohort"), run.haplotypes.drop("cohort"), f"{out}/associations")
    sinks.write_tidied(tidied_results(run.results), f"{out}/results")
    sinks.write_significant_csv(significant_results(run.results), f"{out}/result_signif")
    for name, table in phenotypes.items():
        wide = genotype_phenotype_join(run.genotypes, table.withColumn("dataset", F.lit(name)))
        sinks.write_merged(covariate_join(wide, covariates), f"{out}/merged/{name}")
    lookup, documents = _annotations(spark, config), None
    if lookup is not None:
        keys = extracted.frequencies.select("locus", variant_key(*map(F.col, ("chrom", "pos", "ref", "alt"))).alias("variant")).distinct()
        annotated, rejects = annotate_keys(keys, lookup)
        annotated.write.parquet(f"{out}/annotation/variants")
        rejects.write.parquet(f"{out}/annotation/rejects")
        documents = spark.read.schema(annotated.schema).parquet(f"{out}/annotation/variants").filter(F.col("annotation").isNotNull())
    write_report(report_table(_sections(run, extracted, counts, documents, limits)), f"{out}/report")
    return run


def _annotations(spark: SparkSession, config: Mapping[str, object]) -> DataFrame | None:
    """The lookup that the configuration names, stored by position if it says so."""
    rows, store = optional_path(config.get("annotation_lookup")), optional_path(config.get("annotation_store"))
    if store is None:
        return None if rows is None else spark.read.parquet(rows)
    try:
        return open_lookup(spark, store)
    except AnalysisException:
        if rows is None:
            raise
        return store_lookup(spark.read.parquet(rows), store)


def _sections(
    run: Association, extracted: Extraction, counts: DataFrame, documents: DataFrame | None, limits: Thresholds
) -> dict[str, DataFrame]:
    """Sections of the report; without annotations the display has none."""
    if documents is None:
        annotation = run.sites.select(
            "locus", *[F.lit(None).cast("string").alias(c) for c in ("snpid", "variant", "annot", "gene")]
        ).limit(0)
    else:
        annotation = display_annotation(summarize_annotations(documents))
    display = materialize(display_table(run.haplotypes, run.sites, annotation, extracted.frequencies), "display")
    rejected = rejected_variants(extracted.dosage, limits.min_ac, extracted.frequencies, run.profile)
    return report_sections(run, extracted.frequencies, counts, documents, display, rejected)
