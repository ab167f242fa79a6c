"""Readers and writers: text made by Spark from the tables, written to the
shared folder and read back through the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import association, phenotypes, rounded, write_blocks
from checks.haplo_sql import ASSOCIATION_CTES, PATTERN_CTE
from checks.summary_sql import DOCUMENTS_CTE, SUMMARY_CTE
from checks.views import (
    table,
    v_annotation,
    v_covariates,
    v_dosage,
    v_regions,
    v_traits,
    v_transcripts,
    v_variants,
    with_views,
)
from locusframe.functions.keys import variant_key
from locusframe.operators.annotate import summarize_annotations
from locusframe.operators.merge import covariate_join, genotype_phenotype_join, merged_counts, summary_text
from locusframe.operators.results import significant_results, tidied_results
from locusframe.operators import variants
from locusframe.operators.variants import region_interval_join
from locusframe.session import materialize, new_path
from locusframe.sinks import tables as sinks
from locusframe.sources import annotation as annotations
from locusframe.sources import dosage as dosages
from locusframe.sources import quality, tables, vcf

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        Q[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def region_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_interval_join(v_variants(spark, sf_dir), v_regions(spark, sf_dir))


@query(with_views("v_regions") + 'SELECT locus, chrom, beg, "end" FROM v_regions')
def regions_scan(spark, sf_dir):
    path = new_path(spark, "regions")
    v_regions(spark, sf_dir).select(
        F.col("chrom").alias("CHROM"), F.col("beg").alias("BEG"), F.col("end").alias("END"),
        F.concat(F.lit(" "), "locus").alias("LOCUS"),
    ).write.csv(path, sep="\t", header=True, ignoreLeadingWhiteSpace=False)
    return tables.scan_regions(spark, path)


@query("""
    SELECT p_partkey, p_brand AS data_type, p_name AS data_path FROM part
    UNION ALL
    SELECT p_partkey, p_type, p_name || '.csv' FROM part""")
def dataset_catalog(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    config = part.select(
        "p_partkey",
        F.concat_ws(",", "p_brand", "p_type").alias("datasets"),
        F.concat("p_name", F.lit(" , "), "p_name", F.lit(".csv ")).alias("phenotype_files"),
    )
    return tables.dataset_catalog(config)


def _export_table(df: DataFrame, path: str, sep: str) -> None:
    df.withColumnRenamed("iid", "IID").write.csv(path, sep=sep, header=True)


@query(with_views("v_traits") + """
    SELECT iid, acct_bal, round(order_total, 6) AS order_total, order_count,
           round(founder_score, 6) AS founder_score FROM v_traits""")
def phenotype_scan(spark, sf_dir):
    path = new_path(spark, "phenotypes")
    _export_table(v_traits(spark, sf_dir), path, ",")
    return rounded(tables.scan_phenotypes(spark, path), 6, "order_total", "founder_score")


@query(with_views("v_covariates") + 'SELECT iid, "Age", "Sex" FROM v_covariates')
def covariate_scan(spark, sf_dir):
    path = new_path(spark, "covariates")
    _export_table(v_covariates(spark, sf_dir), path, "\t")
    assert tables.scan_covariates(spark, "None") is None
    return tables.scan_covariates(spark, path)


@query(with_views("v_dosage") + """
    SELECT locus, iid, chrom, pos, marker_id, ref, alt, round(af, 6) AS af,
           CASE WHEN iid LIKE '%7' THEN NULL ELSE round(dosage, 6) END AS dosage
    FROM v_dosage""")
def dosage_scan(spark, sf_dir):
    path = new_path(spark, "dosage-text")
    gaps = F.when(~F.col("iid").endswith("7"), F.col("dosage"))
    sinks.export_dosage(v_dosage(spark, sf_dir).withColumn("dosage", gaps), path)
    return rounded(dosages.scan_dosage(spark, path), 6, "af", "dosage")


# -- VCF: line items as records with five samples ---------------------------

_SAMPLES = ("S-1", "S.2", "S_3", "004", "S5")


def vcf_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Header lines and record lines (with chrom and pos) of the line items."""
    calls = [
        F.concat(
            F.lit("0/1:"),
            F.when((F.col("l_linenumber") + i) % 5 == 0, F.lit(".")).otherwise(
                ((F.col("l_quantity") + i) % 5 / 2).cast("string")
            ),
        )
        for i in range(len(_SAMPLES))
    ]
    flat = v_variants(spark, sf_dir, "l_linenumber", "l_quantity").select(
        "chrom", F.col("pos").cast("string"), "id", "ref", "alt", F.lit("."), F.lit("PASS"),
        F.concat(F.lit("NS=5;AF="), F.col("af").cast("string")), F.lit("GT:DS"), *calls,
    )
    head = spark.createDataFrame(
        [
            ("##fileformat=VCFv4.2",),
            ("\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *_SAMPLES]),),
        ],
        "value string",
    )
    value = F.concat_ws("\t", *[f"`{c}`" for c in flat.columns]).alias("value")
    return head, flat.select("chrom", F.col("pos").cast("bigint").alias("pos"), value)


def vcf_text(spark: SparkSession, sf_dir: str) -> str:
    """A VCF folder written from the line items; returns its path."""
    head, records = vcf_lines(spark, sf_dir)
    path = new_path(spark, "vcf")
    head.unionByName(records.select("value")).write.text(path)
    return path


#: Compressed bytes of a slab: small, so that the tables give many of them.
_SLAB = 131_072


def vcf_blocks(spark: SparkSession, sf_dir: str) -> str:
    """The same records, sorted by position and block-compressed."""
    head, records = vcf_lines(spark, sf_dir)
    path = new_path(spark, "vcf-blocks")
    write_blocks(head.coalesce(1), path, "head")
    write_blocks(records.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").select("value"), path, "part")
    return path


@query(with_views("v_region_variants") + """
    SELECT locus, chrom, pos, id AS marker_id, ref, alt, round(af, 6) AS af FROM v_region_variants""")
def vcf_region_scan(spark, sf_dir):
    records = vcf.vcf_variants(vcf.read_vcf_lines(spark, vcf_text(spark, sf_dir)))
    hits = region_interval_join(records, v_regions(spark, sf_dir))
    return rounded(hits.select("locus", "chrom", "pos", "marker_id", "ref", "alt", "af"), 6, "af")


REGION_SCAN_SQL = with_views("v_region_variants") + """
    SELECT locus, chrom, pos, id AS marker_id, ref, alt, round(af, 6) AS af FROM v_region_variants"""


@query(REGION_SCAN_SQL)
def vcf_block_scan(spark, sf_dir):
    """Block-compressed files read by slabs, every record."""
    records = vcf.vcf_variants(vcf.read_vcf_lines(spark, vcf_blocks(spark, sf_dir), _SLAB))
    hits = region_interval_join(records, v_regions(spark, sf_dir))
    return rounded(hits.select("locus", "chrom", "pos", "marker_id", "ref", "alt", "af"), 6, "af")


@query(with_views("v_variants") + """
    SELECT chrom, min(pos) AS first, max(pos + length(ref) - 1) AS last, count(*) AS n_records
    FROM v_variants GROUP BY chrom""")
def vcf_block_index(spark, sf_dir):
    """The index of the slabs, summed by chromosome."""
    index = vcf.vcf_index(spark, vcf_blocks(spark, sf_dir), _SLAB).filter("chrom is not null")
    return index.groupBy("chrom").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n_records").alias("n_records"))


@query(REGION_SCAN_SQL)
def vcf_region_prune(spark, sf_dir):
    """Only the slabs that meet a region are opened."""
    path, regions = vcf_blocks(spark, sf_dir), v_regions(spark, sf_dir)
    index = materialize(vcf.vcf_index(spark, path, _SLAB), "vcf-index")
    records = vcf.vcf_variants(vcf.read_vcf_regions(spark, path, regions, index))
    hits = region_interval_join(records, regions)
    return rounded(hits.select("locus", "chrom", "pos", "marker_id", "ref", "alt", "af"), 6, "af")


@query(with_views("v_regions") + """
    SELECT r.locus, s.iid, r.chrom, r.pos, r.id AS marker_id, r.ref, r.alt, round(r.af, 6) AS af,
           CASE WHEN (r.l_linenumber + s.i) % 5 = 0 THEN NULL
                ELSE (r.l_quantity + s.i) % 5 / 2 END AS dosage
    FROM (SELECT v.*, r.locus FROM (
            SELECT CAST(l_suppkey % 22 + 1 AS VARCHAR) AS chrom,
                   l_partkey * 1000 + l_linenumber AS pos,
                   'rs_' || l_orderkey || '_' || l_linenumber AS id,
                   CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'CT' ELSE 'G' END AS ref,
                   CASE l_linestatus WHEN 'O' THEN 'C' ELSE 'CTT' END AS alt,
                   l_discount * 10 AS af, l_quantity, l_linenumber
            FROM lineitem) v JOIN v_regions r ON v.chrom = r.chrom
            AND v.pos <= r."end" AND v.pos + length(v.ref) - 1 >= r.beg) r
    CROSS JOIN (VALUES (0, 'S-1'), (1, 'S.2'), (2, 'S_3'), (3, '004'), (4, 'S5')) s(i, iid)""")
def vcf_sample_explode(spark, sf_dir):
    lines = vcf.read_vcf_lines(spark, vcf_text(spark, sf_dir))
    hits = region_interval_join(vcf.vcf_variants(lines), v_regions(spark, sf_dir))
    long = vcf.explode_samples(hits.drop("beg", "end"), vcf.vcf_samples(lines))
    return rounded(long, 6, "af")


@query(with_views("v_region_variants") + """
    SELECT locus, chrom || ':' || pos || ':' || ref || ':' || alt AS variant FROM v_region_variants""")
def variant_keys(spark, sf_dir):
    key = variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))
    return region_variants(spark, sf_dir).select("locus", key.alias("variant"))


@query(with_views("v_region_variants") + """
    SELECT locus, chrom, pos, id, ref, alt, round(af, 6) AS af FROM v_region_variants""")
def variant_freqs(spark, sf_dir):
    path = new_path(spark, "frequencies")
    sinks.export_frequencies(region_variants(spark, sf_dir), path)
    return rounded(dosages.scan_frequencies(spark, path), 6, "af")


@query(with_views("v_transcripts") + """
    , ranked AS (
      SELECT *, CASE WHEN k % 4 = 0 THEN term || '&splice_region_variant' ELSE term END AS c,
             greatest(CASE term WHEN 'intron_variant' THEN 7 WHEN '3_prime_UTR_variant' THEN 9
                      WHEN '5_prime_UTR_variant' THEN 9 WHEN 'synonymous_variant' THEN 11
                      WHEN 'missense_variant' THEN 14 END,
                      CASE WHEN k % 4 = 0 THEN 13 ELSE 0 END) AS r
      FROM v_transcripts)
    SELECT locus, variant, gene AS symbol, 'ENSG' || gene AS gene, c AS consequence
    FROM (SELECT *, row_number() OVER (PARTITION BY variant ORDER BY r DESC, event_id) AS rn FROM ranked)
    WHERE rn = 1""")
def split_consequence_worst(spark, sf_dir):
    t = v_transcripts(spark, sf_dir)
    term = F.when(F.col("k") % 4 == 0, F.concat("term", F.lit("&splice_region_variant"))).otherwise(F.col("term"))
    text = F.concat_ws("|", F.lit("T"), term, F.col("gene"), F.concat(F.lit("ENSG"), "gene"))
    sites = t.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("event_id", text.alias("c")))).alias("rows")
    ).select(
        F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")).alias("locus"),
        F.concat((F.col("user_id") % 22 + 1).cast("string"), F.lit(":"),
                 (F.col("user_id") * 100).cast("string"), F.lit(":A:T")).alias("variant"),
        F.array_join(F.transform("rows", lambda r: r["c"]), ",").alias("csq"),
    )
    # Through a VCF: the entry from INFO, the order of its fields from the header.
    path = new_path(spark, "csq-vcf")
    head = spark.createDataFrame(
        [('##INFO=<ID=CSQ,Number=.,Type=String,Description="Format: Allele|Consequence|SYMBOL|Gene">',)], "value string"
    )
    record = F.concat_ws(
        "\t", *[F.get(F.split("variant", ":"), F.lit(i)) for i in (0, 1)], F.concat_ws(" ", "locus", "variant"),
        F.lit("A"), F.lit("T"), F.lit("."), F.lit("PASS"), F.concat(F.lit("NS=5;CSQ="), "csq"),
    )
    head.unionByName(sites.select(record.alias("value"))).write.text(path)
    lines = vcf.read_vcf_lines(spark, path)
    read = vcf.with_csq(vcf.vcf_variants(lines)).select(
        F.get(F.split("marker_id", " "), F.lit(0)).alias("locus"), F.get(F.split("marker_id", " "), F.lit(1)).alias("variant"), "csq"
    )
    return vcf.worst_consequence(read, vcf.csq_fields(lines))


@query(with_views("v_variants") + """
    SELECT chrom || ':' || pos || ':' || ref || ':' || alt AS variant FROM v_variants WHERE pos % 1000 <> 3""")
def variant_key_list_scan(spark, sf_dir):
    path = new_path(spark, "keys")
    key = variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))
    text = F.when(F.col("pos") % 1000 == 3, F.lit("   ")).otherwise(F.concat(F.lit(" "), key, F.lit("  ")))
    v_variants(spark, sf_dir).select(text.alias("value")).write.text(path)
    return dosages.scan_variant_keys(spark, path)


def _document_facts(docs: DataFrame) -> DataFrame:
    rec = F.col("annotation")[0]
    return docs.select(
        "locus", "variant",
        rec["most_severe_consequence"].alias("most_severe_consequence"),
        F.size(rec["transcript_consequences"]).alias("n_transcripts"),
        rec["transcript_consequences"][0]["transcript_id"].alias("first_transcript"),
        F.size(F.filter(rec["colocated_variants"], lambda c: c["frequencies"].isNotNull())).alias("n_frequencies"),
    )


@query(DOCUMENTS_CTE + """
    SELECT locus, variant, most_severe_consequence, n_transcripts, first_transcript, n_frequencies
    FROM documents_facts""")
def annotation_json_scan(spark, sf_dir):
    path = new_path(spark, "annotation")
    sinks.write_annotation_json(v_annotation(spark, sf_dir).drop("locus"), path)
    docs = annotations.scan_annotations(spark, path)
    user = (F.split("variant", ":")[1].cast("bigint") / 100).cast("bigint")
    return _document_facts(docs.withColumn("locus", F.concat(F.lit("L"), (user % 3).cast("string"))))


@query(SUMMARY_CTE + "SELECT * FROM summary")
def annotation_summary_scan(spark, sf_dir):
    path = new_path(spark, "summary")
    sinks.write_annotation_summary(summarize_annotations(v_annotation(spark, sf_dir)).drop("locus"), path)
    return rounded(annotations.scan_annotation_summary(spark, path), 6, *annotations.FREQUENCY_COLUMNS)


@query(with_views("v_transcripts") + """
    SELECT CAST(user_id % 22 + 1 AS VARCHAR) AS chrom, event_id AS pos, event_id + 100 AS pos37,
           gene, 'ENSG' || gene AS gene_id, term AS vep_annot FROM v_transcripts""")
def legacy_annotation_scan(spark, sf_dir):
    path = new_path(spark, "legacy")
    v_transcripts(spark, sf_dir).select(
        (F.col("user_id") % 22 + 1).alias("chrom"), F.col("event_id").alias("pos"),
        (F.col("event_id") + 100).alias("pos37"), "gene", F.concat(F.lit("ENSG"), "gene"), "term",
    ).write.csv(path, sep="\t")
    return annotations.scan_legacy_annotation(spark, path)


@query(with_views("v_region_variants")
       + "SELECT locus, count(*) AS n_variants FROM v_region_variants GROUP BY locus")
def region_variant_count(spark, sf_dir):
    return variants.region_variant_count(region_variants(spark, sf_dir))


@query(with_views("v_variants", "v_regions") + """
    SELECT locus, chrom, beg, beg + 700 AS "end" FROM v_regions r WHERE NOT EXISTS (
      SELECT 1 FROM v_variants v WHERE v.chrom = r.chrom AND v.pos <= r.beg + 700
      AND v.pos + length(v.ref) - 1 >= r.beg)""")
def input_quality_gate(spark, sf_dir):
    path = new_path(spark, "gate")
    v_variants(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    lines = quality.require_text_input(spark, path)
    records = lines.select(F.from_json("value", v_variants(spark, sf_dir).schema).alias("v")).select("v.*")
    narrow = v_regions(spark, sf_dir).withColumn("end", F.col("beg") + 700)
    return quality.regions_without_variants(narrow, region_interval_join(records, narrow))


# -- sinks ------------------------------------------------------------------


@query(with_views("v_dosage") + """
    SELECT locus, iid, chrom, pos, marker_id, ref, alt, round(af, 6) AS af, round(dosage, 6) AS dosage
    FROM v_dosage""")
def write_dosage(spark, sf_dir):
    path = new_path(spark, "dosage-table")
    sinks.write_dosage(v_dosage(spark, sf_dir), path)
    return rounded(spark.read.parquet(path), 6, "af", "dosage")


@query(with_views("v_dosage", "v_traits", "v_covariates", extra=[("pats", PATTERN_CTE)]) + """
    SELECT p.locus, 'clinical' AS dataset, p.iid, p.pattern, t.acct_bal,
           round(t.order_total, 6) AS order_total, c."Age", c."Sex"
    FROM pats p JOIN v_traits t ON p.iid = t.iid JOIN v_covariates c ON p.iid = c.iid""")
def write_merged(spark, sf_dir):
    path = new_path(spark, "merged")
    wide = phenotypes(spark, sf_dir)["clinical"].withColumn("dataset", F.lit("clinical"))
    merged = covariate_join(
        genotype_phenotype_join(association(spark, sf_dir).genotypes, wide), v_covariates(spark, sf_dir)
    )
    sinks.write_merged(merged, path)
    return rounded(spark.read.parquet(path), 6, "order_total")


def merged(spark: SparkSession, sf_dir: str, min_ac: float = 150) -> DataFrame:
    counts = {name: len(t.columns) - 1 for name, t in phenotypes(spark, sf_dir).items()}
    return merged_counts(
        v_dosage(spark, sf_dir), min_ac, counts, len(v_covariates(spark, sf_dir).columns) - 1
    )


MERGED_CTE = """
    SELECT a.locus, d.dataset, a.n_sample, a.n_snps, coalesce(k.n_kept, 0) AS n_kept, d.n_traits
    FROM (SELECT locus, count(DISTINCT iid) AS n_sample, count(DISTINCT chrom || ':' || pos) AS n_snps
          FROM v_dosage GROUP BY locus) a
    LEFT JOIN (SELECT v.locus, count(DISTINCT (v.chrom, v.pos, v.ref, v.alt)) AS n_kept
               FROM v_dosage v JOIN (SELECT locus, count(DISTINCT iid) n FROM v_dosage GROUP BY locus) c
                 ON v.locus = c.locus
               WHERE v.af * c.n > 150 AND v.af * c.n < c.n - 150 GROUP BY v.locus) k ON a.locus = k.locus
    CROSS JOIN (VALUES ('clinical', 2), ('proteomics', 2)) d(dataset, n_traits)"""


@query(with_views("v_dosage", extra=[("m", MERGED_CTE)]) + """
    , t AS (SELECT locus, dataset,
      'Minimum allele count (AC) is set to 150 . Given ' || n_sample ||
      ' samples, variants with AC below 150 and above ' || (n_sample - 150) || ' are removed.' AS l1,
      'Of ' || n_snps || ' variants, ' || n_kept ||
      ' left with minor allele count > 150 for building haplotypes.' AS l2,
      'Merged data comprised ' || n_kept || ' variants, ' || n_traits || ' traits, and 2 covariates.' AS l3
      FROM m)
    SELECT locus, dataset, unnest([l1, l2, l3]) AS line FROM t""")
def write_summary_text(spark, sf_dir):
    path = new_path(spark, "summary-text")
    sinks.write_summary_text(summary_text(merged(spark, sf_dir)), path)
    lines = spark.read.text(path).filter(F.length("value") > 0)
    return lines.select("locus", "dataset", F.col("value").alias("line"))


@query(ASSOCIATION_CTES + """
    SELECT locus, dataset, trait_name, term, round(estimate, 4) AS estimate,
           round(std_error, 4) AS std_error FROM coefs""")
def write_associations(spark, sf_dir):
    path = new_path(spark, "associations")
    a = association(spark, sf_dir)
    sinks.write_associations(a.coefficients, a.haplotypes, path)
    coefs = spark.read.parquet(f"{path}/coefficients")
    return rounded(
        coefs.select("locus", "dataset", "trait_name", "term", "estimate", "std_error"),
        4, "estimate", "std_error",
    )


@query(ASSOCIATION_CTES + """
    SELECT locus, dataset, trait_name, haplo, round(estimate, 4) AS estimate,
           round(std_error, 4) AS std_error, round(statistic, 4) AS statistic
    FROM results WHERE haplo <> 'Ref.'""")
def write_tidied(spark, sf_dir):
    path = new_path(spark, "tidied")
    sinks.write_tidied(tidied_results(association(spark, sf_dir).results), path)
    return rounded(spark.read.parquet(path).drop("p_value"), 4, "estimate", "std_error", "statistic")


@query(ASSOCIATION_CTES + """
    SELECT locus, dataset, trait_name, haplo, round(estimate, 4) AS estimate,
           round(std_error, 4) AS std_error, 'Yes' AS associated
    FROM results WHERE significant""")
def write_signif_csv(spark, sf_dir):
    path = new_path(spark, "significant")
    sinks.write_significant_csv(significant_results(association(spark, sf_dir).results), path)
    back = spark.read.csv(
        path, header=True,
        schema="locus string, dataset string, trait_name string, haplo string, estimate double, `std.error` double, "
        "`p.value` double, associated string",
    )
    return back.select(
        "locus", "dataset", "trait_name", "haplo", F.round("estimate", 4).alias("estimate"),
        F.round("`std.error`", 4).alias("std_error"), "associated",
    )


@query(DOCUMENTS_CTE + """
    SELECT locus, variant, most_severe_consequence, n_transcripts, first_transcript, n_frequencies
    FROM documents_facts""")
def write_annotation_json(spark, sf_dir):
    path = new_path(spark, "annotation-json")
    docs = v_annotation(spark, sf_dir)
    sinks.write_annotation_json(docs, path)
    return _document_facts(spark.read.schema(docs.schema).json(path))


@query(SUMMARY_CTE + "SELECT locus, * EXCLUDE (locus) FROM summary_by_locus")
def write_annotation_summary(spark, sf_dir):
    path = new_path(spark, "summary-by-locus")
    sinks.write_annotation_summary(summarize_annotations(v_annotation(spark, sf_dir)), path)
    return rounded(annotations.scan_annotation_summary(spark, path), 6, *annotations.FREQUENCY_COLUMNS)
