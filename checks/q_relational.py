"""Filters, reshaping, joins, counts, histograms and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import phenotypes, rounded
from checks.haplo_sql import PATTERN_CTE
from checks.q_sources import MERGED_CTE, merged, region_variants
from checks.summary_sql import SUMMARY_CTE
from checks.views import (
    DATASETS,
    N_SITES,
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
from locusframe.functions import genotype, keys, labels
from locusframe.operators import annotate, freq, merge, reshape, variants
from locusframe.operators.display import display_annotation
from locusframe.plans.association import kept_sites, kept_variants, long_traits
from locusframe.session import new_path
from locusframe.sources import tables
from locusframe.sources.lookup import store_lookup

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        Q[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


# -- filters and projections -------------------------------------------------


@query(with_views("v_variants") + """
    SELECT chrom, pos, id, ref, alt, round(af, 6) AS af FROM v_variants
    WHERE chrom = '3' AND pos <= 420000 AND pos + length(ref) - 1 >= 20000""")
def region_filter(spark, sf_dir):
    return rounded(variants.region_filter(v_variants(spark, sf_dir), "3", 20000, 420000), 6, "af")


_DERIVED = [("n", "SELECT locus, count(DISTINCT iid) AS n_sample FROM v_dosage GROUP BY locus"),
            ("derived", """SELECT v.locus, v.iid, n.n_sample,
                'chr' || v.chrom || '_' || v.pos || '_' || v.ref || '_' || v.alt AS snp_id,
                CASE WHEN af > 0.5 THEN 1 - af ELSE af END AS maf, af * n.n_sample AS ac
                FROM v_dosage v JOIN n ON v.locus = n.locus""")]


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    dosage = v_dosage(spark, sf_dir)
    return variants.allele_count_derive(dosage, variants.sample_counts(dosage))


@query(with_views("v_dosage", extra=_DERIVED) + """
    SELECT locus, iid, n_sample, snp_id, round(maf, 6) AS maf, round(ac, 6) AS ac FROM derived""")
def allele_count_derive(spark, sf_dir):
    out = _derived(spark, sf_dir).select("locus", "iid", "n_sample", "snp_id", "maf", "ac")
    return rounded(out, 6, "maf", "ac")


@query(with_views("v_dosage", extra=_DERIVED) + """
    SELECT locus, iid, snp_id FROM derived WHERE ac > 150 AND ac < n_sample - 150""")
def allele_count_band_filter(spark, sf_dir):
    return variants.allele_count_band_filter(_derived(spark, sf_dir), 150).select("locus", "iid", "snp_id")


_NAMED = """SELECT CASE l_linenumber WHEN 1 THEN 'chrX_' || l_partkey || '_A_T'
    WHEN 2 THEN 'chr7_' || l_partkey || '_A_<DEL>' WHEN 3 THEN 'trait_' || l_partkey WHEN 4 THEN 'IID'
    ELSE 'chr' || (l_suppkey % 22 + 1) || '_' || l_partkey || '_A_CTT' END AS name FROM lineitem"""


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    part, no = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    return line.select(
        F.when(no == 1, F.concat(F.lit("chrX_"), part, F.lit("_A_T")))
        .when(no == 2, F.concat(F.lit("chr7_"), part, F.lit("_A_<DEL>")))
        .when(no == 3, F.concat(F.lit("trait_"), part))
        .when(no == 4, F.lit("IID"))
        .otherwise(F.concat(F.lit("chr"), (F.col("l_suppkey") % 22 + 1).cast("string"),
                            F.lit("_"), part, F.lit("_A_CTT")))
        .alias("name")
    )


_NAME_TEST = "regexp_matches(name, 'chr[0-9]{0,2}_[0-9]+_[ATCG]+_[ATCG]+', 'i')"


@query(f"SELECT name FROM ({_NAMED}) WHERE {_NAME_TEST}")
def variant_column_select(spark, sf_dir):
    return variants.variant_column_select(_named(spark, sf_dir))


@query(f"SELECT name FROM ({_NAMED}) WHERE NOT {_NAME_TEST} AND name <> 'IID'")
def non_variant_select(spark, sf_dir):
    return variants.non_variant_select(_named(spark, sf_dir))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS iid,
           TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS price,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
           TRY_CAST(o_orderpriority AS DOUBLE) AS words FROM orders""")
def trait_cast_numeric(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("iid"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.col("o_orderpriority").alias("words"),
    )
    return tables.to_numeric(text)


@query(SUMMARY_CTE + """
    SELECT locus, split_part(variant, ':', 1) || ':' || split_part(variant, ':', 2) AS snpid, variant,
           replace(replace(replace(most_severe_consequence, '_variant', ''), '3_prime_UTR', 'UTR3'''),
                   '5_prime_UTR', 'UTR5''') AS annot,
           gene_symbol AS gene FROM summary_by_locus""")
def project_rename_relocate(spark, sf_dir):
    return display_annotation(annotate.summarize_annotations(v_annotation(spark, sf_dir)))


@query(with_views("v_transcripts") + """
    SELECT variant, arg_min(term, event_id) AS most_severe_consequence FROM v_transcripts
    WHERE user_id % 5 <> 0 AND user_id % 7 <> 0 GROUP BY variant""")
def annotation_row_guard(spark, sf_dir):
    docs = v_annotation(spark, sf_dir)
    user = (F.split("variant", ":")[1].cast("bigint") / 100).cast("bigint")
    holes = docs.withColumn(
        "annotation", F.when(user % 5 != 0, F.col("annotation")).when(user % 10 == 0, F.slice("annotation", 1, 0))
    ).withColumn("variant", F.when(user % 7 == 0, F.concat("variant", F.lit(":x"))).otherwise(F.col("variant")))
    good, _ = annotate.split_variant_keys(annotate.annotation_row_guard(holes))
    return good.select("variant", F.col("record")["most_severe_consequence"].alias("most_severe_consequence"))


# -- reshape -----------------------------------------------------------------

_SITE_IDS = [
    f"chr{chrom}_{(s + 1) * 1000}_{'ACG'[s % 3]}_{'TG' if s == 5 else 'T'}"
    for chrom in ("22", "5") for s in range(N_SITES)
]
_PIVOT = ", ".join(
    f"round(max(CASE WHEN 'chr' || chrom || '_' || pos || '_' || ref || '_' || alt = '{i}' "
    f"THEN dosage END), 6) AS \"{i}\"" for i in _SITE_IDS
)


@query(with_views("v_dosage") + f"SELECT locus, iid, {_PIVOT} FROM v_dosage GROUP BY locus, iid")
def genotype_pivot(spark, sf_dir):
    wide = reshape.genotype_pivot(kept_variants(v_dosage(spark, sf_dir), 1), _SITE_IDS)
    return rounded(wide, 6, *_SITE_IDS)


@query(with_views("v_traits", "v_covariates") + """
    , w AS (SELECT t.*, c."Age", c."Sex" FROM v_traits t JOIN v_covariates c ON t.iid = c.iid)
    SELECT iid, "Age", "Sex", trait_name, round(trait, 6) AS trait
    FROM w UNPIVOT (trait FOR trait_name IN (acct_bal, order_total, order_count, founder_score))""")
def trait_unpivot(spark, sf_dir):
    wide = v_traits(spark, sf_dir).join(v_covariates(spark, sf_dir), "iid")
    return rounded(reshape.trait_unpivot(wide, ["Age", "Sex"]), 6, "trait")


# -- joins -------------------------------------------------------------------


@query(with_views("v_dosage", "v_traits", extra=[("pats", PATTERN_CTE)]) + """
    SELECT p.locus, p.iid, p.pattern, t.acct_bal, t.order_count FROM pats p JOIN v_traits t ON p.iid = t.iid""")
def genotype_phenotype_join(spark, sf_dir):
    dosage = v_dosage(spark, sf_dir)
    vectors = reshape.genotype_vectors(dosage, kept_sites(dosage, 1))
    wide = v_traits(spark, sf_dir).select("iid", "acct_bal", "order_count")
    return merge.genotype_phenotype_join(vectors, wide)


@query(with_views("v_traits", "v_covariates") + """
    SELECT t.iid, t.acct_bal, c."Age", c."Sex" FROM v_traits t JOIN v_covariates c ON t.iid = c.iid""")
def covariate_join(spark, sf_dir):
    wide = v_traits(spark, sf_dir).select("iid", "acct_bal")
    return merge.covariate_join(merge.covariate_join(wide, v_covariates(spark, sf_dir)), None)


@query(with_views("v_region_variants") + """
    SELECT locus, beg, "end", chrom, pos, id, ref, alt, round(af, 6) AS af FROM v_region_variants""")
def region_interval_join(spark, sf_dir):
    return rounded(region_variants(spark, sf_dir), 6, "af")


@query(with_views("v_regions") + """
    SELECT r.*, d.dataset FROM v_regions r CROSS JOIN (VALUES ('clinical'), ('proteomics')) d(dataset)""")
def locus_dataset_cross(spark, sf_dir):
    return variants.locus_dataset_cross(v_regions(spark, sf_dir), list(DATASETS))


_ANNOTATED = [
    ("asked", """SELECT DISTINCT chrom, pos, ref, alt, chrom || ':' || pos || ':' || ref || ':' || alt AS variant
        FROM v_variants"""),
    ("lookup", """SELECT chrom, pos, allele, min(id) AS annotation FROM (
        SELECT chrom, pos, id, CASE WHEN pos % 1000 IN (2, 4) THEN
             CASE WHEN length(alt) > length(ref) AND starts_with(alt, ref) THEN substr(alt, length(ref) + 1)
                  WHEN length(ref) > length(alt) AND starts_with(ref, alt) THEN '-' ELSE alt END
           ELSE CASE WHEN length(ref) > length(alt) AND starts_with(ref, alt) THEN substr(ref, length(alt) + 1)
                  WHEN length(alt) > length(ref) AND starts_with(alt, ref) THEN '-' ELSE ref END END AS allele
        FROM v_variants WHERE pos % 1000 <> 5) GROUP BY chrom, pos, allele"""),
    ("annotated", """SELECT a.variant, a.chrom, a.pos, a.ref, a.alt, coalesce(d.annotation, s.annotation) AS annotation,
        CASE WHEN d.annotation IS NOT NULL THEN false WHEN s.annotation IS NOT NULL THEN true END AS swapped
        FROM asked a
        LEFT JOIN lookup d ON a.chrom = d.chrom AND a.pos = d.pos AND d.allele =
          CASE WHEN length(alt) > length(ref) AND starts_with(alt, ref) THEN substr(alt, length(ref) + 1)
               WHEN length(ref) > length(alt) AND starts_with(ref, alt) THEN '-' ELSE alt END
        LEFT JOIN lookup s ON a.chrom = s.chrom AND a.pos = s.pos AND s.allele =
          CASE WHEN length(ref) > length(alt) AND starts_with(ref, alt) THEN substr(ref, length(alt) + 1)
               WHEN length(alt) > length(ref) AND starts_with(alt, ref) THEN '-' ELSE ref END"""),
]


def annotation_asked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Distinct variants, and a lookup that knows most of them."""
    v = v_variants(spark, sf_dir)
    key = keys.variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))
    asked = v.select("chrom", "pos", "ref", "alt", key.alias("variant")).distinct()
    direct = (F.col("pos") % 1000).isin(2, 4)
    allele = F.when(direct, keys.lookup_allele(F.col("ref"), F.col("alt"))).otherwise(
        keys.lookup_allele(F.col("alt"), F.col("ref"))
    )
    lookup = (
        v.filter(F.col("pos") % 1000 != 5)
        .groupBy("chrom", "pos", allele.alias("allele"))
        .agg(F.min("id").alias("annotation"))
    )
    return asked, lookup


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.annotate_variants(*annotation_asked(spark, sf_dir))


@query(with_views("v_variants", extra=_ANNOTATED) + "SELECT variant, annotation, swapped FROM annotated")
def annotate_stored_lookup(spark, sf_dir):
    """The lookup stored by position, which the join leaves where it is."""
    asked, lookup = annotation_asked(spark, sf_dir)
    stored = store_lookup(lookup, new_path(spark, "annotation-lookup"), 32)
    return annotate.annotate_variants(asked, stored).select("variant", "annotation", "swapped")


@query(with_views("v_variants", extra=_ANNOTATED) + "SELECT variant, annotation, swapped FROM annotated")
def annotate_variants_join(spark, sf_dir):
    return annotated(spark, sf_dir).select("variant", "annotation", "swapped")


@query(with_views("v_variants", extra=_ANNOTATED) + """
    SELECT chrom, count(annotation) AS n_annotated, count(*) AS n_total FROM annotated GROUP BY chrom""")
def annotation_success_count(spark, sf_dir):
    return annotate.success_count(annotated(spark, sf_dir), ["chrom"])


# -- counts ------------------------------------------------------------------


@query(with_views("v_dosage") + """
    SELECT locus, count(DISTINCT iid) AS n_sample, count(DISTINCT chrom || ':' || pos) AS n_snps
    FROM v_dosage GROUP BY locus""")
def sample_variant_counts(spark, sf_dir):
    return variants.sample_variant_counts(v_dosage(spark, sf_dir))


@query(with_views("v_dosage", extra=[("m", MERGED_CTE)]) + """
    SELECT locus, dataset, n_sample, n_snps, 150 AS min_ac, n_sample - 150 AS max_ac, n_kept, n_traits,
           2 AS n_covariates, n_traits + 1 AS legacy_n_traits, 3 AS legacy_n_covariates FROM m""")
def merged_summary(spark, sf_dir):
    return merged(spark, sf_dir)


CLEAN_SQL = ("replace(replace(replace(replace({0}, '_variant', ''), '3_prime_UTR', 'UTR3'''), "
          "'5_prime_UTR', 'UTR5'''), '_', ' ')")
_GENE_COUNTS = [("gc", f"""SELECT locus, {CLEAN_SQL.format('most_severe_consequence')} AS annot, gene_symbol AS gene,
    count(*) AS count_snp FROM summary_by_locus GROUP BY ALL""")]
_WITH_COUNTS = SUMMARY_CTE + ", gc AS (" + _GENE_COUNTS[0][1] + ")\n"


def _gene_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.gene_counts(annotate.summarize_annotations(v_annotation(spark, sf_dir)))


@query(_WITH_COUNTS + "SELECT locus, annot, gene, count_snp FROM gc")
def annotation_gene_counts(spark, sf_dir):
    return _gene_counts(spark, sf_dir)


def _legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = v_transcripts(spark, sf_dir)
    return t.select(F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")).alias("locus"),
                    F.col("term").alias("vep_annot"))


@query(with_views("v_transcripts") + f"""
    SELECT locus, {CLEAN_SQL.format('term')} AS annot, count(*) AS count_snp FROM v_transcripts GROUP BY ALL""")
def annotation_counts(spark, sf_dir):
    return annotate.consequence_counts(_legacy(spark, sf_dir))


@query(_WITH_COUNTS + """
    , p AS (SELECT *, CAST(round_even(count_snp / sum(count_snp) OVER (PARTITION BY locus) * 100, 0) AS BIGINT)
              AS percentage FROM gc)
    SELECT *, count_snp || ' (%' || percentage || ')' AS des_stat FROM p""")
def annotation_percentage(spark, sf_dir):
    return annotate.count_percentages(_gene_counts(spark, sf_dir))


@query(_WITH_COUNTS + """
    , r AS (SELECT locus, annot, row_number() OVER (PARTITION BY locus ORDER BY avg(-count_snp), annot) AS annot_rank
            FROM gc GROUP BY locus, annot)
    SELECT gc.*, r.annot_rank FROM gc JOIN r ON gc.locus = r.locus AND gc.annot = r.annot""")
def annotation_rank(spark, sf_dir):
    return annotate.rank_by_count(_gene_counts(spark, sf_dir))


_AFC = [("x", "SELECT locus, CASE WHEN af <= 0.5 THEN af ELSE 1 - af END AS afc FROM v_region_variants")]


@query(with_views("v_region_variants", extra=_AFC) + """
    , s AS (SELECT locus, count(*) AS n, max(afc) - min(afc) AS span,
              2 * (quantile_cont(afc, 0.75) - quantile_cont(afc, 0.25)) / power(count(*), 1.0::DOUBLE / 3) AS width
            FROM x GROUP BY locus)
    SELECT locus, n, round(width, 6) AS width, CASE WHEN width > 0 THEN CAST(ceil(span / width) AS BIGINT) END AS bins FROM s""")
def af_bin_width(spark, sf_dir):
    return rounded(freq.bin_width(region_variants(spark, sf_dir)), 6, "width")


def _round_sql(lo: str, hi: str, n: int, source: str) -> str:
    """Step of about ``n`` round intervals for each row of ``source``."""
    return f"""
      SELECT *, base * CASE WHEN cell <= 1.4 * base THEN 1 WHEN cell <= 2.8 * base THEN 2
                            WHEN cell <= 7 * base THEN 5 ELSE 10 END AS step
      FROM (SELECT *, power(10.0::DOUBLE, floor(log10(cell))) AS base
            FROM (SELECT *, ({hi} - {lo}) / {n} AS cell FROM {source}))"""


_BREAKS = [
    *_AFC,
    ("ends", "SELECT locus, min(afc) AS lo, max(afc) AS hi FROM x GROUP BY locus"),
    ("grid", "SELECT locus, step, floor(lo / step + 1e-10) AS first, ceil(hi / step - 1e-10) AS last FROM ("
             + _round_sql("lo", "hi", 7, "ends") + ")"),
    ("bins", """SELECT locus, step, first, unnest(range(1, CAST(last - first AS BIGINT) + 1)) AS bin FROM grid"""),
    ("hist", """SELECT b.locus, b.bin, (b.first + b.bin - 1) * b.step AS beg, (b.first + b.bin) * b.step AS "end",
        count(x.afc) AS n FROM bins b LEFT JOIN x ON x.locus = b.locus
         AND x.afc <= (b.first + b.bin + 1e-7) * b.step
         AND (x.afc > (b.first + b.bin - 1 + 1e-7) * b.step OR b.bin = 1) GROUP BY ALL"""),
]


@query(with_views("v_region_variants", extra=_BREAKS) + """
    SELECT locus, bin, round(beg, 6) AS beg, round("end", 6) AS "end", n FROM hist""")
def af_histogram_breaks(spark, sf_dir):
    return rounded(freq.histogram_breaks(region_variants(spark, sf_dir)), 6, "beg", "end")


@query(with_views("v_region_variants", extra=_BREAKS) + """
    , c AS (SELECT locus, CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) AS DOUBLE) AS hi FROM hist GROUP BY locus)
    SELECT locus, ceil(hi / step - 1e-10) * step AS y_limit FROM (""" + _round_sql("lo", "hi", 5, "c") + ")")
def af_histogram_axis(spark, sf_dir):
    return freq.count_axis_limit(freq.histogram_breaks(region_variants(spark, sf_dir)))


@query(with_views("v_region_variants", extra=_AFC) + """
    , e AS (SELECT locus, min(afc) AS lo, (max(afc) - min(afc)) / 29 AS w FROM x GROUP BY locus)
    , h AS (SELECT x.locus, CAST(greatest(ceil((afc - lo) / w + 0.5 - 1e-8), 1) AS BIGINT) AS bin, count(*) AS n
    FROM x JOIN e ON x.locus = e.locus GROUP BY ALL)
    SELECT e.locus, b.bin, coalesce(h.n, 0) AS n
    FROM e CROSS JOIN (SELECT unnest(range(1, 31)) AS bin) b LEFT JOIN h ON h.locus = e.locus AND h.bin = b.bin""")
def af_histogram_30(spark, sf_dir):
    return freq.histogram_30(region_variants(spark, sf_dir))


def _summary_columns(name: str, *columns: str):
    def run(spark, sf_dir):
        summary = annotate.summarize_annotations(v_annotation(spark, sf_dir))
        frequencies = [c for c in columns if c.startswith("gnomad")]
        return rounded(summary.select("variant", *columns), 6, *frequencies)

    run.__name__ = name
    return query(SUMMARY_CTE + f"SELECT variant, {', '.join(columns)} FROM summary")(run)


consequence_sets = _summary_columns("consequence_sets", "all_consequences", "coding_consequences")
protein_changes = _summary_columns("protein_changes", "protein_changes")
main_transcript = _summary_columns(
    "main_transcript", "impact", "gene_id", "gene_symbol", "transcript_id", "biotype", "hgnc_id",
    "sift_prediction", "polyphen_prediction",
)
colocated_rs_clinsig = _summary_columns("colocated_rs_clinsig", "rs_ids", "clinical_significance")
population_frequency = _summary_columns(
    "population_frequency", "gnomad_af", "gnomad_afr_af", "gnomad_eur_af", "gnomad_eas_af"
)
yes_no_flag = _summary_columns("yes_no_flag", "canonical_transcript")
default_blank = _summary_columns("default_blank", "hgnc_id", "protein_changes", "rs_ids")


# -- scalar functions --------------------------------------------------------


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE CAST(l_suppkey % 22 + 1 AS VARCHAR) END AS chrom,
           CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE l_partkey END AS pos,
           CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE l_returnflag END AS ref,
           CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE l_linestatus END AS alt FROM lineitem""")
def parse_variant_key(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    pos = F.when(F.col("l_linenumber") == 2, F.lit("x1")).otherwise(F.col("l_partkey").cast("string"))
    text = F.concat_ws(":", (F.col("l_suppkey") % 22 + 1).cast("string"), pos, "l_returnflag", "l_linestatus")
    text = F.when(F.col("l_linenumber") == 3, F.concat(text, F.lit(":T"))).otherwise(text)
    return line.select("l_orderkey", "l_linenumber", keys.parse_variant_key(text).alias("k")).select(
        "l_orderkey", "l_linenumber", "k.*"
    )


_PAIR = """SELECT p_partkey, substr(p_type, 1, 1 + p_size % 3) AS ref,
    CASE p_size % 4 WHEN 0 THEN substr(p_type, 1, 1 + p_size % 3) || 'TT' WHEN 1 THEN substr(p_type, 1, 1)
    WHEN 2 THEN 'G' ELSE 'TAC' END AS alt FROM part"""


@query(f"""SELECT p_partkey, ref, alt,
    CASE WHEN length(alt) > length(ref) AND starts_with(alt, ref) THEN substr(alt, length(ref) + 1)
         WHEN length(ref) > length(alt) AND starts_with(ref, alt) THEN '-' ELSE alt END AS allele FROM ({_PAIR})""")
def api_allele(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    ref = F.substring("p_type", F.lit(1), 1 + size % 3)
    alt = (
        F.when(size % 4 == 0, F.concat(ref, F.lit("TT"))).when(size % 4 == 1, F.substring("p_type", 1, 1))
        .when(size % 4 == 2, "G").otherwise("TAC")
    )
    pair = part.select("p_partkey", ref.alias("ref"), alt.alias("alt"))
    return pair.withColumn("allele", keys.lookup_allele(F.col("ref"), F.col("alt")))


@query(with_views("v_regions") + """
    SELECT locus, chrom || ':' || beg || '-' || "end" AS region FROM v_regions""")
def region_string(spark, sf_dir):
    return v_regions(spark, sf_dir).select(
        "locus", keys.region_string(F.col("chrom"), F.col("beg"), F.col("end")).alias("region")
    )


@query(with_views("v_variants") + """
    SELECT id, round(CASE WHEN af <= 0.5 THEN af ELSE 1 - af END, 6) AS afc FROM v_variants""")
def fold_af(spark, sf_dir):
    return rounded(freq.folded(v_variants(spark, sf_dir)).select("id", "afc"), 6, "afc")


@query(with_views("v_transcripts") + f"""
    SELECT event_id, replace(replace(replace(term, '_variant', ''), '3_prime_UTR', 'UTR3'''), '5_prime_UTR', 'UTR5''') AS annot,
           {CLEAN_SQL.format('term')} AS annot_spaced FROM v_transcripts""")
def clean_consequence(spark, sf_dir):
    annot = labels.clean_consequence(F.col("term"))
    return v_transcripts(spark, sf_dir).select(
        "event_id", annot.alias("annot"), labels.spaced(annot).alias("annot_spaced")
    )


@query(with_views("v_transcripts") + """
    SELECT event_id, replace(regexp_replace(replace(term, '_variant', ''), '3_prime_[UTRutr|]', 'UTR3''', 'g'),
           '5_prime_UTR', 'UTR5''') AS annot FROM v_transcripts""")
def clean_consequence_legacy(spark, sf_dir):
    return v_transcripts(spark, sf_dir).select(
        "event_id", labels.clean_consequence_legacy(F.col("term")).alias("annot")
    )


@query(f"""SELECT name, CASE WHEN regexp_matches(name, '[0-9]+_[0-9]+')
    THEN replace(regexp_extract(name, '[0-9]+_[0-9]+'), '_', ':') END AS snpid FROM ({_NAMED})""")
def snpid_from_key(spark, sf_dir):
    return _named(spark, sf_dir).select(
        "name", keys.position_key_from_snp_id(F.col("name")).alias("snpid")
    )


@query("""
    SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Ref.' WHEN 2 THEN 'Hrare'
      ELSE 'H' || CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 3
             THEN lpad(CAST(l_suppkey AS VARCHAR), 3, '0') ELSE CAST(l_suppkey AS VARCHAR) END END AS label
    FROM lineitem""")
def pad_haplotype_label(spark, sf_dir):
    no = F.col("l_linenumber")
    term = (
        F.when(no == 1, "haplo.base").when(no == 2, "haplo_genotype.rare")
        .otherwise(F.concat(F.lit("haplo_genotype."), F.col("l_suppkey").cast("string")))
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", labels.pad_haplotype_label(term).alias("label")
    )


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS INT) AS g FROM lineitem")
def round_dosage(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", genotype.round_dosage(F.col("l_quantity") / 2).alias("g")
    )


@query(with_views("v_dosage") + """
    SELECT locus, iid, pos, CASE g WHEN 2 THEN 2 ELSE 1 END AS a1, CASE g WHEN 0 THEN 1 ELSE 2 END AS a2
    FROM (SELECT locus, iid, pos, CAST(round_even(dosage, 0) AS INT) AS g FROM v_dosage)""")
def genotype_to_alleles(spark, sf_dir):
    pair = genotype.genotype_to_alleles(genotype.round_dosage(F.col("dosage")))
    return v_dosage(spark, sf_dir).select("locus", "iid", "pos", pair[0].alias("a1"), pair[1].alias("a2"))


@query("SELECT l_orderkey, l_linenumber, nullif(l_linenumber % 3, 0) AS code FROM lineitem")
def missing_genotype_code(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", genotype.missing_code(F.col("l_linenumber") % 3).alias("code")
    )


@query("""
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'NA' ELSE p_brand END AS gene FROM part""")
def blank_to_label(spark, sf_dir):
    gene = F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", labels.blank_to_label(gene).alias("gene"))


@query(with_views("v_traits") + """
    SELECT iid, replace(trait_name, '_', ':') AS trait_name, round(trait, 6) AS trait
    FROM v_traits UNPIVOT (trait FOR trait_name IN (acct_bal, order_total, order_count, founder_score))""")
def trait_display_name(spark, sf_dir):
    long = reshape.trait_unpivot(v_traits(spark, sf_dir))
    return rounded(long.withColumn("trait_name", labels.trait_display_name(F.col("trait_name"))), 6, "trait")


@query("""
    SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'chr' || p_size || ':' || p_partkey || '_A_T'
      ELSE p_partkey || ':' || p_size || '_A_T' END AS label FROM part""")
def clean_snp_label(spark, sf_dir):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    name = F.when(
        F.col("p_size") % 2 == 0, F.concat(F.lit("chr"), size, F.lit("_"), key, F.lit("_A_T"))
    ).otherwise(F.concat(F.lit("chr_"), key, F.lit("_"), size, F.lit("_A_T")))
    return table(spark, sf_dir, "part").select("p_partkey", labels.clean_snp_label(name).alias("label"))


@query(with_views("v_traits", "v_covariates") + """
    SELECT t.trait_name, unnest(range(4)) AS position,
           unnest(['(Intercept)', 'haplotype', 'Age', 'Sex']) AS term,
           unnest(['intercept', 'haplotype', 'covariate', 'covariate']) AS kind, t.n AS n_rows
    FROM (SELECT trait_name, count(*) AS n FROM v_traits
          UNPIVOT (trait FOR trait_name IN (acct_bal, order_total, order_count, founder_score)) GROUP BY trait_name) t""")
def model_formula(spark, sf_dir):
    names = [c for c in v_covariates(spark, sf_dir).columns if c != "iid"]
    terms = merge.model_terms(["haplotype"], names, rare=False)
    listed = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(k).alias("kind")) for t, k in terms])
    rows = long_traits(phenotypes(spark, sf_dir)).groupBy("trait_name").agg(F.count("*").alias("n_rows"))
    return rows.select("trait_name", "n_rows", F.posexplode(listed).alias("position", "t")).select(
        "trait_name", "position", "t.term", "t.kind", "n_rows"
    )
