"""Genotype-shaped views over the driver's tables.

The tables hold no genetics, so every query reads real rows of them through
the small projections below. ``SQL`` states the same views for the oracle.
Work grows with the tables: customers are individuals, line items variants,
nations regions, events transcripts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.session import materialize, spread

_STORE: dict[tuple[str, str, str], object] = {}


def clear_store() -> None:
    _STORE.clear()


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    """Result of ``build()``, kept for this application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORE:
        _STORE[key] = build()
    return _STORE[key]


N_SITES = 8
DATASETS = ("clinical", "proteomics")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return stored(spark, sf_dir, name, lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def v_variants(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Line items as variants; REF and ALT from the two flags."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        (F.col("l_suppkey") % 22 + 1).cast("string").alias("chrom"),
        (F.col("l_partkey") * 1000 + F.col("l_linenumber")).alias("pos"),
        F.concat_ws("_", F.lit("rs"), "l_orderkey", "l_linenumber").alias("id"),
        F.when(F.col("l_returnflag") == "A", "A")
        .when(F.col("l_returnflag") == "N", "CT")
        .otherwise("G").alias("ref"),
        F.when(F.col("l_linestatus") == "O", "C").otherwise("CTT").alias("alt"),
        (F.col("l_discount") * 10).alias("af"), *extra,
    )


def v_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_name").alias("locus"),
        (F.col("n_nationkey") % 22 + 1).cast("string").alias("chrom"),
        (F.col("n_nationkey") * 10000).cast("bigint").alias("beg"),
        (F.col("n_nationkey") * 10000 + 400000).cast("bigint").alias("end"),
    )


def founder_bits(slot: Column) -> Column:
    """Five founder haplotypes as 8-bit patterns, weighted 6:4:3:2:1."""
    return (
        F.when(slot < 6, 0).when(slot < 10, 21).when(slot < 13, 42).when(slot < 15, 112).otherwise(147)
    )


def v_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers x 8 sites x 2 loci with hard calls g = 0/1/2."""
    c = stored(
        spark, sf_dir, "people",
        lambda: spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), width=2 * N_SITES),
    )
    loci = F.array(*[F.struct(F.lit(n).alias("locus"), F.lit(k).alias("k"), F.lit(ch).alias("chrom"))
                     for n, k, ch in (("LOCUS_A", 0, "22"), ("LOCUS_B", 1, "5"))])
    rows = c.select("*", F.inline(loci)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(N_SITES - 1))).alias("site")
    )
    key, k = F.col("c_custkey"), F.col("k")
    one = founder_bits((key * 7 + 3 + 5 * k) % 16)
    two = founder_bits((key * 11 + F.col("c_nationkey") + 3 * k) % 16)
    bit = F.pow(F.lit(2), F.col("site"))
    g = F.floor(one / bit) % 2 + F.floor(two / bit) % 2
    return rows.select(
        "locus", "chrom", "site", "c_custkey",
        F.concat(F.lit("0"), key.cast("string")).alias("iid"),
        ((F.col("site") + 1) * 1000).cast("bigint").alias("pos"),
        F.when(F.col("site") % 3 == 0, "A").when(F.col("site") % 3 == 1, "C").otherwise("G").alias("ref"),
        F.when(F.col("site") == 5, "TG").otherwise("T").alias("alt"),
        g.cast("int").alias("g"),
    )


def v_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALT frequency of each site of the two loci (16 rows)."""
    calls = v_calls(spark, sf_dir)
    keys = ["locus", "chrom", "pos", "ref", "alt"]
    return calls.groupBy(*keys).agg((F.sum("g") / (2 * F.count("*"))).alias("af")).select(
        "locus", "chrom", "pos",
        F.concat_ws("_", F.lit("rs"), "chrom", "pos").alias("id"), "ref", "alt", "af",
    )


def v_dosage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long dosage table, written once per application."""
    return stored(spark, sf_dir, "v_dosage", lambda: materialize(dosage_rows(spark, sf_dir), "dosage"))


def dosage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long dosage rows with a small imputation jitter around the calls."""
    calls = v_calls(spark, sf_dir)
    freq = v_frequencies(spark, sf_dir).select("locus", "pos", F.col("id").alias("marker_id"), "af")
    jitter = 0.05 * ((F.col("c_custkey") + F.col("site")) % 5)
    return calls.join(F.broadcast(freq), ["locus", "pos"]).select(
        "locus", "iid", "chrom", "pos", "marker_id", "ref", "alt", "af",
        (F.col("g") + jitter).alias("dosage"),
    )


def v_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide phenotype table: account balance, order total, order count, and
    a score that depends on two founders of the first locus."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    key = F.col("c_custkey")
    one, two = (key * 7 + 3) % 16, (key * 11 + F.col("c_nationkey")) % 16
    score = (
        F.col("c_acctbal") / 1000
        + F.when((one >= 6) & (one < 10), 2).otherwise(0)
        + F.when(two == 15, -3).otherwise(0)
    )
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("order_total"), F.count("*").alias("order_count")
    )
    return c.join(o, c.c_custkey == o.o_custkey).select(
        F.concat(F.lit("0"), F.col("c_custkey").cast("string")).alias("iid"),
        F.col("c_acctbal").alias("acct_bal"),
        (F.col("order_total") / 1000).alias("order_total"),
        F.col("order_count").cast("double").alias("order_count"),
        score.alias("founder_score"),
    )


def v_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("0"), F.col("c_custkey").cast("string")).alias("iid"),
        F.col("c_nationkey").cast("double").alias("Age"),
        (F.col("c_mktsegment") == "BUILDING").cast("double").alias("Sex"),
    )


_CONSEQUENCE = {
    "click": "intron_variant",
    "view": "3_prime_UTR_variant",
    "purchase": "missense_variant",
    "error": "5_prime_UTR_variant",
    "signup": "synonymous_variant",
}


def consequence(event_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, term in _CONSEQUENCE.items():
        out = F.when(event_type == name, F.lit(term)).otherwise(out)
    return out


def v_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transcripts of the variant ``user_id`` names."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id", "user_id", k.alias("k"), "value",
        consequence(F.col("event_type")).alias("term"),
        F.when(F.col("value") > 100, "protein_coding").otherwise("lncRNA").alias("biotype"),
        F.concat(F.lit("G"), (k % 10).cast("string")).alias("gene"),
    )


def v_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotation documents, written once per application."""
    return stored(
        spark, sf_dir, "v_annotation", lambda: materialize(annotation_rows(spark, sf_dir), "documents")
    )


def annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation documents, one per user, transcripts ordered by event."""
    t = v_transcripts(spark, sf_dir)
    text = F.lit(None).cast("string")

    def transcript(r: Column) -> Column:
        return F.struct(
            F.array(r["term"]).alias("consequence_terms"),
            r["biotype"].alias("biotype"),
            F.when(r["k"] % 3 == 0, r["k"]).cast("bigint").alias("protein_start"),
            F.when(r["k"] % 2 == 0, F.lit("A/T")).otherwise(F.lit("")).alias("amino_acids"),
            F.concat(F.lit("p."), r["k"].cast("string")).alias("hgvsp"),
            r["gene"].alias("gene_symbol"),
            F.concat(F.lit("ENSG"), r["gene"]).alias("gene_id"),
            F.concat(F.lit("ENST"), r["event_id"].cast("string")).alias("transcript_id"),
            F.when(r["k"] % 7 == 0, 1).alias("canonical"),
            text.alias("hgnc_id"),
            F.when(r["term"] == "missense_variant", "MODERATE").otherwise("MODIFIER").alias("impact"),
            text.alias("sift_prediction"),
            text.alias("polyphen_prediction"),
        )

    def located(r: Column) -> Column:
        return F.struct(
            F.when(r["k"] % 4 == 0, F.concat(F.lit("rs"), r["event_id"].cast("string")))
            .otherwise(F.concat(F.lit("COSV"), r["event_id"].cast("string"))).alias("id"),
            F.when(r["k"] % 5 == 0, F.array(F.when(r["k"] % 2 == 0, "benign").otherwise("pathogenic")))
            .alias("clin_sig"),
            F.when(
                r["k"] % 3 == 0,
                F.create_map(
                    F.when(r["k"] % 2 == 0, "T").otherwise("C"),
                    F.create_map(F.lit("gnomadg"), r["value"] / 1000, F.lit("gnomadg_afr"), r["value"] / 2000),
                ),
            ).alias("frequencies"),
        )

    docs = t.groupBy("user_id").agg(
        F.array_sort(
            F.collect_list(F.struct("event_id", "k", "value", "term", "biotype", "gene"))
        ).alias("rows"),
        F.min_by("term", "event_id").alias("most"),
    )
    record = F.struct(
        F.col("most").alias("most_severe_consequence"),
        F.lit("A").alias("input_ref_allele"),
        F.lit("T").alias("input_alt_allele"),
        F.transform("rows", transcript).alias("transcript_consequences"),
        F.transform("rows", located).alias("colocated_variants"),
    )
    key = F.concat(
        (F.col("user_id") % 22 + 1).cast("string"), F.lit(":"),
        (F.col("user_id") * 100).cast("string"), F.lit(":A:T"),
    )
    return docs.select(
        F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")).alias("locus"),
        key.alias("variant"), F.array(record).alias("annotation"),
    )


# The same views for the oracle, as WITH members.
SQL = {
    "v_variants": """
        SELECT CAST(l_suppkey % 22 + 1 AS VARCHAR) AS chrom,
               l_partkey * 1000 + l_linenumber AS pos,
               'rs_' || l_orderkey || '_' || l_linenumber AS id,
               CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'CT' ELSE 'G' END AS ref,
               CASE l_linestatus WHEN 'O' THEN 'C' ELSE 'CTT' END AS alt,
               l_discount * 10 AS af
        FROM lineitem""",
    "v_regions": """
        SELECT n_name AS locus, CAST(n_nationkey % 22 + 1 AS VARCHAR) AS chrom,
               CAST(n_nationkey * 10000 AS BIGINT) AS beg,
               CAST(n_nationkey * 10000 + 400000 AS BIGINT) AS "end"
        FROM nation""",
    "v_region_variants": """
        SELECT r.locus, r.beg, r."end", v.*
        FROM v_variants v JOIN v_regions r ON v.chrom = r.chrom
         AND v.pos <= r."end" AND v.pos + length(v.ref) - 1 >= r.beg""",
    "v_slots": """
        SELECT l.locus, l.chrom, s.site, c.c_custkey,
               (c.c_custkey * 7 + 3 + 5 * l.k) % 16 AS s1,
               (c.c_custkey * 11 + c.c_nationkey + 3 * l.k) % 16 AS s2
        FROM customer c
        CROSS JOIN (VALUES ('LOCUS_A', 0, '22'), ('LOCUS_B', 1, '5')) l(locus, k, chrom)
        CROSS JOIN (SELECT range AS site FROM range(8)) s""",
    "v_calls": """
        SELECT locus, chrom, site, c_custkey, '0' || c_custkey AS iid,
               CAST((site + 1) * 1000 AS BIGINT) AS pos,
               CASE site % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'G' END AS ref,
               CASE WHEN site = 5 THEN 'TG' ELSE 'T' END AS alt,
               CAST(floor(CASE WHEN s1 < 6 THEN 0 WHEN s1 < 10 THEN 21 WHEN s1 < 13 THEN 42
                               WHEN s1 < 15 THEN 112 ELSE 147 END / power(2, site)) AS INT) % 2
             + CAST(floor(CASE WHEN s2 < 6 THEN 0 WHEN s2 < 10 THEN 21 WHEN s2 < 13 THEN 42
                               WHEN s2 < 15 THEN 112 ELSE 147 END / power(2, site)) AS INT) % 2 AS g
        FROM v_slots""",
    "v_frequencies": """
        SELECT locus, chrom, pos, 'rs_' || chrom || '_' || pos AS id, ref, alt,
               sum(g) / (2.0::DOUBLE * count(*)) AS af
        FROM v_calls GROUP BY locus, chrom, pos, ref, alt""",
    "v_dosage": """
        SELECT c.locus, c.iid, c.chrom, c.pos, f.id AS marker_id, c.ref, c.alt, f.af,
               c.g + 0.05::DOUBLE * ((c.c_custkey + c.site) % 5) AS dosage
        FROM v_calls c JOIN v_frequencies f ON c.locus = f.locus AND c.pos = f.pos""",
    "v_traits": """
        SELECT '0' || c.c_custkey AS iid, c.c_acctbal AS acct_bal,
               o.t / 1000 AS order_total, CAST(o.n AS DOUBLE) AS order_count,
               c.c_acctbal / 1000
               + CASE WHEN (c.c_custkey * 7 + 3) % 16 BETWEEN 6 AND 9 THEN 2 ELSE 0 END
               + CASE WHEN (c.c_custkey * 11 + c.c_nationkey) % 16 = 15 THEN -3 ELSE 0 END AS founder_score
        FROM customer c JOIN (SELECT o_custkey, sum(o_totalprice) t, count(*) n
                              FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""",
    "v_covariates": """
        SELECT '0' || c_custkey AS iid, CAST(c_nationkey AS DOUBLE) AS "Age",
               CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "Sex"
        FROM customer""",
    "v_transcripts": """
        SELECT event_id, user_id, k, value, biotype, gene, term,
               'L' || (user_id % 3) AS locus,
               (user_id % 22 + 1) || ':' || (user_id * 100) || ':A:T' AS variant
        FROM (SELECT event_id, user_id, value,
                     CAST(json_extract_string(props, '$.k') AS INT) AS k,
                     CASE event_type WHEN 'click' THEN 'intron_variant'
                          WHEN 'view' THEN '3_prime_UTR_variant'
                          WHEN 'purchase' THEN 'missense_variant'
                          WHEN 'error' THEN '5_prime_UTR_variant'
                          WHEN 'signup' THEN 'synonymous_variant' END AS term,
                     CASE WHEN value > 100 THEN 'protein_coding' ELSE 'lncRNA' END AS biotype,
                     'G' || (CAST(json_extract_string(props, '$.k') AS INT) % 10) AS gene
              FROM events)""",
}

_NEEDS = {
    "v_region_variants": ["v_variants", "v_regions"],
    "v_calls": ["v_slots"],
    "v_frequencies": ["v_calls"],
    "v_dosage": ["v_calls", "v_frequencies"],
}


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH clause over the named views and what they need, plus ``extra``."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS MATERIALIZED ({SQL[n]})" for n in order]
    parts += [f"{n} AS MATERIALIZED ({q})" for n, q in extra or []]
    return "WITH " + ",\n".join(parts) + "\n"
