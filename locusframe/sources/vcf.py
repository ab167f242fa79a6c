"""VCF text to variant rows and long dosage rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.operators.variants import region_interval_join
from locusframe.session import broadcast_if_small, materialize
from locusframe.sources.blocks import SLAB_BYTES, read_lines, slab_lines, slabs_of, text_files

_FIXED = 9  # CHROM POS ID REF ALT QUAL FILTER INFO FORMAT


def read_vcf_lines(spark: SparkSession, path: str, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Lines of one or more VCF files as column ``value``: plain text, gzip, or
    block-compressed (``bgzip``), which many tasks read."""
    return read_lines(spark, path, slab_bytes)


def vcf_index(spark: SparkSession, path: str, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """What each slab of block-compressed files holds, in one pass: ``path``,
    ``length``, ``slab``, ``slab_bytes``, ``chrom``, ``first`` and ``last``
    position covered (END and REF included), ``n_records``. Header lines are
    counted under a null ``chrom``. Write it beside the files once; files of
    other kinds have no rows.
    """
    blocks, _ = text_files(spark, path)
    lines = slab_lines(slabs_of(spark, blocks, slab_bytes))
    head = lines.filter(F.startswith("value", F.lit("#"))).select(
        "path", "slab", F.lit(None).cast("string").alias("chrom"), F.lit(None).cast("long").alias("pos"), F.lit(None).cast("long").alias("stop")
    )
    places = head.unionByName(vcf_variants(lines, "path", "slab").select("path", "slab", "chrom", "pos", "stop"))
    covered = places.groupBy("path", "slab", "chrom").agg(
        F.min("pos").alias("first"), F.max("stop").alias("last"), F.count("*").alias("n_records")
    )
    return covered.join(F.broadcast(spark.createDataFrame(blocks, "path string, length long")), "path").select(
        "path", "length", "slab", F.lit(slab_bytes).cast("long").alias("slab_bytes"), "chrom", "first", "last", "n_records"
    )


def region_slabs(index: DataFrame, regions: DataFrame) -> DataFrame:
    """Slabs of the index that hold header lines or a record that meets a
    region: ``path``, ``slab``."""
    spans = index.filter("chrom is not null").select("path", "slab", "chrom", F.col("first").alias("pos"), F.col("last").alias("stop"))
    met = region_interval_join(spans, regions).select("path", "slab")
    return met.unionByName(index.filter("chrom is null").select("path", "slab")).distinct()


def read_vcf_regions(spark: SparkSession, path: str, regions: DataFrame, index: DataFrame) -> DataFrame:
    """Lines as ``read_vcf_lines`` gives them, but of block-compressed files
    only the slabs that may hold records of ``regions``. Files that are not in
    the index, or have changed their size since, are read whole."""
    blocks, others = text_files(spark, path)
    known = {tuple(r) for r in index.select("path", "length").distinct().collect()}
    sizes = [r[0] for r in index.select("slab_bytes").distinct().collect()]
    if len(sizes) > 1:
        raise ValueError("the index holds slabs of different sizes")
    parts = []
    indexed = [x for x in blocks if x in known]
    if indexed:
        wanted = materialize(region_slabs(index, regions), "slabs")
        parts.append(slab_lines(slabs_of(spark, indexed, sizes[0]).join(wanted, ["path", "slab"], "left_semi")).select("value"))
    rest = [*[p for p, n in blocks if (p, n) not in known], *others]
    parts += [read_lines(spark, p) for p in rest]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def vcf_samples(lines: DataFrame) -> DataFrame:
    """(sample_index, iid) from the ``#CHROM`` line, as a stored table so that
    its real size decides the later join."""
    heads = lines.filter(F.startswith(F.col("value"), F.lit("#CHROM"))).distinct()
    fields = F.split("value", "\t")
    names = heads.select(
        F.posexplode(F.slice(fields, _FIXED + 1, F.size(fields))).alias("sample_index", "iid")
    )
    one = names.groupBy("sample_index").agg(
        F.when(F.count("*") > 1, F.raise_error(F.lit("VCF files list different samples")))
        .otherwise(F.first("iid"))
        .alias("iid")
    )
    return materialize(one, "samples")


def vcf_variants(lines: DataFrame, *keep: str) -> DataFrame:
    """One row per variant record; sample fields stay one packed text. Columns
    named in ``keep`` go along.

    Only the leading fields are cut, so a region test costs nothing per
    sample. ``stop`` is the last position: END of INFO (symbolic alleles) or
    the end of REF.
    """
    lead = F.substring_index("value", "\t", _FIXED)
    records = lines.filter(~F.startswith(F.col("value"), F.lit("#"))).select(
        *keep, F.split(lead, "\t").alias("f"), F.substr("value", F.length(lead) + 2).alias("samples")
    )
    info, pos = F.get("f", F.lit(7)), F.get("f", F.lit(1)).cast("bigint")
    end = F.regexp_extract(info, "(?:^|;)END=([0-9]+)", 1).try_cast("bigint")
    return records.select(
        *keep,
        F.get("f", F.lit(0)).alias("chrom"),
        pos.alias("pos"),
        F.get("f", F.lit(2)).alias("marker_id"),
        F.get("f", F.lit(3)).alias("ref"),
        F.get("f", F.lit(4)).alias("alt"),
        F.regexp_extract(info, "(?:^|;)AF=([^;]*)", 1).try_cast("double").alias("af"),
        F.greatest(end, pos + F.length(F.get("f", F.lit(3))) - 1).alias("stop"),
        info.alias("info"),
        F.array_position(F.split(F.get("f", F.lit(8)), ":"), F.lit("DS")).cast("int").alias("ds_index"),
        "samples",
    )


def csq_fields(lines: DataFrame) -> list[str]:
    """Order of the fields of a CSQ entry, from the ``##INFO`` header line."""
    head = lines.filter(F.startswith(F.col("value"), F.lit("##INFO=<ID=CSQ,"))).first()
    found = re.search(r"Format: ?([^\">]+)", head[0]) if head else None
    if found is None:
        raise ValueError("the header describes no CSQ")
    return [x.strip() for x in found[1].split("|")]


def with_csq(variants: DataFrame) -> DataFrame:
    """``variants`` with ``csq``, the CSQ entry of INFO (null without one)."""
    entry = F.regexp_extract("info", "(?:^|;)CSQ=([^;]*)", 1)
    return variants.withColumn("csq", F.when(entry != "", entry))


def explode_samples(variants: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per variant and sample with its DS value (``.`` is null).

    Restrict ``variants`` to the wanted regions first: the packed rows are
    far fewer than the exploded ones.
    """
    keep = [c for c in variants.columns if c not in ("samples", "info", "ds_index", "stop")]
    long = variants.select(
        *keep, "ds_index", F.posexplode(F.split("samples", "\t")).alias("sample_index", "call")
    )
    ds = F.when(F.col("ds_index") > 0, F.get(F.split("call", ":"), F.col("ds_index") - 1))
    return long.join(broadcast_if_small(samples), "sample_index").select(
        "iid", *keep, ds.try_cast("double").alias("dosage")
    )


# Consequence terms from least to most severe, Sequence Ontology names.
# Terms on one line share a rank.
CONSEQUENCE_SEVERITY = """
intergenic_variant
feature_truncation feature_elongation
regulatory_region_variant regulatory_region_ablation regulatory_region_amplification
TF_binding_site_variant TFBS_ablation TFBS_amplification
downstream_gene_variant upstream_gene_variant
non_coding_transcript_variant
intron_variant NMD_transcript_variant
non_coding_transcript_exon_variant
5_prime_UTR_variant 3_prime_UTR_variant
coding_sequence_variant mature_miRNA_variant
stop_retained_variant start_retained_variant synonymous_variant
incomplete_terminal_codon_variant
splice_region_variant
missense_variant inframe_insertion inframe_deletion protein_altering_variant
transcript_amplification
start_lost stop_lost stop_gained frameshift_variant
splice_acceptor_variant splice_donor_variant
transcript_ablation
"""


def severity_rank(consequence):
    """Highest severity among the ``&``-joined terms; unknown terms rank 0."""
    ranks = [
        entry
        for rank, line in enumerate(CONSEQUENCE_SEVERITY.split("\n"))
        for term in line.split()
        for entry in (F.lit(term), F.lit(rank))
    ]
    table = F.create_map(*ranks)
    return F.array_max(
        F.transform(F.split(consequence, "&"), lambda t: F.coalesce(table[t], F.lit(0)))
    )


def worst_consequence(
    variants: DataFrame, fields: list[str], csq: str = "csq"
) -> DataFrame:
    """Worst transcript consequence of each site.

    ``csq`` holds comma-separated transcripts, each ``|``-separated in the
    order of ``fields`` (which must name SYMBOL, Gene and Consequence). The
    first of equally severe transcripts wins. No shuffle: the transcripts of
    a site are in its own row.
    """
    at = {name: i for i, name in enumerate(fields)}

    def item(parts, name):
        return F.get(parts, F.lit(at[name]))

    transcripts = F.transform(
        F.split(csq, ","),
        lambda text, i: F.struct(
            severity_rank(item(F.split(text, r"\|"), "Consequence")).alias("rank"),
            (-i).alias("order"),
            F.split(text, r"\|").alias("parts"),
        ),
    )
    worst = F.array_max(transcripts)["parts"]
    keep = [c for c in variants.columns if c != csq]
    return variants.withColumn("_worst", worst).select(
        *keep,
        item(F.col("_worst"), "SYMBOL").alias("symbol"),
        item(F.col("_worst"), "Gene").alias("gene"),
        item(F.col("_worst"), "Consequence").alias("consequence"),
    )
