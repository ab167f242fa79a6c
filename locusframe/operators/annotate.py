"""Annotation lookup and flattening, consequence counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from locusframe.functions.keys import lookup_allele, parse_variant_key
from locusframe.functions.labels import clean_consequence, default_blank, spaced, yes_no


# -- lookup ---------------------------------------------------------------


def split_variant_keys(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejects): bad keys are set aside, the rest goes on."""
    parsed = keys.withColumn("_key", parse_variant_key(F.col("variant")))
    good = parsed.filter(F.col("_key").isNotNull()).select(*keys.columns, "_key.*")
    bad = parsed.filter(F.col("_key").isNull()).drop("_key")
    return good, bad


def position_lookup(lookup: DataFrame) -> DataFrame:
    """One row per (chrom, pos) with ``found``, the annotation of each allele.

    ``lookup`` has chrom, pos, allele, annotation; rows with a null in any of
    them answer nothing and are left out. Of several records of one allele the
    smallest is taken, nested ones by their JSON text (maps have no order).
    """
    known = lookup.dropna(subset=["chrom", "pos", "allele", "annotation"])
    nested = isinstance(lookup.schema["annotation"].dataType, (ArrayType, MapType, StructType))
    rank = F.to_json("annotation") if nested else F.col("annotation")
    alleles = known.groupBy("chrom", "pos", "allele").agg(F.min_by("annotation", rank).alias("annotation"))
    return alleles.groupBy("chrom", "pos").agg(
        F.map_from_entries(F.collect_list(F.struct("allele", "annotation"))).alias("found")
    )


def annotate_variants(variants: DataFrame, lookup: DataFrame) -> DataFrame:
    """``variants`` with the annotation record of each, and a swapped retry.

    ``lookup`` has chrom, pos, allele, annotation, or is what
    ``position_lookup`` makes of such rows (see ``sources.lookup`` for storing
    it). A variant is looked up under its ALT allele and, failing that, with REF
    and ALT swapped. Every row and column of ``variants`` stays. The few alleles
    of a position are one row, so one join on (chrom, pos) serves both attempts
    and adds no rows.
    """
    by_place = lookup if "found" in lookup.columns else position_lookup(lookup)
    by_place = by_place.select("chrom", "pos", F.col("found").alias("_found"))
    direct = F.col("_found")[lookup_allele(F.col("ref"), F.col("alt"))]
    swapped = F.col("_found")[lookup_allele(F.col("alt"), F.col("ref"))]
    hit = direct.isNotNull() | swapped.isNotNull()
    return variants.join(by_place, ["chrom", "pos"], "left").select(
        *variants.columns, F.coalesce(direct, swapped).alias("annotation"), F.when(hit, direct.isNull()).alias("swapped")
    )


def success_count(annotated: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Annotated and total number of variants."""
    return annotated.groupBy(*(keys or [])).agg(
        F.count("annotation").alias("n_annotated"), F.count("*").alias("n_total")
    )


def annotation_row_guard(documents: DataFrame) -> DataFrame:
    """Rows that carry an annotation, reduced to its first record."""
    return documents.filter(F.size("annotation") > 0).withColumn("record", F.col("annotation")[0])


# -- flattening -----------------------------------------------------------


def _sorted_set(items: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(items)), ";")


def _coding(transcripts: Column) -> Column:
    return F.filter(transcripts, lambda t: t["biotype"] == "protein_coding")


def _terms(transcripts: Column) -> Column:
    lists = F.transform(transcripts, lambda t: t["consequence_terms"])
    return F.flatten(F.filter(lists, lambda x: x.isNotNull()))


def all_consequences(transcripts: Column) -> Column:
    return default_blank(_sorted_set(_terms(transcripts)))


def coding_consequences(transcripts: Column) -> Column:
    return default_blank(_sorted_set(_terms(_coding(transcripts))))


def protein_changes(transcripts: Column) -> Column:
    """Distinct ``gene:change`` of coding transcripts with a protein start;
    the change is the amino acids, else the HGVS protein name."""

    def change(t: Column) -> Column:
        return F.coalesce(F.nullif(t["amino_acids"], F.lit("")), F.nullif(t["hgvsp"], F.lit("")))

    hits = F.filter(
        _coding(transcripts),
        lambda t: (F.coalesce(t["protein_start"], F.lit(0)) != 0) & change(t).isNotNull(),
    )
    named = F.transform(
        hits,
        lambda t: F.concat(F.coalesce(t["gene_symbol"], F.lit("")), F.lit(":"), change(t)),
    )
    return default_blank(_sorted_set(named))


def main_transcript(transcripts: Column) -> Column:
    """First protein-coding transcript, else the first one."""
    return F.coalesce(F.get(_coding(transcripts), F.lit(0)), F.get(transcripts, F.lit(0)))


def rs_ids(colocated: Column) -> Column:
    ids = F.transform(colocated, lambda c: c["id"])
    return default_blank(F.array_join(F.filter(ids, lambda i: F.startswith(i, F.lit("rs"))), ";"))


def clinical_significance(colocated: Column) -> Column:
    lists = F.transform(colocated, lambda c: c["clin_sig"])
    return default_blank(_sorted_set(F.flatten(F.filter(lists, lambda x: x.isNotNull()))))


def population_frequencies(colocated: Column, alleles: list[Column]) -> Column:
    """Frequency map of the last co-located record that knows the allele.

    ``alleles`` are tried in order: the ALT allele, and optionally the lookup
    form of an indel, which the plain ALT never matches.
    """

    def last_with(allele: Column) -> Column:
        hits = F.filter(colocated, lambda c: F.map_contains_key(c["frequencies"], allele))
        return F.when(F.size(hits) > 0, F.element_at(hits, -1)["frequencies"][allele])

    return F.coalesce(*[last_with(a) for a in alleles])


def summarize_annotations(documents: DataFrame, match_indels: bool = False) -> DataFrame:
    """The 22-column summary: one row in, one row out, no explode, no shuffle."""
    rows = annotation_row_guard(documents)
    keep = [c for c in documents.columns if c not in ("annotation", "variant")]
    rec = F.col("record")
    transcripts, colocated = rec["transcript_consequences"], rec["colocated_variants"]
    ref, alt = rec["input_ref_allele"], rec["input_alt_allele"]
    alleles = [alt, lookup_allele(ref, alt)] if match_indels else [alt]
    rows = rows.withColumn("_main", main_transcript(transcripts)).withColumn(
        "_freq", population_frequencies(colocated, alleles)
    )
    main = F.col("_main")

    def text(c: Column, name: str) -> Column:
        return default_blank(c).alias(name)

    return rows.select(
        *keep,
        "variant",
        rs_ids(colocated).alias("rs_ids"),
        text(ref, "ref_allele"),
        text(alt, "alt_allele"),
        text(rec["most_severe_consequence"], "most_severe_consequence"),
        all_consequences(transcripts).alias("all_consequences"),
        coding_consequences(transcripts).alias("coding_consequences"),
        protein_changes(transcripts).alias("protein_changes"),
        text(main["impact"], "impact"),
        text(main["gene_id"], "gene_id"),
        text(main["gene_symbol"], "gene_symbol"),
        text(main["transcript_id"], "transcript_id"),
        yes_no(main["canonical"] == 1).alias("canonical_transcript"),
        text(main["biotype"], "biotype"),
        text(main["hgnc_id"], "hgnc_id"),
        clinical_significance(colocated).alias("clinical_significance"),
        text(main["sift_prediction"], "sift_prediction"),
        text(main["polyphen_prediction"], "polyphen_prediction"),
        F.col("_freq")["gnomadg"].alias("gnomad_af"),
        F.col("_freq")["gnomadg_afr"].alias("gnomad_afr_af"),
        F.col("_freq")["gnomadg_nfe"].alias("gnomad_eur_af"),
        F.col("_freq")["gnomadg_eas"].alias("gnomad_eas_af"),
    )


# -- counts ---------------------------------------------------------------


def gene_counts(summary: DataFrame) -> DataFrame:
    """Variants per locus, short consequence and gene."""
    annot = spaced(clean_consequence(F.col("most_severe_consequence")))
    return summary.groupBy("locus", annot.alias("annot"), F.col("gene_symbol").alias("gene")).agg(
        F.count("*").alias("count_snp")
    )


def consequence_counts(legacy: DataFrame, clean=clean_consequence) -> DataFrame:
    """Variants per locus and short consequence (legacy table)."""
    return legacy.groupBy("locus", spaced(clean(F.col("vep_annot"))).alias("annot")).agg(
        F.count("*").alias("count_snp")
    )


def count_percentages(counts: DataFrame) -> DataFrame:
    """Whole percentage of the locus total (half to even) and its label."""
    total = counts.groupBy("locus").agg(F.sum("count_snp").alias("_total"))
    share = F.bround(F.col("count_snp") / F.col("_total") * 100, 0).cast("bigint")
    return (
        counts.join(total, "locus")
        .withColumn("percentage", share)
        .withColumn(
            "des_stat",
            F.concat(
                F.col("count_snp").cast("string"), F.lit(" (%"),
                F.col("percentage").cast("string"), F.lit(")"),
            ),
        )
        .drop("_total")
    )


def rank_by_count(counts: DataFrame) -> DataFrame:
    """Factor order of the consequences: descending mean count, ties by name.

    Works on counted rows, so a window holds one row per consequence.
    """
    means = counts.groupBy("locus", "annot").agg(F.avg(-F.col("count_snp")).alias("_mean"))
    order = Window.partitionBy("locus").orderBy("_mean", "annot")
    ranks = means.select("locus", "annot", F.row_number().over(order).alias("annot_rank"))
    return counts.join(ranks, ["locus", "annot"])
