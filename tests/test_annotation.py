from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from locusframe.operators import annotate
from locusframe.sinks import tables as sinks
from locusframe.sources.annotation import ANNOTATION_DDL, SUMMARY_COLUMNS, scan_annotation_summary
from locusframe.sources.lookup import open_lookup, store_lookup, table_name

CODING = {
    "biotype": "protein_coding", "consequence_terms": ["missense_variant", "splice_region_variant"],
    "protein_start": 5, "amino_acids": "A/T", "hgvsp": "p.1", "gene_symbol": "G1", "gene_id": "E1",
    "transcript_id": "T1", "impact": "MODERATE", "canonical": 1,
}
PLAIN = {"biotype": "lncRNA", "consequence_terms": ["intron_variant"], "gene_symbol": "", "transcript_id": "T0"}


def document(variant, transcripts=None, colocated=None, ref="A", alt="T"):
    return {
        "variant": variant,
        "annotation": [{
            "most_severe_consequence": "missense_variant", "input_ref_allele": ref, "input_alt_allele": alt,
            **({} if transcripts is None else {"transcript_consequences": transcripts}),
            **({} if colocated is None else {"colocated_variants": colocated}),
        }],
    }


@pytest.fixture(scope="module")
def documents(spark):
    docs = [
        document("5:1:A:T", [PLAIN, CODING, {**CODING, "transcript_id": "T2", "amino_acids": "", "hgvsp": "p.2"}], [
            {"id": "rs2", "frequencies": {"T": {"gnomadg": 0.1, "gnomadg_nfe": 0.2}}},
            {"id": "COSV1", "clin_sig": ["pathogenic", "benign"]},
            {"id": "rs2", "clin_sig": ["benign"], "frequencies": {"T": {"gnomadg": 0.3}}},
            {"id": "rs9", "frequencies": {"C": {"gnomadg": 0.9}}},
        ]),
        document("5:2:A:T", [PLAIN]),
        document("5:3:A:T"),
        document("5:4:A:T", []),
        document("5:5:A:AG", [CODING], [{"id": "rs5", "frequencies": {"G": {"gnomadg": 0.4}}}], "A", "AG"),
        {"variant": "5:6:A:T"},
        {"variant": "5:7:A:T", "annotation": []},
    ]
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return lines.select(F.from_json("value", ANNOTATION_DDL).alias("d")).select("d.*")


def test_summary(documents):
    rows = {r.variant: r for r in annotate.summarize_annotations(documents).collect()}
    assert set(rows) == {f"5:{i}:A:T" for i in (1, 2, 3, 4)} | {"5:5:A:AG"}
    assert tuple(annotate.summarize_annotations(documents).columns) == SUMMARY_COLUMNS
    one = rows["5:1:A:T"]
    assert one.rs_ids == "rs2;rs2;rs9"
    assert one.clinical_significance == "benign;pathogenic"
    assert one.all_consequences == "intron_variant;missense_variant;splice_region_variant"
    assert one.coding_consequences == "missense_variant;splice_region_variant"
    assert one.protein_changes == "G1:A/T;G1:p.2"
    assert (one.transcript_id, one.impact, one.canonical_transcript) == ("T1", "MODERATE", "YES")
    # The last record that knows the allele wins, with all of its populations.
    assert (one.gnomad_af, one.gnomad_eur_af) == (0.3, None)
    two = rows["5:2:A:T"]
    assert (two.transcript_id, two.canonical_transcript, two.coding_consequences) == ("T0", "NO", "")
    for blank in ("5:3:A:T", "5:4:A:T"):
        assert (rows[blank].transcript_id, rows[blank].all_consequences, rows[blank].rs_ids) == ("", "", "")
    assert rows["5:5:A:AG"].gnomad_af is None


def test_indels_match_on_request(documents):
    rows = {r.variant: r for r in annotate.summarize_annotations(documents, match_indels=True).collect()}
    assert rows["5:5:A:AG"].gnomad_af == 0.4
    assert rows["5:1:A:T"].gnomad_af == 0.3


def test_summary_round_trip(spark, documents, tmp_path):
    summary = annotate.summarize_annotations(documents)
    sinks.write_annotation_summary(summary, str(tmp_path / "s"))
    back = scan_annotation_summary(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, summary.collect()), key=str)


def test_lookup_retry_and_rejects(spark):
    keys = spark.createDataFrame([("5:1:A:T",), ("5:2:A:AT",), ("5:3:G:C",), ("5:4:A",), ("5:5:A:C",)], "variant string")
    good, bad = annotate.split_variant_keys(keys)
    assert [r.variant for r in bad.collect()] == ["5:4:A"]
    lookup = spark.createDataFrame(
        [("5", 1, "T", "direct"), ("5", 1, "A", "swapped"), ("5", 2, "T", "suffix"), ("5", 3, "G", "back"), ("5", 5, "G", "other")],
        "chrom string, pos long, allele string, annotation string",
    )
    got = {r.variant: (r.annotation, r.swapped) for r in annotate.annotate_variants(good, lookup).collect()}
    assert got == {
        "5:1:A:T": ("direct", False), "5:2:A:AT": ("suffix", False), "5:3:G:C": ("back", True), "5:5:A:C": (None, None),
    }
    counts = annotate.success_count(annotate.annotate_variants(good, lookup)).first()
    assert (counts.n_annotated, counts.n_total) == (3, 4)


LOOKUP = "chrom string, pos long, allele string, annotation string"


def test_lookup_with_nulls_and_repeats(spark):
    keys = spark.createDataFrame([("5", 1, "A", "T"), ("5", 2, "A", "T"), (None, 1, "A", "T"), ("5", 1, "A", "T")], "chrom string, pos long, ref string, alt string")
    lookup = spark.createDataFrame(
        [("5", 1, None, "no allele"), ("5", 1, "T", None), ("5", 1, "T", "b"), ("5", 1, "T", "a"), (None, 1, "T", "x"), ("5", 2, "A", None)], LOOKUP
    )
    got = sorted(map(tuple, annotate.annotate_variants(keys, lookup).collect()), key=str)
    assert got == sorted([(None, 1, "A", "T", None, None), ("5", 2, "A", "T", None, None), *[("5", 1, "A", "T", "a", False)] * 2], key=str)
    assert annotate.annotate_variants(keys, lookup.limit(0)).filter("annotation is null").count() == 4


def test_lookup_of_documents(spark, documents):
    """Annotations that hold maps."""
    place = documents.select(F.split("variant", ":").alias("v"), "annotation")
    lookup = place.select(F.col("v")[0].alias("chrom"), F.col("v")[1].cast("long").alias("pos"), F.col("v")[3].alias("allele"), "annotation")
    keys, _ = annotate.split_variant_keys(documents.select("variant"))
    got = annotate.annotate_variants(keys, lookup.unionAll(lookup))
    assert got.count() == 7
    assert annotate.summarize_annotations(got.drop("swapped")).filter("variant = '5:1:A:T'").first().gnomad_af == 0.3


def test_stored_lookup_is_not_shuffled(spark, tmp_path):
    lookup = spark.createDataFrame([(str(i % 22), i, a, f"{i}{a}") for i in range(400) for a in "AT"], LOOKUP)
    keys = spark.createDataFrame([(str(i % 22), i, "G", "T") for i in range(0, 500, 3)], "chrom string, pos long, ref string, alt string")
    path = str(tmp_path / "store")
    stored = store_lookup(lookup, path, 4)
    want = sorted(map(tuple, annotate.annotate_variants(keys, lookup).collect()), key=str)
    for _ in range(2):
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = annotate.annotate_variants(keys, stored)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
            assert sorted(map(tuple, joined.collect()), key=str) == want
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        # A later session's catalog does not know the table yet.
        spark.sql(f"DROP TABLE {table_name(path)}")
        stored = open_lookup(spark, path)
    # Stored again in place, with other rows and buckets.
    again = store_lookup(lookup.limit(10), path, 2)
    assert again.count() == 5 and open_lookup(spark, path + "/").count() == 5


def test_percentages_round_half_even(spark):
    rows = [("L", "a", "g", 1), ("L", "b", "g", 3), ("L", "c", "g", 4), ("M", "a", "g", 2)]
    counts = spark.createDataFrame(rows, "locus string, annot string, gene string, count_snp long")
    got = {(r.locus, r.annot): r.des_stat for r in annotate.count_percentages(counts).collect()}
    # 12.5 goes to 12, 37.5 to 38.
    assert got == {("L", "a"): "1 (%12)", ("L", "b"): "3 (%38)", ("L", "c"): "4 (%50)", ("M", "a"): "2 (%100)"}
    ranks = {(r.locus, r.annot): r.annot_rank for r in annotate.rank_by_count(counts).collect()}
    assert ranks == {("L", "c"): 1, ("L", "b"): 2, ("L", "a"): 3, ("M", "a"): 1}
