from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import display, merge, reshape, results
from locusframe.session import materialize

HAPS = "locus string, dataset string, trait_name string, hap_pos int, haplotype string, alleles string"


def haps(spark, rows):
    return spark.createDataFrame([("L", "d", *r) for r in rows], HAPS)


def test_dictionary_follows_the_alleles(spark):
    rows = [
        ("t1", 1, "H003", "12"), ("t1", 2, "H004", "21"), ("t1", 3, "Hrare", "**"), ("t1", 4, "Ref.", "11"),
        # The second trait lacks 12 and has another base.
        ("t2", 1, "H001", "11"), ("t2", 2, "H002", "22"), ("t2", 3, "Ref.", "21"),
    ]
    got = {(r.trait_name, r.haplotype): r.haplo for r in results.haplotype_dictionary(haps(spark, rows)).collect()}
    assert got == {
        ("t1", "H003"): "H1", ("t1", "H004"): "H2", ("t1", "Ref."): "Ref.",
        ("t2", "H001"): "H3", ("t2", "H002"): "H4", ("t2", "Ref."): "Ref.",
    }
    check = {r.haplotype: r.identical for r in results.haplotype_identity_check(haps(spark, rows)).collect()}
    assert check["Ref."] is False and check["H003"] is True


def test_traits_go_by_their_place_in_the_file(spark):
    rows = [
        ("a", 1, "H001", "12"), ("a", 2, "Ref.", "11"), ("b", 1, "H001", "21"), ("b", 2, "Ref.", "11"), ("c", 1, "H001", "12"),
    ]
    place = F.when(F.col("trait_name") == "b", 0).when(F.col("trait_name") == "c", 1).otherwise(2)
    frame = haps(spark, rows).withColumn("trait_pos", place)
    got = {(r.trait_name, r.haplotype): r.haplo for r in results.haplotype_dictionary(frame).collect()}
    assert got == {("b", "H001"): "H1", ("c", "H001"): "H2", ("a", "H001"): "H2", ("a", "Ref."): "Ref.", ("b", "Ref."): "Ref."}
    assert {r.trait_name for r in display.first_trait(frame).collect()} == {"b"}
    assert {r.trait_name for r in display.first_trait(haps(spark, rows)).collect()} == {"a"}
    wide = spark.createDataFrame([("1", 2.0, 1.0)], ["iid", "z", "a b"])
    long = reshape.trait_unpivot(wide, position="trait_pos").collect()
    assert [(r.iid, r.trait_pos, r.trait_name, r.trait) for r in long] == [("1", 0, "z", 2.0), ("1", 1, "a b", 1.0)]


COEFS = (
    "locus string, dataset string, trait_name string, term string, term_kind string, estimate double, "
    "std_error double, statistic double, p_value double"
)


def test_results_join_and_order(spark):
    names = [f"haplo_genotype.{i}" for i in range(1, 12)]
    coefs = [("L", "d", "t1", n, "haplotype", 1.0, 0.5, 2.0, 0.05 if k % 2 else 0.051) for k, n in enumerate(names)]
    coefs += [("L", "d", "t1", "Age", "covariate", 1.0, 0.5, 2.0, 0.001), ("L", "d", "t1", "haplo_genotype.rare", "rare", 1.0, 0.5, 2.0, 0.001)]
    frame = spark.createDataFrame(coefs, COEFS)
    rows = [("t1", i, f"H{i:03d}", f"{i:02d}") for i in range(1, 12)] + [("t1", 12, "Ref.", "99")]
    joined = results.haplotype_right_join(frame, results.haplotype_dictionary(haps(spark, rows)))
    assert joined.count() == 12
    assert joined.filter("haplo = 'Ref.' and estimate is null").count() == 1
    tidy = [r.haplo for r in results.tidied_results(joined).collect()]
    assert tidy == sorted(f"H{i}" for i in range(1, 12))
    # p = 0.05 counts as associated.
    assert [r.haplo for r in results.significant_results(joined).collect()] == ["H10", "H2", "H4", "H6", "H8"]
    assert {r.term for r in results.term_exclude(frame, by_name=True).collect()} == set(names)


def test_distance_scales_missing_effects(spark):
    rows = [("L", "d", "t1", "H1", 0.0), ("L", "d", "t2", "H1", 0.0), ("L", "d", "t1", "H2", 3.0), ("L", "d", "t2", "H2", None)]
    tidy = spark.createDataFrame(rows, "locus string, dataset string, trait_name string, haplo string, estimate double")
    row = results.effect_distance(tidy).first()
    assert (row["first"], row["second"]) == ("H1", "H2")
    assert row.distance == pytest.approx((9 * 2 / 1) ** 0.5)
    single = tidy.filter("haplo = 'H1'")
    assert results.effect_distance(single).count() == 0


@pytest.mark.parametrize("block", [3, 128])
def test_trait_distance_equals_the_join(spark, block):
    rng = random.Random(block)
    rows = [
        (locus, "d", f"t{t}", f"H{h}", rng.choice([None, rng.gauss(0, 1)]))
        for locus, n in (("L", 11), ("M", 3), ("N", 1)) for t in range(n) for h in range(4) if rng.random() < 0.8
    ]
    # One haplotype only, a trait without effects, a null trait, NaN effects, two traits that share nothing.
    rows += [("P", "d", f"t{t}", "H1", 1.0) for t in range(4)]
    rows += [("Q", "d", "empty", "H1", None), ("Q", "d", "a", "H1", 1.0), ("Q", "d", "b", "H2", 2.0), ("Q", "d", None, "H1", 3.0)]
    rows += [("R", "d", "a", "H1", float("nan")), ("R", "d", "b", "H1", 1.0), ("R", "d", "b", "H2", 1.0), ("R", "d", "c", "H2", 4.0)]
    tidy = spark.createDataFrame(rows, "locus string, dataset string, trait_name string, haplo string, estimate double")

    def found(frame):
        return sorted((r.locus, r["first"], r["second"], repr(round(r.distance, 9))) for r in frame.collect())

    want = found(results.effect_distance(tidy.filter("trait_name is not null"), "trait_name", "haplo"))
    assert found(results.trait_distance(tidy, block)) == want and len(want) > 30
    assert {x[0] for x in want} == {"L", "M", "R"}
    assert results.trait_distance(tidy.limit(0), block).count() == 0


def test_report_sentences(spark):
    row = ("L", "d", 13447, 169, 5.0, 13442.0, 100, 72, 12, 73, 13)
    counts = spark.createDataFrame(
        [row],
        "locus string, dataset string, n_sample long, n_snps long, min_ac double, max_ac double, n_kept long, "
        "n_traits long, n_covariates long, legacy_n_traits long, legacy_n_covariates long",
    )
    text = merge.summary_text(counts, legacy=True).first().text
    assert text == (
        "Minimum allele count (AC) is set to 5 . Given 13447 samples, variants with AC below 5 and above 13442 "
        "are removed.\n\n\nOf 169 variants, 100 left with minor allele count > 5 for building haplotypes.\n\n\n"
        "Merged data comprised 100 variants, 73 traits, and 13 covariates.\n"
    )
    none = counts.withColumn("n_covariates", F.lit(None).cast("long"))
    assert merge.summary_text(none).first().text.endswith("100 variants, 72 traits.\n")


def test_display_chain(spark):
    rows = [("t1", 1, "H002", "12"), ("t1", 2, "Hrare", "**"), ("t1", 3, "Ref.", "11"), ("t2", 1, "Ref.", "11")]
    sites = spark.createDataFrame(
        [("L", 0, "chr5_10_A_G"), ("L", 1, "chr5_20_C_TT")], "locus string, site_index int, snp_id string"
    )
    summary = spark.createDataFrame(
        [("L", "5:10:A:G", "3_prime_UTR_variant", ""), ("L", "5:10:A:T", "intron_variant", "G1")],
        "locus string, variant string, most_severe_consequence string, gene_symbol string",
    )
    freqs = spark.createDataFrame(
        [("L", "5", 10, "A", "G", 0.3), ("L", "5", 20, "C", "TT", 0.2)],
        "locus string, chrom string, pos long, ref string, alt string, af double",
    )
    table = display.display_table(haps(spark, rows), sites, display.display_annotation(summary), freqs)
    got = {(r.haplotype, r.snp_id, r.variant): r for r in table.collect()}
    assert len(got) == 6
    ref = got["Ref.", "chr5_20_C_TT", None]
    hap = got["H1", "chr5_20_C_TT", None]
    # Site 20 has no annotation; code 2 swaps the pair and shows C's partner.
    assert (ref.xlab_annot, ref.allele, ref.true_allele, ref.differs_ref) == ("NA_NA", "C", "C", False)
    assert (hap.ref, hap.alt, hap.af, hap.allele, hap.differs_ref) == ("TT", "C", 0.8, "TT", True)
    same = got["H1", "chr5_10_A_G", "5:10:A:G"]
    assert (same.n_allele, same.diallelic, same.true_allele, same.ref_copies) == (1, "", "", 2)
    assert same.xlab_annot == "NA_UTR3'" and same.snp_label == "chr5:10_A_G"
    counts = display.plot_counts(table).first()
    assert tuple(counts)[2:] == (2, 2, 1, 0)
    assert display.varying_filter(table).count() == 2
    assert display.shrink_varying_biallelic(table).count() == 0
    # The first site has no common haplotype with a different code.
    ranks = {r.snp_label: r.snp_rank for r in table.collect()}
    assert ranks == {"chr5:10_A_G": 1, "chr5:20_C_TT": 2}


def test_trait_distance_copies_no_trait_on_disk(spark, monkeypatch):
    rows = [("L", "d", f"t{t:03d}", f"H{h}", float(t * h)) for t in range(60) for h in range(3)] + [("L", "d", "t000", None, 1.0)]
    tidy = spark.createDataFrame(rows, "locus string, dataset string, trait_name string, haplo string, estimate double")
    kept = []
    monkeypatch.setattr(results, "materialize", lambda df, label: kept.append(materialize(df, label)) or kept[-1])
    found = results.trait_distance(tidy, 4, lot_bytes=2_000, task_pairs=10)
    plan = found._jdf.queryExecution().toString()
    # Blocks meet through broadcasts of several lots, not through a shuffle of copies.
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("Union") > 0
    assert kept[-1].agg({"block": "count"}).first()[0] < 60 // 4 + 20
    assert found.count() == 60 * 59 // 2
    want = {(r["first"], r["second"]): round(r.distance, 9) for r in results.effect_distance(tidy, "trait_name", "haplo").collect()}
    assert {(r["first"], r["second"]): round(r.distance, 9) for r in found.collect()} == want
