from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import freq, reshape, variants


@pytest.mark.parametrize("overlap", [True, False])
@pytest.mark.parametrize("width", [7, 100, 1_000_000])
def test_interval_join_equals_brute_force(spark, overlap, width):
    rng = random.Random(width)
    vs = [(rng.choice("12"), rng.randrange(1, 300), "A" * rng.choice([1, 1, 2, 30]), i) for i in range(120)]
    rs = []
    for i in range(25):
        beg = rng.randrange(1, 300)
        rs.append((f"L{i}", rng.choice("12"), beg, beg + rng.choice([0, 5, 80])))
    left = spark.createDataFrame(vs, "chrom string, pos long, ref string, n int")
    right = spark.createDataFrame(rs, "locus string, chrom string, beg long, end long")
    got = sorted(
        (r.locus, r.n) for r in variants.region_interval_join(left, right, overlap, width).collect()
    )
    want = sorted(
        (name, n)
        for name, rc, beg, end in rs
        for vc, pos, ref, n in vs
        if rc == vc and pos <= end and (pos + len(ref) - 1 if overlap else pos) >= beg
    )
    assert got == want


def test_band_is_strict_on_both_ends(spark):
    rows = [("L", str(i), "5", p, "A", "G", af, 1.0) for i in range(10) for p, af in
            ((1, 0.2), (2, 0.8), (3, 0.21), (4, 0.79), (5, None))]
    frame = spark.createDataFrame(rows, "locus string, iid string, chrom string, pos long, ref string, alt string, af double, dosage double")
    derived = variants.allele_count_derive(frame, variants.sample_counts(frame))
    kept = variants.allele_count_band_filter(derived, 2)
    assert {r.snp_id for r in kept.collect()} == {"chr5_3_A_G", "chr5_4_A_G"}


def test_unusable_names_are_rejected_and_counted(spark):
    from locusframe.plans.association import kept_sites, rejected_variants

    rows = [("L", str(i), c, 7, "A", alt, 0.5, 1.0) for i in range(10) for c, alt in (("5", "G"), ("X", "G"), ("5", "<DEL>"))]
    frame = spark.createDataFrame(rows, "locus string, iid string, chrom string, pos long, ref string, alt string, af double, dosage double")
    assert [(r.snp_id, r.site_index) for r in kept_sites(frame, 2).collect()] == [("chr5_7_A_G", 0)]
    assert [tuple(r) for r in rejected_variants(frame, 2).collect()] == [("L", 2)]


def test_multi_allelic_counts(spark):
    rows = [("L", "1", "5", 7, "A", "G", 0.5, 1.0), ("L", "1", "5", 7, "A", "T", 0.5, 1.0), ("L", "2", "5", 7, "A", "T", 0.5, 1.0)]
    frame = spark.createDataFrame(rows, "locus string, iid string, chrom string, pos long, ref string, alt string, af double, dosage double")
    assert tuple(variants.sample_variant_counts(frame).first()) == ("L", 2, 1)


def _kept(spark, rows):
    return spark.createDataFrame(
        rows, "locus string, iid string, snp_id string, chrom string, pos long, ref string, alt string, dosage double"
    )


def test_genotype_vectors_fill_gaps(spark):
    rows = [
        ("L", "007", "chr5_10_A_G", "5", 10, "A", "G", 0.5),
        ("L", "007", "chr5_9_A_G", "5", 9, "A", "G", 1.5),
        ("L", "10-3", "chr5_10_A_G", "5", 10, "A", "G", None),
        ("M", "10-3", "chr6_1_A_G", "6", 1, "A", "G", 1.0),
    ]
    kept = _kept(spark, rows)
    vectors = reshape.genotype_vectors(kept, reshape.site_dictionary(kept))
    got = {(r.locus, r.iid): r.pattern for r in vectors.collect()}
    assert got == {("L", "007"): "20", ("L", "10-3"): "..", ("M", "10-3"): "1"}


def test_genotype_vectors_over_several_words(spark):
    rng = random.Random(9)
    calls = {(i, k): rng.choice([0, 1, 2, None, "absent"]) for i in range(6) for k in range(100)}
    rows = [
        ("L", f"0{i}", f"chr5_{k}_A_G", "5", k, "A", "G", None if c is None else float(c))
        for (i, k), c in calls.items() if c != "absent"
    ]
    kept = _kept(spark, rows)
    got = {r.iid: r.pattern for r in reshape.genotype_vectors(kept, reshape.site_dictionary(kept)).collect()}
    for i in range(6):
        letters = ["." if calls[i, k] in (None, "absent") else str(calls[i, k]) for k in range(100)]
        assert got[f"0{i}"] == "".join(letters)


def test_repeated_cells_fail(spark):
    rows = [("L", "1", "chr5_9_A_G", "5", 9, "A", "G", 1.0)] * 2
    with pytest.raises(Exception, match="repeated"):
        reshape.genotype_vectors(_kept(spark, rows), reshape.site_dictionary(_kept(spark, rows))).collect()
    with pytest.raises(Exception, match="repeated"):
        reshape.genotype_pivot(_kept(spark, rows), ["chr5_9_A_G"]).collect()


def test_quartiles_are_exact(spark):
    rng = random.Random(3)
    groups = {"a": [rng.random() for _ in range(1001)], "b": [0.25] * 50 + [0.3], "c": [0.1], "d": [0.1, 0.4]}
    frame = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "locus string, afc double")
    got = {r.locus: (r.q1, r.q3) for r in freq.quartiles(frame).collect()}
    want = {
        r.locus: tuple(r.q)
        for r in frame.groupBy("locus").agg(F.percentile("afc", [0.25, 0.75]).alias("q")).collect()
    }
    for k in groups:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


@pytest.mark.parametrize(
    "lo, hi, n, first, last, step",
    [
        (0.0, 0.5, 7, 0.0, 0.5, 0.1),
        # 0.474 / 7 = 0.0677: 0.1 - 0.0677 is not below 1.5 * (0.0677 - 0.05).
        (0.013, 0.487, 7, 0.0, 0.5, 0.05),
        (0.0, 1.0, 5, 0.0, 1.0, 0.2),
        (1.0, 94.0, 5, 0.0, 100.0, 20.0),
        (0.0, 0.3, 7, 0.0, 0.3, 0.05),
        (3.0, 11.0, 5, 2.0, 12.0, 2.0),
    ],
)
def test_round_steps(spark, lo, hi, n, first, last, step):
    frame = spark.createDataFrame([(lo, hi)], "lo double, hi double")
    frame = frame.withColumn("step", freq.round_step(F.col("lo"), F.col("hi"), n))
    a, b = freq.covering_multiples(F.col("lo"), F.col("hi"), F.col("step"))
    row = frame.select("step", (a * F.col("step")).alias("a"), (b * F.col("step")).alias("b")).first()
    assert (row.step, row.a, row.b) == pytest.approx((step, first, last))


def test_histogram_edges(spark):
    values = [0.0, 0.1, 0.1, 0.2, 0.35, 0.5, 0.9]
    frame = spark.createDataFrame([("L", v) for v in values], "locus string, af double")
    rows = freq.histogram_breaks(frame).orderBy("bin").collect()
    assert [round(r.end, 3) for r in rows] == [0.1, 0.2, 0.3, 0.4, 0.5]
    assert [r.n for r in rows] == [4, 1, 0, 1, 1]
    assert sum(r.n for r in freq.histogram_30(frame).collect()) == len(values)


def test_locus_profile(spark):
    """Counts of one scan equal those of separate distincts, with nulls and
    repeated rows; a variant with two frequencies stays two rows."""
    rows = [
        ("L", f"i{i}", "5", pos, "A", alt, af)
        for i in range(4) for pos, alt, af in ((1, "T", 0.2), (1, "C", 0.3), (2, "T", None), (3, "G", 0.5)) for _ in range(2)
    ]
    rows += [("L", "i0", "5", 3, "A", "G", 0.6), ("L", None, "5", 9, "A", "G", 0.6), ("M", "i0", None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "locus string, iid string, chrom string, pos long, ref string, alt string, af double")
    profile = variants.locus_profile(frame.withColumn("dosage", F.lit(1.0)))
    got = {tuple(r) for r in variants.profile_counts(profile).collect()}
    assert got == {tuple(r) for r in variants.sample_variant_counts(frame).collect()} and len(got) == 2
    want = sorted(map(tuple, frame.drop("iid").distinct().collect()), key=str)
    assert sorted(map(tuple, variants.profile_variants(profile).collect()), key=str) == want
    assert variants.locus_profile(frame.limit(0)).count() == 0
