from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.config import Thresholds, optional_path
from locusframe.functions import genotype, keys, labels
from locusframe.functions.student import two_sided_p


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(column.alias("x")).first()[0]


def test_thresholds_accept_text_numbers():
    t = Thresholds.from_mapping({"max_haps": "4e6", "min_pp": "1e-5", "n_try": "3"})
    assert (t.max_haps, t.min_pp, t.n_try) == (4e6, 1e-5, 3)
    with pytest.raises(ValueError):
        Thresholds.from_mapping({"nope": 1})


@pytest.mark.parametrize("value", [None, "", "None"])
def test_optional_path_off(value):
    assert optional_path(value) is None


@pytest.mark.parametrize(
    "t, df, p",
    [(1.0, 1, 0.5), (0.5, 2, 2 / 3), (0.0, 7, 1.0), (math.sqrt(2), 2, 1 - math.sqrt(0.5))],
)
def test_t_closed_forms(t, df, p):
    assert two_sided_p(np.array([t]), np.array([df]))[0] == pytest.approx(p, rel=1e-12)


def test_t_published_value_and_tail():
    # An effect of 2.0776 standard errors at 12810 degrees of freedom is
    # published with p = 0.03777; t = 12.4 must not underflow to 0.
    p = two_sided_p(np.array([2.0776, 12.4]), np.array([12810.0, 12810.0]))
    assert p[0] == pytest.approx(0.03777, abs=1e-5)
    assert 0 < p[1] < 1e-30
    assert np.isnan(two_sided_p(np.array([1.0]), np.array([0.0]))[0])


def test_t_is_symmetric_and_monotone():
    t = np.linspace(0, 40, 400)
    p = two_sided_p(t, np.full_like(t, 33.0))
    assert np.all(np.diff(p) < 0)
    assert np.array_equal(p, two_sided_p(-t, np.full_like(t, 33.0)))


@pytest.mark.parametrize(
    "ref, alt, want",
    [("A", "AT", "T"), ("ATG", "A", "-"), ("A", "G", "G"), ("AT", "GC", "GC"), ("AT", "GCC", "GCC")],
)
def test_lookup_allele(spark, ref, alt, want):
    assert one(spark, keys.lookup_allele(F.col("r"), F.col("a")), r=ref, a=alt) == want


@pytest.mark.parametrize(
    "key, ok", [(" 5:12:A:G ", True), ("5:12:A", False), ("5:x:A:G", False), ("5:12:A:G:T", False)]
)
def test_parse_variant_key(spark, key, ok):
    got = one(spark, keys.parse_variant_key(F.col("k")), k=key)
    assert (got is not None) == ok
    if ok:
        assert tuple(got) == ("5", 12, "A", "G")


def test_position_keys(spark):
    assert one(spark, keys.position_key_from_snp_id(F.lit("chr5_123_A_G"))) == "5:123"
    assert one(spark, keys.position_key_from_snp_id(F.lit("chrX_123_A_G"))) is None
    assert one(spark, keys.position_key_from_variant(F.lit("5:123:A:G"))) == "5:123"
    assert one(spark, keys.region_string(F.lit("22"), F.lit(5), F.lit(9))) == "22:5-9"


@pytest.mark.parametrize(
    "name, ok",
    [("chr5_1_A_G", True), ("CHR5_1_a_g", True), ("chrX_1_A_G", False), ("chr5_1_A_<DEL>", False), ("age", False)],
)
def test_genotype_column_names(spark, name, ok):
    assert one(spark, keys.is_snp_id(F.col("n")), n=name) is ok


@pytest.mark.parametrize(
    "term, want, legacy",
    [
        ("3_prime_UTR_variant", "UTR3'", "UTR3'TR"),
        ("5_prime_UTR_variant", "UTR5'", "UTR5'"),
        ("splice_region_variant", "splice_region", "splice_region"),
    ],
)
def test_consequences(spark, term, want, legacy):
    assert one(spark, labels.clean_consequence(F.col("t")), t=term) == want
    assert one(spark, labels.clean_consequence_legacy(F.col("t")), t=term) == legacy


@pytest.mark.parametrize(
    "term, want",
    [
        ("haplo_genotype.5", "H005"),
        ("haplo_genotype.57", "H057"),
        ("haplo_genotype.157", "H157"),
        ("haplo_genotype.rare", "Hrare"),
        ("haplo.base", "Ref."),
        ("Age", "Age"),
    ],
)
def test_haplotype_labels(spark, term, want):
    assert one(spark, labels.pad_haplotype_label(F.col("t")), t=term) == want


def test_snp_labels(spark):
    assert one(spark, labels.clean_snp_label(F.lit("chr5_12_A_G"))) == "chr5:12_A_G"
    assert one(spark, labels.clean_snp_label(F.lit("chr_5_12_A"))) == "5:12_A"
    assert one(spark, labels.axis_label(F.lit(None).cast("string"), F.lit("x"))) == "NA_x"


@pytest.mark.parametrize("d, want", [(0.5, 0), (1.5, 2), (2.5, 2), (0.51, 1), (1.49, 1)])
def test_rounding_goes_to_even(spark, d, want):
    assert one(spark, genotype.round_dosage(F.col("d")), d=d) == want


@pytest.mark.parametrize(
    "code, af, want",
    [(1, 0.5, "ALT"), (2, 0.5, "ALT"), (1, 0.2, "REF"), (2, 0.2, "ALT"), (1, 0.8, "ALT"), (2, 0.8, "REF")],
)
def test_shown_allele(spark, code, af, want):
    column = genotype.shown_allele(F.col("c"), F.lit("REF"), F.lit("ALT"), F.col("f"))
    got = one(spark, column, c=code, f=af)
    # Rule in terms of the original columns; code 2 shows its swapped pair.
    rule = ("ALT" if af >= 0.5 else "REF") if code == 1 else ("REF" if af > 0.5 else "ALT")
    assert rule == want
    assert got == want


def test_missing_and_reference_codes(spark):
    assert one(spark, genotype.missing_code(F.lit(0))) is None
    differs = genotype.differs_from_reference(F.lit(None).cast("int"), F.lit(1))
    assert one(spark, differs) is None
    assert one(spark, genotype.differs_from_reference(F.lit(1), F.lit(None).cast("int"))) is True
    assert one(spark, labels.significant(F.lit(0.05))) == "Yes"
    assert one(spark, labels.significant(F.lit(None).cast("double"))) is None
