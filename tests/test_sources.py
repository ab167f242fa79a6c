from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from locusframe.operators.variants import region_interval_join
from locusframe.sinks import tables as sinks
from locusframe.sources import annotation, dosage, quality, tables, vcf


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("header", ["CHROM\tBEG\tEND\tLOCUS\n", ""])
def test_regions(spark, tmp_path, header):
    path = write(tmp_path / "r.txt", header + "22\t50\t90\tZED \n5\t10\t20\tABC\n")
    rows = tables.scan_regions(spark, path).collect()
    assert [tuple(r) for r in rows] == [("ABC", "5", 10, 20), ("ZED", "22", 50, 90)]


def test_catalog_trims_paths_only(spark):
    config = spark.createDataFrame([("b,a ", " x.tsv, y.csv")], ["datasets", "phenotype_files"])
    assert [tuple(r) for r in tables.dataset_catalog(config).collect()] == [("a ", "y.csv"), ("b", "x.tsv")]
    uneven = spark.createDataFrame([("b,a", "x")], ["datasets", "phenotype_files"])
    with pytest.raises(Exception, match="differ in number"):
        tables.dataset_catalog(uneven).collect()


@pytest.mark.parametrize("sep", [",", "\t", ";"])
def test_phenotypes_keep_ids_as_text(spark, tmp_path, sep):
    lines = [["IID", "t1", "t_2"], ["10-3", "1.5", "x"], ["10.1_B", "", "2"], ["007", "-1e3", "NA"]]
    path = write(tmp_path / "p.tsv", "\n".join(sep.join(x) for x in lines) + "\n")
    rows = {r.iid: (r.t1, r.t_2) for r in tables.scan_phenotypes(spark, path).collect()}
    assert rows == {"10-3": (1.5, None), "10.1_B": (None, 2.0), "007": (-1000.0, None)}
    assert tables.scan_covariates(spark, "None") is None


def test_dosage_dots_and_first_row(spark, tmp_path):
    text = "007\t5\t10\trs1\tA\tG\t0.1\t.\n10-3\t5\t10\trs1\tA\tG\t.\t1.5\n"
    path = write(tmp_path / "x.dosage", text)
    rows = dosage.scan_dosage(spark, path).collect()
    assert [(r.iid, r.af, r.dosage) for r in rows] == [("007", 0.1, None), ("10-3", None, 1.5)]
    assert dosage.scan_dosage(spark, path, skip_first_row=True).count() == 1


VCF = """##fileformat=VCFv4.2
#CHROM	POS	ID	REF	ALT	QUAL	FILTER	INFO	FORMAT	10-3	007
5	10	rs1	A	G	.	PASS	AF=0.25;X=1	GT:DS	0/1:1.1	0/0:.
5	18	rs2	ATG	A	.	PASS	X=1;AF=0.5	DS	2	0.5
5	99	rs3	C	T	.	PASS	X=1	GT	0/1	0/0
"""


def test_vcf(spark, tmp_path):
    lines = vcf.read_vcf_lines(spark, write(tmp_path / "a.vcf", VCF))
    regions = spark.createDataFrame([("L", "5", 20, 99), ("M", "5", 1, 10)], "locus string, chrom string, beg long, end long")
    records = region_interval_join(vcf.vcf_variants(lines), regions)
    # rs2 starts before the region and reaches into it.
    assert {(r.locus, r.marker_id) for r in records.collect()} == {("L", "rs2"), ("L", "rs3"), ("M", "rs1")}
    long = vcf.explode_samples(vcf.vcf_variants(lines), vcf.vcf_samples(lines)).collect()
    got = {(r.marker_id, r.iid): (r.af, r.dosage) for r in long}
    assert got[("rs1", "10-3")] == (0.25, 1.1)
    assert got[("rs1", "007")] == (0.25, None)
    assert got[("rs2", "007")] == (0.5, 0.5)
    assert got[("rs3", "10-3")] == (None, None)


def test_vcf_sample_mismatch_fails(spark, tmp_path):
    write(tmp_path / "a.vcf", VCF)
    write(tmp_path / "b.vcf", VCF.replace("007", "008"))
    with pytest.raises(Exception, match="different samples"):
        vcf.vcf_samples(vcf.read_vcf_lines(spark, str(tmp_path)))


def test_worst_consequence(spark):
    csq = "G|intron_variant|S1|E1,G|missense_variant&splice_region_variant|S2|E2,G|missense_variant|S3|E3,G|odd|S4|E4"
    rows = spark.createDataFrame([("5", csq)], ["chrom", "csq"])
    got = vcf.worst_consequence(rows, ["Allele", "Consequence", "SYMBOL", "Gene"]).first()
    assert tuple(got) == ("5", "S2", "E2", "missense_variant&splice_region_variant")


def test_quality_gate(spark, tmp_path):
    with pytest.raises(quality.MissingInput) as missing:
        quality.require_text_input(spark, str(tmp_path / "none.vcf"))
    with pytest.raises(quality.EmptyInput) as empty:
        quality.require_text_input(spark, write(tmp_path / "empty.vcf", ""))
    assert (missing.value.exit_code, empty.value.exit_code) == (2, 3)


def test_key_list(spark, tmp_path):
    path = write(tmp_path / "k.snps", " 5:1:A:G \n\n   \n5:2:A:G\n")
    assert [r.variant for r in dosage.scan_variant_keys(spark, path).collect()] == ["5:1:A:G", "5:2:A:G"]


def test_annotation_array_document(spark, tmp_path):
    text = '[{"variant": "5:1:A:G", "annotation": [{"most_severe_consequence": "x"}]}, {"variant": "b"}]'
    docs = annotation.scan_annotations(spark, write(tmp_path / "a.json", text), multi_line=True)
    assert {r.variant: r.annotation is not None for r in docs.collect()} == {"5:1:A:G": True, "b": False}


def test_significant_csv_is_unquoted(spark, tmp_path):
    rows = spark.createDataFrame(
        [("L", "d", 'a"b', "H1", 1.0, 0.5, 0.01, "Yes")],
        ["locus", "dataset", "trait_name", "haplo", "estimate", "std_error", "p_value", "associated"],
    )
    out = str(tmp_path / "s")
    sinks.write_significant_csv(rows, out)
    lines = [r.value for r in spark.read.text(out).select("value").collect()]
    assert lines == ["trait_name,haplo,estimate,std.error,p.value,associated", 'a"b,H1,1.0,0.5,0.01,Yes']


def test_writers_cut_a_heavy_locus(spark, tmp_path):
    rows = spark.range(20000).select(
        F.lit("BIG").alias("locus"), F.col("id").cast("string").alias("iid"), F.lit("5").alias("chrom"),
        F.col("id").alias("pos"), F.lit("rs").alias("marker_id"), F.lit("A").alias("ref"),
        F.lit("G").alias("alt"), F.lit(0.5).alias("af"), F.lit(1.0).alias("dosage"),
    )
    sinks.write_dosage(rows, str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 20000


def test_delimiter_is_the_one_that_sets_the_id_apart(spark, tmp_path):
    path = write(tmp_path / "p.csv", 'IID,Body mass index,"LDL, direct level"\n1,2,3\n')
    assert tables.scan_phenotypes(spark, path).columns == ["iid", "Body mass index", "LDL, direct level"]


def test_text_covariates_stay_text(spark, tmp_path):
    path = write(tmp_path / "c.tsv", "IID\tAge\tSex\tBatch\n1\t30\tM\t1\n2\tNA\tF\t2\n3\t41\t\t3\n")
    got = tables.scan_covariates(spark, path)
    assert dict(got.dtypes) == {"iid": "string", "Age": "double", "Sex": "string", "Batch": "double"}
    assert [tuple(r) for r in got.orderBy("iid").collect()] == [("1", 30, "M", 1), ("2", None, "F", 2), ("3", 41, None, 3)]


def test_intermediates_need_a_shared_folder_on_a_cluster():
    from locusframe.session import is_local

    assert is_local("local") and is_local("local[8]")
    assert not is_local("local-cluster[3,2,1000]") and not is_local("spark://host:7077") and not is_local("yarn")


def test_stored_tables_can_be_discarded(spark):
    import os

    from locusframe.session import discard, materialize

    stored = materialize(spark.range(5), "short-lived")
    assert stored.count() == 5 and os.path.isdir(stored.stored_at)
    discard(stored, spark.range(2))
    assert not os.path.isdir(stored.stored_at)


def test_symbolic_alleles_reach_to_their_end_and_csq_is_read(spark, tmp_path):
    text = (
        '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequences. Format: Allele|Consequence|SYMBOL|Gene">\n'
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\n"
        "5\t10\tsv\tA\t<DEL>\t.\tPASS\tEND=50;CSQ=T|intron_variant|S|G;X=1\tDS\t1\n"
        "5\t10\tsnp\tA\tT\t.\tPASS\tX=1\tDS\t1\n"
    )
    lines = vcf.read_vcf_lines(spark, write(tmp_path / "e.vcf", text))
    regions = spark.createDataFrame([("L", "5", 40, 60)], "locus string, chrom string, beg long, end long")
    hits = region_interval_join(vcf.vcf_variants(lines), regions).collect()
    assert [(r.marker_id, r.stop) for r in hits] == [("sv", 50)]
    assert vcf.csq_fields(lines) == ["Allele", "Consequence", "SYMBOL", "Gene"]
    assert {r.marker_id: r.csq for r in vcf.with_csq(vcf.vcf_variants(lines)).collect()} == {
        "sv": "T|intron_variant|S|G", "snp": None,
    }
