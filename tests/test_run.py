"""A whole run over literal text files."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from locusframe.plans.report import read_report, write_report
from locusframe.plans.run import extract_regions, read_phenotypes, run_config
from locusframe.sources.annotation import ANNOTATION_DDL
from locusframe.sources.tables import scan_regions


def files(tmp_path, n=60):
    rng = random.Random(4)
    ids = [f"0{i}" for i in range(n)]
    head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *ids])
    lines, copies = ["##fileformat=VCFv4.2", head], {}
    for pos, ref, alt in ((100, "A", "G"), (150, "C", "CT"), (200, "G", "A"), (900, "T", "C")):
        calls = [rng.choice([0, 0, 1, 1, 2]) for _ in ids]
        copies[pos] = calls
        af = sum(calls) / (2 * n)
        lines.append("\t".join(["22", str(pos), f"rs{pos}", ref, alt, ".", "PASS", f"AF={af}", "GT:DS",
                                *[f"0/1:{c + 0.1}" for c in calls]]))
    (tmp_path / "a.vcf").write_text("\n".join(lines) + "\n")
    (tmp_path / "r.txt").write_text("CHROM\tBEG\tEND\tLOCUS\n22\t90\t250\tONE\n22\t140\t1000\tTWO\n21\t1\t9\tNONE\n")
    traits = [f"{i},{copies[100][k] * 4 + rng.gauss(0, 1)},{rng.gauss(0, 1)}" for k, i in enumerate(ids)]
    (tmp_path / "p.tsv").write_text("\n".join(["IID,big,small", *traits]) + "\n")
    (tmp_path / "q.csv").write_text("\n".join(["IID;other", *[f"{i};{rng.gauss(0, 1)}" for i in ids]]) + "\n")
    (tmp_path / "c.tsv").write_text("\n".join(["IID\tAge", *[f"{i}\t{rng.randrange(20, 80)}" for i in ids]]) + "\n")


def test_run(spark, tmp_path):
    files(tmp_path)
    out = tmp_path / "out"
    run = run_config(
        spark,
        {
            "datasets": "clinical,proteomics",
            "phenotype_files": f"{tmp_path}/p.tsv, {tmp_path}/q.csv",
            "covariates_file": f"{tmp_path}/c.tsv",
            "path_loci": f"{tmp_path}/r.txt",
            "path_vcf": f"{tmp_path}/a.vcf",
            "path_workspace": str(out),
            "thresholds": {"min_freq": "0.05", "max_haps": "4e6", "min_ac": 5},
        },
    )
    tidy = spark.read.parquet(f"{out}/results")
    models = {(r.locus, r.dataset, r.trait_name) for r in tidy.collect()}
    assert models == {
        (locus, d, t) for locus in ("ONE", "TWO")
        for d, t in (("clinical", "big"), ("clinical", "small"), ("proteomics", "other"))
    }
    best = tidy.filter("locus = 'ONE' and trait_name = 'big'").orderBy("p_value").first()
    assert best.p_value < 1e-6
    signif = spark.read.csv(f"{out}/result_signif", header=True, inferSchema=True)
    assert signif.filter("`p.value` > 0.05").count() == 0 and signif.filter("trait_name = 'big'").count() > 0
    keys = {(r.locus, r.value) for r in spark.read.text(f"{out}/keys").collect()}
    assert ("ONE", "22:150:C:CT") in keys and ("TWO", "22:900:T:C") in keys and len(keys) == 6
    text = "\n".join(r.value for r in spark.read.text(f"{out}/summary").filter("locus = 'TWO' and dataset = 'clinical'").collect())
    assert "Of 3 variants, 3 left" in text and "2 traits, and 1 covariates" in text
    assert run.genotypes.count() == 120
    merged = spark.read.parquet(f"{out}/merged/clinical").filter("locus = 'ONE'")
    assert merged.count() == 60 and {"iid", "pattern", "big", "small", "Age"} <= set(merged.columns)
    report = read_report(spark, f"{out}/report")
    found = {(r.locus, r.dataset, r.section): r.n for r in report.groupBy("locus", "dataset", "section").agg(F.count("*").alias("n")).collect()}
    assert found["ONE", "all", "histogram"] == 30
    assert found["TWO", "clinical", "results"] == tidy.filter("locus = 'TWO' and dataset = 'clinical'").count()
    assert {s for locus, d, s in found if locus == "ONE" and d == "clinical"} >= {"summary", "effects", "results", "significant", "haplotypes"}
    # The first trait of the file, not of the alphabet, is the example; effects are a row per haplotype.
    row = report.filter("section = 'effects' and locus = 'ONE' and dataset = 'clinical'").first()
    assert set(row.numbers) == {"big", "small"} and set(row.labels) == {"haplo"}
    # One report written again leaves the others as they are.
    one = report.filter("locus = 'ONE' and section = 'results'").limit(1)
    again = spark.createDataFrame(one.collect(), one.schema)
    write_report(again, f"{out}/report")
    after = {(r.locus, r.dataset, r.section): r.n for r in read_report(spark, f"{out}/report").groupBy("locus", "dataset", "section").agg(F.count("*").alias("n")).collect()}
    changed = {k for k in found if after.get(k) != found[k]}
    assert after.keys() == found.keys() and len(changed) == 1 and next(iter(changed))[::2] == ("ONE", "results")
    assert {len(r.pattern) for r in run.genotypes.collect()} == {3}


def test_run_with_annotations(spark, tmp_path):
    """The lookup is stored once and serves the next run without its source."""
    files(tmp_path)
    record = {"most_severe_consequence": "missense_variant", "input_ref_allele": "A", "input_alt_allele": "G",
              "colocated_variants": [{"id": "rs100", "frequencies": {"G": {"gnomadg": 0.25}}}]}
    text = json.dumps({"variant": "22:100:A:G", "annotation": [record]})
    rows = spark.createDataFrame([(100, "G"), (100, "G"), (200, "G"), (100, None)], "pos long, allele string").withColumn("text", F.lit(text))
    rows.select(F.lit("22").alias("chrom"), "pos", "allele", F.from_json("text", ANNOTATION_DDL)["annotation"].alias("annotation")).write.parquet(f"{tmp_path}/lookup")
    config = {
        "datasets": "clinical", "phenotype_files": f"{tmp_path}/p.tsv", "path_loci": f"{tmp_path}/r.txt", "path_vcf": f"{tmp_path}/a.vcf",
        "thresholds": {"min_freq": "0.05", "min_ac": 5}, "joint": "false", "annotation_store": f"{tmp_path}/store",
    }
    for place, more in (("one", {"annotation_lookup": f"{tmp_path}/lookup"}), ("two", {})):
        run_config(spark, {**config, **more, "path_workspace": f"{tmp_path}/{place}"})
        got = spark.read.parquet(f"{tmp_path}/{place}/annotation/variants")
        hits = {(r.locus, r.variant, r.swapped) for r in got.filter("annotation is not null").collect()}
        assert hits == {("ONE", "22:100:A:G", False), ("ONE", "22:200:G:A", True), ("TWO", "22:200:G:A", True)}
        assert got.count() == 6
        report = read_report(spark, f"{tmp_path}/{place}/report")
        assert report.filter("section = 'annotation'").count() > 0


def test_empty_regions_are_reported(spark, tmp_path):
    files(tmp_path)
    regions = scan_regions(spark, f"{tmp_path}/r.txt")
    got = extract_regions(spark, f"{tmp_path}/a.vcf", regions, f"{tmp_path}/genotype")
    assert [r.locus for r in got.empty_regions.collect()] == ["NONE"]
    assert got.dosage.count() == 6 * 60
    tables = read_phenotypes(spark, "b,a", f"{tmp_path}/p.tsv,{tmp_path}/q.csv")
    assert list(tables) == ["a", "b"] and tables["b"].columns == ["iid", "big", "small"]
