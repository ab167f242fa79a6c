from __future__ import annotations

import gzip
import random

import pytest

from checks.common import block_bytes
from locusframe.operators.variants import region_interval_join
from locusframe.plans.run import extract_regions
from locusframe.sources import blocks, vcf

SLAB = 131_072
HEAD = ["##fileformat=VCFv4.2", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "a", "b"])]


def record(rng, chrom, pos, extra=""):
    noise = "".join(rng.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(rng.choice([20, 80, 700])))
    return f"{chrom}\t{pos}\trs{pos}\tA\tG\t.\tPASS\tAF=0.25;N={noise}{extra}\tDS\t{rng.random():.3f}\t."


def text_of(rng, n=5000):
    lines = [record(rng, chrom, 1000 * i) for chrom in ("5", "22") for i in range(1, n // 2)]
    # A long record that reaches far beyond its own slab.
    lines[300] = record(rng, "5", 301_000, ";END=2200500")
    return HEAD + lines


def write_blocks_file(path, data: bytes, raw=0xFF00):
    path.write_bytes(b"".join(block_bytes([data], raw)))
    return str(path)


def test_one_file_of_many_blocks_is_read_by_many_tasks(spark, tmp_path):
    lines = text_of(random.Random(1))
    path = write_blocks_file(tmp_path / "a.vcf.gz", ("\n".join(lines) + "\n").encode())
    files, others = blocks.text_files(spark, path)
    assert len(files) == 1 and others == []
    read = blocks.slab_lines(blocks.slabs_of(spark, files, SLAB))
    assert read.select("slab").distinct().count() == -(-files[0][1] // SLAB) >= 6
    assert read.rdd.getNumPartitions() >= 6
    assert sorted(r.value for r in read.collect()) == sorted(lines)


@pytest.mark.parametrize("end", ["\n", ""])
@pytest.mark.parametrize("raw", [0xFF00, 1000])
def test_lines_at_any_border(spark, tmp_path, raw, end):
    rng = random.Random(raw)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    make = lambda n: "".join(rng.choices(letters, k=n))
    # Empty lines, lines that end where a block ends, one longer than three slabs.
    lines = [make(999) for _ in range(200)] + ["", "", make(0xFEFF), make(600_000), "", "ü\r"] + [make(rng.randrange(3000)) for _ in range(150)]
    path = write_blocks_file(tmp_path / "b.gz", ("\n".join(lines) + end).encode(), raw)
    got = [r.value for r in blocks.read_lines(spark, path, SLAB).collect()]
    assert sorted(got) == sorted(x.removesuffix("\r") for x in lines)


def test_other_files_go_to_the_text_reader(spark, tmp_path):
    lines = text_of(random.Random(2), 700)
    text = ("\n".join(lines) + "\n").encode()
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "plain.vcf").write_bytes(text)
    (tmp_path / "v" / "single.vcf.gz").write_bytes(gzip.compress(text))
    write_blocks_file(tmp_path / "v" / "blocks.vcf.gz", text)
    (tmp_path / "v" / "empty.vcf").write_bytes(b"")
    files, others = blocks.text_files(spark, str(tmp_path / "v"))
    assert [x[0].rsplit("/", 1)[1] for x in files] == ["blocks.vcf.gz"] and len(others) == 2
    got = [r.value for r in vcf.read_vcf_lines(spark, str(tmp_path / "v")).collect()]
    assert sorted(got) == sorted(lines * 3)
    (tmp_path / "broken.gz").write_bytes((tmp_path / "v" / "blocks.vcf.gz").read_bytes()[:-40])
    with pytest.raises(Exception):
        blocks.read_lines(spark, str(tmp_path / "broken.gz")).collect()


def test_regions_open_only_their_slabs(spark, tmp_path):
    lines = text_of(random.Random(3))
    path = write_blocks_file(tmp_path / "a.vcf.gz", ("\n".join(lines) + "\n").encode())
    index = vcf.vcf_index(spark, path, SLAB)
    index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    assert index.where("chrom is not null").groupBy().sum("n_records").first()[0] == len(lines) - 2
    schema = "locus string, chrom string, beg long, end long"
    every = index.select("slab").distinct().count()
    opened = {}
    for name, rows in {
        "none": [("N", "9", 1, 10)], "one": [("A", "22", 5_000, 9_000)],
        # Far from the long record's start, but within its END.
        "long": [("L", "5", 2_200_000, 2_200_100)], "two": [("A", "22", 5_000, 9_000), ("B", "5", 2_000_000, 2_100_000)],
    }.items():
        regions = spark.createDataFrame(rows, schema)
        opened[name] = vcf.region_slabs(index, regions).count()
        full = region_interval_join(vcf.vcf_variants(vcf.read_vcf_lines(spark, path, SLAB)), regions)
        pruned = region_interval_join(vcf.vcf_variants(vcf.read_vcf_regions(spark, path, regions, index)), regions)
        assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, full.collect()))
        if name == "long":
            assert any(r.pos == 301_000 for r in pruned.collect())
    assert opened["none"] == 1 and opened["none"] < opened["one"] <= 3 and opened["one"] < opened["two"] < every
    # A file that has changed since is read whole.
    write_blocks_file(tmp_path / "a.vcf.gz", ("\n".join(lines[:2000]) + "\n").encode())
    regions = spark.createDataFrame([("N", "9", 1, 10)], schema)
    assert vcf.read_vcf_regions(spark, path, regions, index).count() == 2000


def test_extraction_with_an_index(spark, tmp_path):
    lines = text_of(random.Random(4), 3000)
    path = write_blocks_file(tmp_path / "a.vcf.gz", ("\n".join(lines) + "\n").encode())
    regions = spark.createDataFrame([("A", "22", 5_000, 9_000), ("N", "1", 1, 2)], "locus string, chrom string, beg long, end long")
    first = extract_regions(spark, path, regions, str(tmp_path / "x"), str(tmp_path / "index"))
    again = extract_regions(spark, path, regions, str(tmp_path / "y"), str(tmp_path / "index"))
    plain = extract_regions(spark, path, regions, str(tmp_path / "z"))
    rows = [sorted(map(tuple, e.dosage.select("locus", "iid", "pos", "dosage").fillna(-1).collect())) for e in (first, again, plain)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 10
    assert [r.locus for r in again.empty_regions.collect()] == ["N"]
