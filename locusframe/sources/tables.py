"""Region lists, dataset catalogs, phenotype and covariate tables."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.config import optional_path

DELIMITERS = (",", "\t", ";", "|", " ")


def scan_regions(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated CHROM, BEG, END, LOCUS file; the header line is dropped
    by value, so files with and without one both work."""
    names = ("chrom", "beg", "end", "locus")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.csv(path, sep="\t", header=False, schema=schema)
    return normalize_regions(raw)


def normalize_regions(raw: DataFrame) -> DataFrame:
    """Typed, trimmed regions sorted by locus."""
    locus = F.trim("locus")
    return (
        raw.filter(locus != "LOCUS")
        .select(
            locus.alias("locus"),
            F.trim("chrom").alias("chrom"),
            F.col("beg").cast("bigint").alias("beg"),
            F.col("end").cast("bigint").alias("end"),
        )
        .orderBy("locus")
    )


def dataset_catalog(config: DataFrame, names: str = "datasets", paths: str = "phenotype_files") -> DataFrame:
    """Zip two comma lists into (data_type, data_path) rows, by name.

    Paths are trimmed, names are not. Lists of different length fail.
    """
    name_list, path_list = F.split(names, ","), F.split(paths, ",")
    zipped: Column = F.when(
        F.size(name_list) == F.size(path_list),
        F.arrays_zip(
            name_list.alias("data_type"),
            F.transform(path_list, lambda p: F.trim(p)).alias("data_path"),
        ),
    ).otherwise(F.raise_error(F.lit("datasets and phenotype files differ in number")))
    keep = [c for c in config.columns if c not in (names, paths)]
    return config.select(*keep, F.inline(zipped).alias("data_type", "data_path")).orderBy(
        *keep, "data_type"
    )


def _header(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    found: list[tuple[str, list[str]]] = []
    for sep in DELIMITERS:
        names = [n.strip() for n in next(csv.reader([first[0]], delimiter=sep))]
        if "IID" in names:
            found.append((sep, names))
    if not found:
        raise ValueError(f"{path} has no IID column")
    # The delimiter is one that sets IID apart; of several, the one with most fields.
    return max(found, key=lambda x: len(x[1]))


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """Delimited table with an IID column; the delimiter is found in the
    header line. Every column is read as a string, IID becomes ``iid``."""
    sep, names = _header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    table = spark.read.csv(path, sep=sep, header=True, schema=schema)
    return table.withColumnRenamed("IID", "iid")


def value_columns(table: DataFrame) -> list[str]:
    """Trait or covariate names: every column but the individual id."""
    return [c for c in table.columns if c != "iid"]


def to_numeric(table: DataFrame) -> DataFrame:
    """Coerce every value column to double; unreadable cells become null."""
    return table.select(
        "iid", *[F.col(f"`{c}`").try_cast("double").alias(c) for c in value_columns(table)]
    )


def scan_phenotypes(spark: SparkSession, path: str) -> DataFrame:
    return to_numeric(scan_table(spark, path))


def scan_covariates(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Covariates, or None when the setting is null, '' or 'None'.

    A column whose every value is a number becomes double; any other stays
    text (a factor). Blank and NA cells are missing.
    """
    path = optional_path(path)
    if path is None:
        return None
    raw = scan_table(spark, path)
    names = value_columns(raw)
    cells = {c: F.when(~F.trim(f"`{c}`").isin("", "NA"), F.trim(f"`{c}`")) for c in names}
    text = raw.select(*[F.coalesce(F.bool_or(x.isNotNull() & x.try_cast("double").isNull()), F.lit(False)).alias(str(i)) for i, x in enumerate(cells.values())]).first()
    return raw.select(
        "iid", *[(x if text[i] else x.try_cast("double")).alias(c) for i, (c, x) in enumerate(cells.items())]
    )
