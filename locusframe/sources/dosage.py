"""Headerless dosage, frequency and key files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOSAGE_SCHEMA = T.StructType(
    [
        T.StructField("iid", T.StringType()),
        T.StructField("chrom", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("marker_id", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("alt", T.StringType()),
        T.StructField("af", T.DoubleType()),
        T.StructField("dosage", T.DoubleType()),
    ]
)

FREQUENCY_SCHEMA = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("alt", T.StringType()),
        T.StructField("af", T.DoubleType()),
    ]
)


def scan_dosage(spark: SparkSession, path: str, skip_first_row: bool = False) -> DataFrame:
    """Long dosage rows, ``.`` read as null. Below a ``locus=...`` layout the
    locus comes along as a column. ``skip_first_row`` drops the first row of
    each file, as a reader expecting a header would."""
    return spark.read.csv(
        path, sep="\t", header=skip_first_row, nullValue=".", schema=DOSAGE_SCHEMA
    )


def scan_frequencies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=False, nullValue=".", schema=FREQUENCY_SCHEMA)


def scan_variant_keys(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed variant key per non-blank line."""
    lines = spark.read.text(path).withColumnRenamed("value", "variant")
    return lines.select(F.trim("variant").alias("variant"), *lines.columns[1:]).filter(
        F.length("variant") > 0
    )
