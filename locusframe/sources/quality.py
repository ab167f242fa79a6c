"""Input checks: missing, unreadable or empty input fails the run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class MissingInput(Exception):
    exit_code = 2


class EmptyInput(Exception):
    exit_code = 3


def require_text_input(
    spark: SparkSession, path: str, read: Callable[[SparkSession, str], DataFrame] | None = None
) -> DataFrame:
    """Lines of ``path``, by ``read`` if given; raises MissingInput or EmptyInput."""
    try:
        lines = spark.read.text(path) if read is None else read(spark, path)
    except AnalysisException as error:
        raise MissingInput(f"{path} does not exist or cannot be read") from error
    if lines.isEmpty():
        raise EmptyInput(f"{path} is empty")
    return lines


def regions_without_variants(regions: DataFrame, region_variants: DataFrame) -> DataFrame:
    """Regions none of whose variants were found."""
    return regions.join(region_variants.select("locus").distinct(), "locus", "left_anti")
