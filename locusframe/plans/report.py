"""The report of each locus and dataset as one stored table.

A row of a section is two maps, its labels and its numbers, so that sections of
any columns share one table: (locus, dataset, section, labels, numbers). What
belongs to a locus as a whole has the dataset ``all``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.operators.display import shrink_varying_biallelic
from locusframe.operators.freq import histogram_30
from locusframe.operators.merge import summary_text
from locusframe.operators.results import drop_reference, significant_results, tidied_results
from locusframe.plans.annotation import consequence_table
from locusframe.plans.association import Association

WHOLE_LOCUS = "all"
_KEYS = ("locus", "dataset")

#: What of the display table a report shows.
SHOWN = ["haplotype", "snp_id", "variant", "allele", "true_allele", "xlab_annot", "hap_pos", "code", "af", "n_allele", "xlab_rank"]


def effect_rows(results: DataFrame) -> DataFrame:
    """The effect matrix: one row per haplotype, its traits as a map, so that
    datasets of any traits go together. A model's traits bound the row."""
    cells = drop_reference(results).filter(F.col("estimate").isNotNull())
    trait = F.replace("trait_name", F.lit("_"), F.lit(":"))
    return cells.groupBy(*_KEYS, "haplo").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(trait, "estimate")))).alias("effects")
    )


def report_sections(
    association: Association,
    frequencies: DataFrame,
    merged: DataFrame,
    documents: DataFrame | None = None,
    display: DataFrame | None = None,
    rejected: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Sections by name; those whose input is not at hand are left out."""
    tidied = tidied_results(association.results)
    sections = {
        "histogram": histogram_30(frequencies),
        "summary": summary_text(merged),
        "effects": effect_rows(association.results),
        "results": tidied,
        "significant": significant_results(association.results),
    }
    if documents is not None:
        sections["annotation"] = consequence_table(documents)
    if display is not None:
        sections["haplotypes"] = display.select(*_KEYS, *SHOWN)
        sections["haplotypes_shrunk"] = shrink_varying_biallelic(display).select(*_KEYS, *SHOWN)
    if rejected is not None:
        sections["rejected"] = rejected
    return sections


def _map(columns: list[tuple[str, Column]], kind: str) -> Column:
    """Map of the columns that have a value."""
    entries = [F.struct(F.lit(name).alias("key"), value.cast(kind).alias("value")) for name, value in columns]
    if not entries:
        return F.create_map().cast(f"map<string,{kind}>")
    return F.map_filter(F.map_from_entries(F.array(*entries)), lambda _, v: v.isNotNull())


def section_rows(name: str, rows: DataFrame) -> DataFrame:
    """Rows of one section in the common form; a map column of numbers is
    laid out among the numbers."""
    texts, numbers, maps = [], [], []
    for field in rows.schema:
        if field.name in _KEYS:
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType):
            maps.append(column.cast("map<string,double>"))
        elif isinstance(field.dataType, T.NumericType):
            numbers.append((field.name, column))
        else:
            texts.append((field.name, column))
    dataset = F.col("dataset") if "dataset" in rows.columns else F.lit(WHOLE_LOCUS)
    number = F.map_concat(_map(numbers, "double"), *maps) if maps else _map(numbers, "double")
    return rows.select("locus", dataset.alias("dataset"), F.lit(name).alias("section"), _map(texts, "string").alias("labels"), number.alias("numbers"))


def report_table(sections: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [section_rows(name, rows) for name, rows in sections.items()])


def write_report(table: DataFrame, path: str) -> None:
    """Replace the sections that ``table`` holds and leave all others: a report
    of one locus can be written again without touching the rest."""
    by = [*_KEYS, "section"]
    clustered = table.repartitionByRange(*by).sortWithinPartitions(*by)
    clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_report(spark, path: str) -> DataFrame:
    """The stored report; folders named by locus, dataset and section prune."""
    table = spark.read.parquet(path)
    return table.withColumns({c: F.col(c).cast("string") for c in (*_KEYS, "section")})
