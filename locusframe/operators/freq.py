"""Allele frequency histograms and bin widths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.genotype import fold_frequency
from locusframe.session import small_side


def folded(variants: DataFrame) -> DataFrame:
    return variants.withColumn("afc", fold_frequency(F.col("af")))


def quartiles(values: DataFrame, key: str = "locus", x: str = "afc") -> DataFrame:
    """Interpolated quartiles (type 7): h = (n - 1) p.

    Equal values are counted first, so a group brings together one row per
    distinct value.
    """
    counted = values.filter(F.col(x).isNotNull()).groupBy(key, x).agg(F.count("*").alias("_n"))
    both = F.percentile(x, F.array(F.lit(0.25), F.lit(0.75)), F.col("_n"))
    return counted.groupBy(key).agg(both.alias("_q")).select(
        key, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3")
    )


def bin_width(variants: DataFrame) -> DataFrame:
    """Freedman-Diaconis width 2 IQR / n^(1/3) and the number of bins."""
    values = folded(variants).select("locus", "afc")
    size = values.groupBy("locus").agg(
        F.count("afc").alias("n"), F.min("afc").alias("lo"), F.max("afc").alias("hi")
    )
    width = 2 * (F.col("q3") - F.col("q1")) / F.pow(F.col("n"), F.lit(1.0 / 3.0))
    bins = F.when(F.col("width") > 0, F.ceil((F.col("hi") - F.col("lo")) / F.col("width")))
    return (
        size.join(quartiles(values), "locus")
        .select("locus", "n", "lo", "hi", width.alias("width"))
        .select("locus", "n", "width", bins.alias("bins"))
    )


# Round steps are 1, 2, 5 or 10 times a power of ten. As the help page of R's
# pretty() documents them, a larger multiple is preferred by a bias of 1.5, and
# 5 over 2 by 0.5 + 1.5 * 1.5: a multiple gives way to the next one where the
# wanted step lies beyond their mean, in which the smaller one weighs as much as
# its bias (fixed values).
_MULTIPLES = (1.0, 2.0, 5.0, 10.0)
_BIASES = (1.5, 2.75, 1.5)


def round_step(lo: Column, hi: Column, n: int) -> Column:
    """Round step that cuts [lo, hi] into about ``n`` parts; a tenth of the
    value's magnitude (or of 1) where both ends are equal."""
    magnitude = F.greatest(F.abs(lo), F.abs(hi))
    alone = F.when(magnitude > 0, magnitude).otherwise(F.lit(1.0)) / 10
    wanted = F.when(hi > lo, (hi - lo) / n).otherwise(alone)
    ten = F.pow(F.lit(10.0), F.floor(F.log10(wanted)))
    step = ten * _MULTIPLES[-1]
    for small, large, bias in reversed(list(zip(_MULTIPLES, _MULTIPLES[1:], _BIASES))):
        step = F.when(wanted <= ten * (large + bias * small) / (1 + bias), ten * small).otherwise(step)
    return step


def covering_multiples(lo: Column, hi: Column, step: Column) -> tuple[Column, Column]:
    """Numbers of the multiples of ``step`` that enclose [lo, hi]; at least one
    step apart."""
    nearly = 1e-10
    first = F.floor(lo / step + nearly)
    return first, F.greatest(F.ceil(hi / step - nearly), first + 1)


def histogram_breaks(variants: DataFrame, n: int = 7) -> DataFrame:
    """Counts between round breaks; intervals closed on the right, the lowest
    break included; empty intervals are listed with 0."""
    values = folded(variants).select("locus", "afc").filter(F.col("afc").isNotNull())
    ends = values.groupBy("locus").agg(F.min("afc").alias("_lo"), F.max("afc").alias("_hi"))
    grid = ends.withColumn("step", round_step(F.col("_lo"), F.col("_hi"), n))
    first, last = covering_multiples(F.col("_lo"), F.col("_hi"), F.col("step"))
    grid = grid.select("locus", "step", first.alias("first"), last.alias("last"))
    fuzz = 1e-7
    place = F.ceil(F.col("afc") / F.col("step") - F.col("first") - fuzz)
    bin_no = F.least(F.greatest(place, F.lit(1)), F.col("last") - F.col("first"))
    counts = (
        values.join(small_side(grid, "grid"), "locus")
        .groupBy("locus", bin_no.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    empty = grid.select(
        "locus", "step", "first",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("last") - F.col("first"))).alias("bin"),
    )
    return empty.join(counts, ["locus", "bin"], "left").select(
        "locus", "bin",
        ((F.col("first") + F.col("bin") - 1) * F.col("step")).alias("beg"),
        ((F.col("first") + F.col("bin")) * F.col("step")).alias("end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def count_axis_limit(histogram: DataFrame, n: int = 5) -> DataFrame:
    """Upper end of a round axis over the interval counts."""
    ends = histogram.groupBy("locus").agg(
        F.min("n").cast("double").alias("lo"), F.max("n").cast("double").alias("hi")
    )
    step = round_step(F.col("lo"), F.col("hi"), n)
    _, last = covering_multiples(F.col("lo"), F.col("hi"), F.col("step"))
    return ends.withColumn("step", step).select("locus", (last * F.col("step")).alias("y_limit"))


def histogram_30(variants: DataFrame, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal intervals, the first centred on the minimum;
    width = range / (bins - 1), closed on the right; empty ones count 0.

    Equal frequencies are counted once; what is left of a locus, one row per
    distinct frequency, is placed beside the locus' ends and laid out as one
    row of ``bins`` slots.
    """
    values = folded(variants).filter(F.col("afc").isNotNull()).groupBy("locus", "afc").agg(F.count("*").alias("n"))
    ends = values.groupBy("locus").agg(F.min("afc").alias("_lo"), F.max("afc").alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    width = F.when(span > 0, span / (bins - 1)).otherwise(F.lit(0.1))
    place = F.ceil((F.col("afc") - F.col("_lo")) / width + 0.5 - 1e-8)
    counts = (
        values.join(ends, "locus")
        .groupBy("locus", F.least(F.greatest(place, F.lit(1)), F.lit(bins)).alias("bin"))
        .agg(F.sum("n").alias("n"))
        .groupBy("locus")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_counts"))
    )
    every = F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))
    slots = F.transform(every, lambda i: F.struct(i.alias("bin"), F.coalesce(F.col("_counts")[i], F.lit(0)).alias("n")))
    return counts.select("locus", F.inline(slots))
