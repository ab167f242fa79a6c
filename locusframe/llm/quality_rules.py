"""Operator 3: a threshold table compiled into one projection.

Every measure of a text is a column expression, every threshold a bound on a
measure or on a ratio of two; ``verdict`` compiles the table into one boolean.
Nothing leaves the JVM and nothing is shuffled.

Defined results: a null text has no words, all counts 0, and fails the base
rule; a ratio whose denominator is 0 counts as 0; rows, repeated or with null
ids, are judged one by one; an empty table gives no row; measures are added in
one struct, so columns of the same names do not clash.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import table

#: Common function words of the four languages (ordinary word lists).
STOP_WORDS = (
    "the of and to in is that for it was on are as with at by this from be or an not but they he she we you "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an aus er hat "
    "le la les de des du et en un une que qui dans pour par sur est au aux ce il elle pas avec "
    "el los las del y por con para se su al lo como no una"
).split()

_GAP = r"[\x20\x09-\x0D]+"


class Threshold(NamedTuple):
    """``measure`` / ``per`` (if given) must lie within ``low`` and ``high``."""

    measure: str
    per: str | None
    low: float | None
    high: float | None


#: The production table.
THRESHOLDS = (
    Threshold("word_chars", "n_words", 1.5, 20.0),
    Threshold("n_symbols", "n_words", None, 0.1),
    Threshold("n_exclaims", "n_words", None, 0.25),
    Threshold("n_upper", "word_chars", None, 0.3),
    Threshold("n_stop_words", "n_words", 0.05, None),
    Threshold("n_dup_lines", "n_lines", None, 0.6),
    Threshold("n_repeat_words", "n_words", None, 0.25),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows found twice or more in the text."""
    n = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(found: Column) -> Column:
        windows = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def twice(ordered: Column) -> Column:
            same = lambda h, i: F.coalesce(F.get(ordered, i)["h"] == h, F.lit(False))
            shared = F.filter(ordered, lambda x, i: same(x["h"], i - 1) | same(x["h"], i + 1))
            first = F.transform(shared, lambda x: x["at"])
            second, third = F.transform(first, lambda at: at + 1), F.transform(first, lambda at: at + 2)
            return F.size(F.array_distinct(F.concat(first, second, third)))

        return let(windows, twice)

    def counted(found: Column) -> Column:
        # Most texts have no window twice; a hash set tells.
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(covered(found))

    return F.when(n < 3, 0).otherwise(let(hashes, counted))


def _left(text: Column, unwanted: str) -> Column:
    """Characters of a text outside a class."""
    return F.length(F.regexp_replace(text, unwanted, ""))


def measures(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Struct of all measures (long) of a text."""
    whole = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": _left(whole, r"[^#*$%&|<>]+"),
            "n_exclaims": _left(whole, r"[^!]+"),
            "n_upper": _left(whole, r"[^A-ZÀ-ÖØ-Þ]+"),
            "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(stop_words))),
            "n_repeat_words": _repeat_words(words),
        }
        lined = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
        return let(
            lined,
            lambda x: F.struct(
                *(c.cast("long").alias(n) for n, c in counts.items()),
                x["n"].cast("long").alias("n_lines"),
                (x["n"] - x["d"]).cast("long").alias("n_dup_lines"),
            ),
        )

    return let(F.array_remove(F.split(whole, _GAP), ""), of_words)


def base_failed(found: Column) -> Column:
    return (found["n_words"] < 50) | (100 * found["n_repeat_words"] > 50 * found["n_words"])


def verdict(found: Column, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """True where every threshold holds."""
    holds = F.lit(True)
    for rule in thresholds:
        value = found[rule.measure].cast("double")
        if rule.per is not None:
            value = F.coalesce(F.try_divide(value, found[rule.per]), F.lit(0.0))
        if rule.low is not None:
            holds = holds & (value >= rule.low)
        if rule.high is not None:
            holds = holds & (value <= rule.high)
    return holds


def judged(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """``docs`` with a struct ``rules`` of measures, ``base_failed`` and ``kept``."""

    def decide(found: Column) -> Column:
        failed = base_failed(found)
        return F.struct(
            *(found[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
            failed.alias("base_failed"),
            (~failed & verdict(found, thresholds)).alias("kept"),
        )

    return docs.withColumn("rules", let(measures(F.col("text")), decide))


def passes(text: Column, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """True for texts that pass the base rule and every threshold."""
    return let(measures(text), lambda found: ~base_failed(found) & verdict(found, thresholds))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the production table."""
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "rules.*")


def _sql_bound(rule: Threshold) -> str:
    value = f"coalesce({rule.measure}::DOUBLE / nullif({rule.per}, 0), 0)" if rule.per else f"{rule.measure}::DOUBLE"
    bounds = [f"{value} >= {rule.low}"] * (rule.low is not None) + [f"{value} <= {rule.high}"] * (rule.high is not None)
    return " AND ".join(bounds)


OP3_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM texts),
windows AS (
    SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows),
repeated AS (
    SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY rid),
measured AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           length(regexp_replace(text, '[^!]+', '', 'g')) AS n_exclaims,
           length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]+', '', 'g')) AS n_upper,
           len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS n_stop_words,
           len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM split LEFT JOIN repeated USING (rid)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(_sql_bound(x) for x in THRESHOLDS)} AS kept
FROM based
"""
