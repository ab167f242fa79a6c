"""Operator 4: allow and block rules in a trie, the longest match wins.

A rule is a host and a path. It fits a url of its host or a subdomain whose
path starts with the rule's. Rules are kept in a trie over reversed host
labels; at each host hangs a trie over path segments, whose last segment may
be a part of the url's. One walk per url finds the longest fitting rule.

The trie is broadcast: its size is the rule list's, which is checked against
``MAX_TRIE_BYTES``. A longer list is joined by host suffix instead.

Defined results: of fitting rules the one with most characters (host and path
together) wins, then the longer host, then block before allow; a url without
``://``, and a null one, has empty host and path, fits no rule and gets the
default verdict; rows, repeated or with null ids, are judged one by one; an
empty table gives no row; columns ``host``, ``path``, ``rule``, ``verdict`` of
the input are not used.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, table

#: Largest rule list, in characters, that is broadcast as a trie.
MAX_TRIE_BYTES = 16 * 1024 * 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: The production rules.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    parts = r"^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return (
        F.translate(F.regexp_extract(text, f"(?s){parts}", 1), _UPPER, _LOWER),
        F.regexp_extract(text, f"(?s){parts}", 2),
    )


def _better(rule: Rule, than: Rule | None) -> bool:
    rank = lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict == "block")
    return than is None or rank(rule) > rank(than)


class Trie:
    """Nested dictionaries: host labels from the last, then path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {"labels": {}}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")) if rule.host else ():
                node = node["labels"].setdefault(label, {"labels": {}})
            node = node.setdefault("path", {"segments": {}, "ends": {}})
            *segments, last = rule.path.split("/")
            for segment in segments:
                node = node["segments"].setdefault(segment, {"segments": {}, "ends": {}})
            if _better(rule, node["ends"].get(last)):
                node["ends"][last] = rule

    def match(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits."""
        best = None
        hosts = [self.root]
        for label in reversed(host.split(".")) if host else ():
            node = hosts[-1]["labels"].get(label)
            if node is None:
                break
            hosts.append(node)
        segments = path.split("/")
        for host_node in hosts:
            node = host_node.get("path")
            for segment in segments:
                if node is None:
                    break
                # A rule's last segment may be the start of this one.
                for length in range(len(segment) + 1) if len(segment) < len(node["ends"]) else ():
                    rule = node["ends"].get(segment[:length])
                    if rule is not None and _better(rule, best):
                        best = rule
                if len(segment) >= len(node["ends"]):
                    for last, rule in node["ends"].items():
                        if segment.startswith(last) and _better(rule, best):
                            best = rule
                node = node["segments"].get(segment)
        return best


def _by_trie(urls: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    # Plain rows travel; workers may lack this package. A task builds the trie.
    listed = urls.sparkSession.sparkContext.broadcast([tuple(r) for r in rules])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(Rule(*r) for r in listed.value)
        for batch in batches:
            pairs = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            # A url that names no host fits no rule, not even one for any host.
            found = [trie.match(h, p) if h or p else None for h, p in pairs]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([r and r.host + r.path for r in found], pa.string()),
                    pa.array([r.verdict if r else default for r in found], pa.string()),
                ],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    return arrow_stage(urls, run, "page_id long, host string, path string, rule string, verdict string", rows=10_000)


def _by_join(urls: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """The same for a list too long to broadcast: an equi-join on host suffixes."""
    listed = urls.sparkSession.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")
    keyed = urls.withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(0), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."),
    )
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("n"),
        F.length("rule_host").alias("h"),
        (F.col("rule_verdict") == "block").alias("b"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = (
        keyed.where((F.col("host") != "") | (F.col("path") != ""))
        .withColumn("rule_host", F.explode(F.array_distinct(suffixes)))
        .join(listed, "rule_host")
        .where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("row")
        .agg(F.max(rank).alias("best"))
    )
    return keyed.join(best, "row", "left").select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def filter_urls(
    pages: DataFrame, rules: Iterable[Rule], default: str = "allow", trie_bytes: int = MAX_TRIE_BYTES
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``."""
    rules = list(rules)
    host, path = host_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    small = sum(len(r.host) + len(r.path) for r in rules) <= trie_bytes
    return (_by_trie if small else _by_join)(urls, rules, default)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The url of every page under the production rules."""
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


_FITS = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
OP4_SQL = rf"""
WITH parsed AS (
    SELECT row_number() OVER () AS rid, page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages),
rules(h, p, v) AS (VALUES {_FITS}),
best AS (
    SELECT rid, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(v, length(h) + length(p)) AS verdict
    FROM parsed, rules
    WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN best USING (rid)
"""
