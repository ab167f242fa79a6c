"""A filtering pipeline over ``documents``: toxicity, quality, copies, packing.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import crc_bucket, stored, table
from locusframe.llm.ngram_join import classes
from locusframe.llm.packing import pack_documents
from locusframe.llm.quality_rules import passes
from locusframe.llm.toxicity import toxicity

#: Near copies: shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; every fifth id's label is not learned."""
    labels = table(spark, sf_dir, "labels").where(crc_bucket(F.col("doc_id"), 5) != 0)
    names = f"score {uuid.uuid4().hex}", f"predicted {uuid.uuid4().hex}"
    return toxicity(docs, labels, *names).where(F.col(f"`{names[1]}`") == 0).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return docs.where(passes(F.col("text")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies; null ids stay."""
    found = classes(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    heads = found.where("doc_id = component_id").select("doc_id")
    kept = docs.join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).union(docs.where("doc_id is null"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 byte-level ids, one row per piece."""
    return pack_documents(docs, "byte_bpe_50k.json", end_id=0, keep_ids=False).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", drop_copies),
    ("packing", pack),
]

#: Not expressible: the first stage learns a model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
