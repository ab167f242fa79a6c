"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import stored
from locusframe.session import discard

#: Rounds after which the search gives up with an error; each round at least
#: halves the longest way to a component's smallest id once labels spread.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of all nodes of
    ``links`` (``a``, ``b``); nodes without links do not appear.

    Every node takes the smallest root among its own and its neighbours', then
    the root of its root, until nothing changes. Each step is a join and a
    minimum, which is combined before the shuffle, so a node with very many
    links is no trouble; labels are stored in the shared folder after each.
    """
    edges = links.select("a", "b").where("a <> b")
    edges = stored(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    for _ in range(MAX_ROUNDS):
        reached = (
            edges.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        spread = roots.select("node", "root").join(reached, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        spread = stored(spread, "roots")
        jumped = spread.join(spread.select(F.col("node").alias("root"), F.col("root").alias("top")), "root")
        following = stored(jumped.select("node", F.col("top").alias("root"), "old"), "roots")
        settled = following.where("root <> old").isEmpty()
        discard(roots, spread)
        roots = following
        if settled:
            discard(edges)
            return roots.select("node", "root")
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
