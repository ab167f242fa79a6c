"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

**Order and names.** Turns are sorted once by range; running counts and sums
inside a conversation are taken in each range and carried over the borders (one
row per partition), so a conversation of any length is spread over tasks. A
prefix is named by two sums, modulo 2^60, of hashes of (place, role, text): the
name of every prefix comes from one running sum instead of one join per depth.
Two different prefixes get one name with a chance near 2^-120.

**Contraction** (``subtree_totals``). A round first rakes: leaves leave the tree
and their totals, summed before the shuffle, go to their parents. Then it
compresses: where a node and its only child both have one child, a coin (a hash
of node and round) picks links no two of which touch; the lower node's sum moves
into the upper one, and the lower node is put aside with a pointer to the node
below it. Chains of any length thus vanish in a logarithmic number of rounds.
**Expansion**: the nodes put aside point to a node that was raked or put aside
later; pointers are doubled until all end at raked nodes, whose totals are known.

Defined results: rows without ``conv_id`` belong to no conversation. Turns are
ordered by turn (null first), ties by role, then text; null role or text is
empty; repeated rows are turns of their own. An empty table has no nodes, not
even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, crc_bucket, stored, table
from locusframe.session import discard

#: Names are sums modulo 2^60: two of them add up within 64 bits.
NAME_MASK = (1 << 60) - 1

#: Conversations whose ids share this quotient are listed in one row.
LISTED_IDS = 4096

#: A conversation takes its first turns from that of the next lower id that is
#: divisible by ``FAMILY``: the remainder of the CRC-32 of its id by ``HEADS``.
FAMILY, HEADS = 20, 4

_SUM_ROWS = 50_000


def _local_sums(names: list[str]):
    """Adds ``<name>_sum``: running sums within ``conv_id`` in sorted batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, [np.uint64(0)] * len(names)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            group = batch.column("conv_id").to_numpy()
            new = np.ones(n, dtype=bool)
            new[1:] = group[1:] != group[:-1]
            new[0] = last is None or group[0] != last
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            goes_on = np.cumsum(new) == 0
            columns = []
            for k, name in enumerate(names):
                value = batch.column(name).to_numpy().astype(np.uint64)
                total = np.cumsum(value, dtype=np.uint64)
                total = total - (total[begin] - value[begin])
                total[goes_on] += carry[k]
                total &= np.uint64(NAME_MASK)
                carry[k] = total[-1]
                columns.append(pa.array(total.astype(np.int64)))
            last = group[-1]
            names_out = [*batch.schema.names, *[f"{x}_sum" for x in names]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names_out)

    return run


def running_sums(rows: DataFrame, order: list[Column], names: list[str], keep: list[str], label: str) -> DataFrame:
    """Stored ``conv_id`` and ``keep`` of ``rows`` with running sums (modulo 2^60)
    of the columns ``names`` within each conversation.

    Ranges of the sorted rows are summed side by side. Only the sums at the end
    of each range come to the driver, one row per partition; what a conversation
    carries over a border goes back as a join with that many rows.
    """
    spark = rows.sparkSession
    keys = [F.col("conv_id"), *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = ranged.select("conv_id", *dict.fromkeys([*keep, *names]), F.spark_partition_id().alias("part"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema], *[f"`{x}_sum` long" for x in names]])
    local = stored(arrow_stage(ranged, _local_sums(names), schema, _SUM_ROWS), label)
    ends = (
        local.groupBy("part")
        .agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), *[F.max_by(f"{x}_sum", F.struct("conv_id", "turns_sum")).alias(x) for x in names])
        .orderBy("part")
        .collect()
    )
    carried, before, held = [], None, [0] * len(names)
    for end in ends:
        held = held if end.first == before else [0] * len(names)
        if any(held):
            carried.append((end.part, end.first, *held))
        held = [(end[x] + (h if end.first == end.last else 0)) & NAME_MASK for x, h in zip(names, held, strict=True)]
        before = end.last
    if not carried:
        return local.drop("part")
    over = spark.createDataFrame(carried, "part int, conv_id long, " + ", ".join(f"`{x}_over` long" for x in names))
    return (
        local.join(F.broadcast(over), ["part", "conv_id"], "left")
        .withColumns({f"{x}_sum": (F.col(f"{x}_sum") + F.coalesce(f"{x}_over", F.lit(0))).bitwiseAND(F.lit(NAME_MASK)) for x in names})
        .drop("part", *[f"{x}_over" for x in names])
    )


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), hashes ``x1`` and ``x2`` of role and
    text, and ``words`` of the text, of every turn."""
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(1).cast("long").alias("turns")
    )
    turns = turns.withColumns(
        {
            "x1": F.xxhash64(F.lit(1), "role", "text"),
            "x2": F.xxhash64(F.lit(2), "role", "text"),
            "words": F.regexp_count("text", F.lit(r"[^ \t-\r]+")).cast("long"),
        }
    )
    found = running_sums(turns, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ["turns"], ["x1", "x2", "words"], "turns")
    return found.select("conv_id", (F.col("turns_sum") - 1).alias("place"), "x1", "x2", "words")


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from ordered turns: the first h turns are those of
    the family's first conversation, the rest are their own after their first h.

    Returns the turns and ``conv_id``, ``n_turns`` of every conversation,
    those without turns included. A head is given to ``FAMILY`` conversations at
    most, so no join multiplies more than that.
    """
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "conversations")
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    plan = (
        sizes.select("conv_id", "n", family.alias("head"), crc_bucket(F.col("conv_id"), HEADS).alias("h"))
        .join(sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("n_head")), "head", "left")
        .select("conv_id", "n", "head", "h", F.least("h", F.coalesce("n_head", F.lit(0))).cast("long").alias("given"))
    )
    plan = stored(plan.withColumn("n_turns", F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "heads")
    heads = turns.where(F.col("place") < HEADS - 1).withColumnRenamed("conv_id", "head")
    given = plan.where("given > 0").select("conv_id", "head", "given", "n_turns").join(heads, "head").where("place < given")
    own = turns.join(plan, "conv_id").where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("given"))
    columns = ["conv_id", "place", "x1", "x2", "words", "n_turns"]
    return given.select(*columns).unionByName(own.select(*columns)), plan.select("conv_id", "n_turns")


def trie_nodes(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored nodes and stored places where conversations end.

    Nodes: ``id``, ``parent`` (null for the root), ``depth``, ``conv_id`` (the
    smallest member), ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``words`` (of the last text). Ends: ``id``, ``conv_id``.
    """
    hashed = turns.withColumns({f"t{k}": F.xxhash64("place", f"x{k}").bitwiseAND(F.lit(NAME_MASK)) for k in (1, 2)}).withColumn("turns", F.lit(1).cast("long"))
    paths = running_sums(hashed, [F.col("place")], ["turns", "t1", "t2"], ["words", "n_turns"], "paths")
    before = {f"p{k}": F.pmod(F.col(f"t{k}_sum") - F.col(f"t{k}"), F.lit(NAME_MASK + 1)) for k in (1, 2)}
    paths = paths.withColumns(before).withColumnsRenamed({"t1_sum": "s1", "t2_sum": "s2", "turns_sum": "depth"})
    named = (
        paths.groupBy("s1", "s2", "depth")
        .agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    )
    zero = F.lit(0).cast("long")
    root = (
        sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
        .where("n_convs > 0")
        .select(zero.alias("s1"), zero.alias("s2"), zero.alias("depth"), "n_convs", "conv_id", zero.alias("words"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    )
    nodes = stored(named.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), (F.col("depth") + 1).alias("depth"))
    linked = stored(nodes.join(above, ["p1", "p2", "depth"], "left").select("id", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "words"), "linked")
    children = linked.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    tree = stored(linked.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie")
    last = paths.where("depth = n_turns").select("conv_id", "s1", "s2", "depth")
    silent = sizes.where("n_turns = 0").select("conv_id", zero.alias("s1"), zero.alias("s2"), zero.alias("depth"))
    ends = stored(last.unionByName(silent).join(nodes.select("id", "s1", "s2", "depth"), ["s1", "s2", "depth"]).select("id", "conv_id"), "ends")
    discard(nodes, linked)
    return tree, ends


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """``id`` and the sums of ``values`` (long) over each node's subtree.

    ``tree`` holds ``id``, ``parent`` (null for a root) and ``values``; several
    trees may lie in one table. See the module text for the rounds.
    """
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    state = stored(tree.select("id", "parent", *values).join(kids, "id", "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "tree")
    done, aside, turn = [], [], 0
    while not state.isEmpty():
        turn += 1
        done.append(state.where("kids = 0").select("id", *values))
        raked = stored(_rake(state, values), "raked")
        state = stored(_compress(raked, values, turn), "tree")
        aside.append(state.where("below is not null").select("id", "below", *values))
        state = state.where("below is null").select("id", "parent", *values, "kids")
        discard(raked)
    if not done:
        return tree.select("id", *values)
    totals = stored(reduce(DataFrame.unionByName, done), "raked-totals")
    parted = stored(reduce(DataFrame.unionByName, aside), "set-aside")
    return totals.unionByName(_expanded(parted, totals, values))


def _rake(state: DataFrame, values: list[str]) -> DataFrame:
    """The nodes with children, after their leaves have gone; ``only``: the
    child of a node that has just one left."""
    leaf = F.col("kids") == 0
    by_parent = (
        state.where("parent is not null")
        .groupBy(F.col("parent").alias("id"))
        .agg(
            F.count(F.when(~leaf, 1)).alias("rest"),
            F.min(F.when(~leaf, F.col("id"))).alias("only"),
            *[F.sum(F.when(leaf, F.col(x))).alias(f"{x}_up") for x in values],
        )
    )
    return state.where("kids > 0").join(by_parent, "id").select(
        "id", "parent", *[(F.col(x) + F.coalesce(f"{x}_up", F.lit(0))).alias(x) for x in values], F.col("rest").alias("kids"), F.when(F.col("rest") == 1, F.col("only")).alias("only")
    )


def _compress(raked: DataFrame, values: list[str], turn: int) -> DataFrame:
    """``raked`` with independent links of its chains cut out; a node that was
    put aside names the node ``below`` it."""
    coin = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2))
    chain = raked.where("kids = 1").withColumn("coin", coin)
    upper = chain.where("coin = 0").select(F.col("id").alias("upper"), F.col("only").alias("id"))
    cut = upper.join(chain.where("coin = 1").select("id", F.col("only").alias("below"), *values), "id")
    none = F.lit(None).cast("long")
    nothing = [F.lit(0).cast("long").alias(f"{x}_up") for x in values]
    changes = (
        cut.select(F.col("upper").alias("id"), none.alias("below"), none.alias("above"), *[F.col(x).alias(f"{x}_up") for x in values])
        .unionByName(cut.select("id", "below", none.alias("above"), *nothing))
        .unionByName(cut.select(F.col("below").alias("id"), none.alias("below"), F.col("upper").alias("above"), *nothing))
        .groupBy("id")
        .agg(F.max("below").alias("below"), F.max("above").alias("above"), *[F.sum(f"{x}_up").alias(f"{x}_up") for x in values])
    )
    return raked.join(changes, "id", "left").select(
        "id", F.coalesce("above", "parent").alias("parent"), *[(F.col(x) + F.coalesce(f"{x}_up", F.lit(0))).alias(x) for x in values], "kids", "below"
    )


def _expanded(parted: DataFrame, totals: DataFrame, values: list[str]) -> DataFrame:
    """Totals of the nodes put aside: each is its own sum and the total of the
    node its pointer ends at."""
    while True:
        lower = parted.select(F.col("id").alias("below"), F.col("below").alias("lower"), *[F.col(x).alias(f"{x}_down") for x in values])
        if parted.join(lower, "below", "left_semi").isEmpty():
            break
        doubled = parted.join(lower, "below", "left").select(
            "id", F.coalesce("lower", "below").alias("below"), *[(F.col(x) + F.coalesce(f"{x}_down", F.lit(0))).alias(x) for x in values]
        )
        parted = stored(doubled, "set-aside")
    ended = totals.select(F.col("id").alias("below"), *[F.col(x).alias(f"{x}_down") for x in values])
    return parted.join(ended, "below").select("id", *[(F.col(x) + F.col(f"{x}_down")).alias(x) for x in values])


def trie(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of ``trie_nodes`` with ``n_leaves`` and ``saved_tokens`` of their
    subtrees, and the ends of the conversations."""
    tree, ends = trie_nodes(turns, sizes)
    one = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    totals = subtree_totals(tree.withColumns({"n_leaves": one, "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), ["n_leaves", "saved_tokens"])
    return tree.join(totals, "id"), ends


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of each node, whose rows follow one another."""
    node, digest = None, None
    for batch in batches:
        out = []
        for key, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], names=["id", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=["id", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``id`` and ``ends_sha256`` of the nodes at which conversations end.

    Ids are listed in rows of at most ``LISTED_IDS`` before they meet; a node's
    rows then stream through one digest in order and are never held together.
    """
    lists = (
        ends.groupBy("id", F.floor(F.col("conv_id") / F.lit(LISTED_IDS)).alias("bucket"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("id", "bucket", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )
    return arrow_stage(lists.repartition("id").sortWithinPartitions("id", "bucket"), _digests, "id long, ends_sha256 string")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the conversations rebuilt on their families' first turns."""
    turns, sizes = with_shared_heads(ordered_turns(table(spark, sf_dir, "conversations")))
    nodes, ends = trie(turns, sizes)
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(end_digests(ends), "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256")
    )


#: CRC-32 bit by bit: 3988292384 is its reversed polynomial.
_CRC_SQL = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: ord((conv_id::VARCHAR)[i])::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

OP13_SQL = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS head, {_CRC_SQL} % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.head AND t.place < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.h
), whole AS (
  SELECT c.conv_id, coalesce(s.turns, []) AS turns
  FROM c LEFT JOIN (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY own, place) AS turns FROM r GROUP BY conv_id
  ) s ON c.conv_id = s.conv_id
), p AS (
  SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM whole
), node AS (
  SELECT turns[1 : depth] AS path, depth, count(*) AS n_convs, min(conv_id) AS conv_id,
         string_agg(CASE WHEN len(turns) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM p GROUP BY 1, 2
), kids AS (
  SELECT path[1 : depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1
), weighed AS (
  SELECT node.*, coalesce(kids.n_children, 0) AS n_children,
         CASE WHEN node.depth = 0 THEN 0
              ELSE (n_convs - 1) * len(regexp_extract_all(node.path[node.depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM node LEFT JOIN kids ON node.path = kids.path
), up AS (
  SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS d FROM weighed
), total AS (
  SELECT path[1 : d] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM up GROUP BY 1
)
SELECT w.conv_id::BIGINT AS conv_id, w.depth::BIGINT AS depth, top.conv_id::BIGINT AS parent_conv_id, w.n_convs::BIGINT AS n_convs,
       w.n_children::BIGINT AS n_children, total.n_leaves::BIGINT AS n_leaves, total.saved_tokens,
       sha256(coalesce(w.ends, '')) AS ends_sha256
FROM weighed w JOIN total ON w.path = total.path
LEFT JOIN node top ON w.depth > 0 AND top.depth = w.depth - 1 AND top.path = w.path[1 : w.depth - 1]
"""
