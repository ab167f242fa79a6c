"""Decontamination, hard negatives and the conversation trie beside brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import decontaminate, hard_negatives, prefix_trie
from tests.llm.helpers import awkward_rows, docs, prose

# -- benchmark decontamination -------------------------------------------------


def plain_words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        for s in range(max(len(words) - window, 0) + 1 if words else 0):
            windows[tuple(words[s : s + window])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words, hit, found = plain_words(text), set(), set()
        for n in sizes:
            for s in range(len(words) - n + 1):
                if (items_of := windows.get(tuple(words[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    found |= items_of
        out.append((doc_id, len(words), len(hit), tuple(sorted(found))))
    return Counter(out)


def bench_rows():
    one = prose(50, 30)
    return [
        (0, one), (1, prose(51, 10)), (2, "Short, ITEM"), (3, None), (4, ""), (5, " ,. "), (None, prose(52, 14)),
        (10, prose(53, 25)), (10, prose(54, 12)), (6, one), (7, "Ünï côdé"), (8, "word"), (9, "of the " * 12),
    ]


def doc_rows():
    bench = [t for _, t in bench_rows()]
    return [(i, t, e) for i, t, e in awkward_rows()] + [
        (100, f"{prose(1, 40)} {bench[0].upper().replace(' ', ', ')} {prose(2, 9)}", "x"),
        (101, " ".join(bench[0].split()[4:13]), "x"),
        (102, " ".join(bench[0].split()[4:15]), "x"),
        (103, f"{bench[1]} {bench[1]} a short--item", "x"),
        (104, bench[6], "x"), (105, "ünï côdé", "x"), (105, "Ünï CôDé!", "x"),
        (106, "of the " * 4000, "x"), (107, "word", "x"), (108, "short", "x"),
        (100, f"{prose(9, 3)} {bench[7]}", "x"), (None, bench[8], "x"), (None, bench[8], "x"),
    ]


@pytest.mark.parametrize("block, keys", [(200_000, 2_000_000), (20, 2_000_000), (200_000, 1)])
def test_decontamination_beside_brute_force(spark, block, keys):
    bench = spark.createDataFrame([(i, t, 3) for i, t in bench_rows()], "item_id long, text string, doc_id int")
    found = decontaminate.hits(docs(spark, doc_rows()), bench, block_windows=block, broadcast_keys=keys).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found)
    assert got == brute_hits([(i, t) for i, t, _ in doc_rows()], bench_rows())
    row = next(r for r in found if r.doc_id == 102)
    assert row.n_hit == 11 and [tuple(x) for x in row.spans] == [(0, 10), (1, 11)]


def test_decontamination_beside_sql_and_empty_tables(spark):
    frame = docs(spark, [r for r in doc_rows() if r[0] != 106])
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    connection = duckdb.connect()
    connection.register("documents", frame.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    connection.register("benchmark", bench.toPandas().astype({"item_id": "Int64"}))
    sql = connection.execute(decontaminate.OP11_SQL).fetchall()
    found = decontaminate.hits(frame, bench).collect()
    want = Counter((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in found)
    assert Counter(sql) == want
    assert decontaminate.hits(docs(spark, []), bench).count() == 0
    clean = decontaminate.hits(frame, bench.limit(0)).collect()
    assert len(clean) == frame.count() and not any(r.n_hit or r["items"] for r in clean)


def test_decontamination_stays_in_the_jvm(spark):
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    windows, _ = decontaminate.item_windows(bench)
    chosen, lengths = decontaminate.prefixes(docs(spark), windows, 3)
    plan = decontaminate.occurrences(docs(spark), chosen, lengths)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# -- hard negatives ------------------------------------------------------------


def brute_negatives(rows, every=100, percent=80):
    seen, part = set(), []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        row = vec_id, tuple(int(np.floor(np.float64(np.float32(x)) * 256)) for x in vector), label
        if row not in seen:
            seen.add(row)
            part.append(row)
    out = set()
    for a, v, label in part:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), b, other) for b, w, other in part if len(w) == len(v)]
        positives = sorted((s, b) for s, b, other in scored if other == label and b != a)[:5]
        for ps, p in positives:
            ok = sorted((s, b) for s, b, other in scored if other != label and 80 * -ps <= 100 * -s <= 100 * -ps)[:5]
            out |= {(a, p, k + 1, b, -ps, -s) for k, (s, b) in enumerate(ok)}
    return out


def vector_rows(n=260, size=6, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.4, 0.4) for _ in range(size)], rng.randrange(3)) for i in range(n)]
    rows += [(300 + i, rows[0][1], 1 + i % 2) for i in range(60)]
    rows += [rows[5], rows[100], rows[100], (100, rows[7][1], 2), (400, [1.0, 2.0], 0), (401, [1.0, 2.5], 0), (402, [1.0, 2.2], 1)]
    rows += [(500, None, 1), (None, rows[1][1], 1), (501, rows[1][1], None), (600, [0.1, float("nan")] * 3, 0)]
    rows += [(700, [0.1, None] * 3, 0), (800, [float("inf")] * 6, 0), (900, [], 0), (901, [], 0), (902, [], 1), (1000, [0.0] * 6, 0)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block", [16_384, 2])
def test_hard_negatives_beside_brute_force(spark, block):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("anchor", F.lit("x")).repartition(7)
    found = hard_negatives.hard_negatives(frame, block_anchors=block)
    got = [tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert set(got) == brute_negatives(rows) and any(r[0] == 400 for r in got) and any(r[0] == 900 for r in got)


def test_hard_negatives_empty_and_large_values(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(0, [3e6, 2e6], 0), (1, [3e6, 1.9e6], 0), (2, [2.9e6, 1.9e6], 1), (3, [3e6, -2e6], 1), (4, [3e6, 1.8e6], 1)]
    got = {tuple(r) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute_negatives(rows) and got
    top = [(0, [3e30], 0), (1, [3e30], 0), (2, [3e30], 1)]
    assert [r.negative_id for r in hard_negatives.hard_negatives(spark.createDataFrame(top, SCHEMA)).collect()] == [2]


# -- conversation trie ---------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = original.get(c - c % 20, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        cost = (len(m) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += p not in children
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(rebuilt[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def conversation_rows():
    rng = random.Random(11)
    said = [f"{prose(i, 4)}  x\n" for i in range(5)] + ["", None]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(said)) for c in range(150) for t in range(rng.randint(1, 5))]
    rows += [(7, None, "user", "null turn"), (7, None, "user", "another"), (8, 0, "b", "tie"), (8, 0, "a", "tie"), (None, 0, "user", "no id")]
    rows += [(1000 + c, 0, "user", "hello") for c in range(40)]
    rows += [(9000 + c, t, "user", f"turn {t}") for c in (0, 1) for t in range(90)]
    rows += [(40, 1, "user", "same"), (40, 1, "user", "same"), (12345, 0, "user", "no head")]
    return rows


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def op13_rows(frame):
    turns, sizes = prefix_trie.with_shared_heads(prefix_trie.ordered_turns(frame))
    nodes, ends = prefix_trie.trie(turns, sizes)
    nobody = hashlib.sha256(b"").hexdigest()
    found = nodes.join(prefix_trie.end_digests(ends), "id", "left").collect()
    return Counter(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or nobody) for r in found
    )


def test_trie_beside_brute_force_and_sql(spark):
    rows = conversation_rows()
    frame = spark.createDataFrame(rows, CONVERSATIONS).withColumn("id", F.lit(1)).withColumn("depth", F.lit("x")).repartition(5)
    want = brute_trie(rows)
    assert op13_rows(frame) == want
    connection = duckdb.connect()
    connection.register("conversations", frame.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert Counter(connection.execute(prefix_trie.OP13_SQL).fetchall()) == want
    assert op13_rows(spark.createDataFrame([], CONVERSATIONS)) == Counter()
    # Turns of two conversations only, and one whose turns are all replaced.
    few = [(20, 0, "user", "a b"), (21, 0, "user", "c")]
    assert op13_rows(spark.createDataFrame(few, CONVERSATIONS)) == brute_trie(few)


def test_running_sums_cross_partitions(spark):
    rows = [(c, i, (c * 7919 + i * 104729) << 20) for c, n in ((1, 2), (2, 400), (3, 1), (4, 130)) for i in range(n)]
    frame = spark.createDataFrame(rows, "conv_id long, i long, x long").withColumn("turns", F.lit(1).cast("long")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = prefix_trie.running_sums(frame, [F.col("i")], ["turns", "x"], ["i"], "sums")
        found = out.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = defaultdict(int)
    want = set()
    for c, i, x in sorted(rows):
        total[c] += x
        want.add((c, i, i + 1, total[c] & prefix_trie.NAME_MASK))
    assert {(r.conv_id, r.i, r.turns_sum, r.x_sum) for r in found} == want


def brute_totals(parents, value):
    total = dict(value)
    for node in value:
        up = parents[node]
        while up is not None:
            total[up] += value[node]
            up = parents[up]
    return total


def test_tree_contraction(spark):
    """A chain, a star, a caterpillar, a random tree and small trees, as one
    forest."""
    rng = random.Random(5)
    shapes = [
        lambda i: i - 1,
        lambda i: 0,
        lambda i: i - 2 if i > 2 and i % 2 else max(i - 1 - (i % 2 == 0 and i > 2), 0),
        lambda i: rng.randrange(i),
        lambda i: None if i % 30 == 0 else i - 1 - rng.randrange(min(2, i % 30)),
    ]
    parents = {}
    for k, shape in enumerate(shapes):
        for i in range(90):
            up = shape(i) if i else None
            parents[1000 * k + i] = None if up is None else 1000 * k + up
    value = {i: rng.randrange(9) for i in parents}
    tree = spark.createDataFrame([(i, parents[i], value[i], 1) for i in parents], "id long, parent long, v long, one long")
    got = {r.id: (r.v, r.one) for r in prefix_trie.subtree_totals(tree, ["v", "one"]).collect()}
    sums, counts = brute_totals(parents, value), brute_totals(parents, dict.fromkeys(parents, 1))
    assert got == {i: (sums[i], counts[i]) for i in parents}
