"""Benchmark decontamination as a prefix-filtered set join.

An item's text is cut into windows of ``WINDOW_WORDS`` words; a document is
contaminated where a whole window occurs in it. A window is the set of its
shingles (``SHINGLE_WORDS`` words, hashed, with their places), and all of them
must be found, so any one of them is a necessary prefix. The filter:

1. **Rarity order.** One pass over all documents counts the windows' shingles.
   A window with a shingle that no document holds is dropped at once; of the
   others the rarest shingle is the prefix that is joined.
2. **Prefix join.** A second pass joins every place of every document with the
   prefixes. These are broadcast in blocks of at most ``BLOCK_WINDOWS``
   windows, one pass for each block, so that nothing that grows is broadcast.
3. **Bounds.** The place of the prefix within the window must leave the whole
   window inside the document (position and length).
4. **Verification.** The words of the document at that place are compared with
   the window's words, so equal hashes alone decide nothing.

Only DataFrame functions are used; documents are not shuffled, only one short
row for each and one for each verified occurrence.

Defined results: null or empty texts, of documents or items, have no words and
no windows; an item of fewer words than a window is one window. Items are told
apart by their id; a null id is one item, written as the empty string. Equal
document rows give equal results and are returned as often as they occur; rows
that share an id but not the text are judged apart. Without items every
document is clean, without documents the result is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import stored, table
from locusframe.session import discard

#: Words of a window and of a shingle; a shorter window has one shingle.
WINDOW_WORDS, SHINGLE_WORDS = 10, 3

#: Windows broadcast at a time (some 200 bytes each) and shingle keys (a long
#: each) up to which the counting pass broadcasts them.
BLOCK_WINDOWS, BROADCAST_KEYS = 200_000, 2_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: digits, small letters, and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """Words of a text whose A-Z are lower-cased; other letters stay."""
    known = F.coalesce(text, F.lit(""))
    plain = F.octet_length(known) == F.char_length(known)
    lowered = F.when(plain, F.lower(known)).otherwise(F.translate(known, _UPPER, _LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _key(words: str, place: str, length: int) -> Column:
    """Hash of the shingle of ``length`` words at ``place``."""
    return F.xxhash64(F.lit(length), *[F.get(words, F.col(place) + i) for i in range(length)])


def item_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """Stored distinct windows (``window_id``, ``w``) and the items that hold
    them (``window_id``, ``item``)."""
    cut = (
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), word_array(F.col("text")).alias("all"))
        .where("size(all) > 0")
        .select("item", "all", F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))).alias("start"))
        .select("item", F.slice("all", F.col("start") + 1, window).alias("w"))
    )
    held = stored(cut.distinct(), "item-windows")
    windows = stored(held.select("w").distinct().select(F.monotonically_increasing_id().alias("window_id"), "w"), "windows")
    items = stored(held.join(windows, "w").select("window_id", "item"), "window-items")
    discard(held)
    return windows, items


def _places(documents: DataFrame) -> DataFrame:
    """One row per word place of each document, and one at place -1."""
    return (
        documents.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"), word_array(F.col("text")).alias("words"))
        .withColumn("n_words", F.size("words"))
        .withColumn("place", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)))
    )


def _keyed(places: DataFrame, lengths: list[int]) -> DataFrame:
    """``key`` of the shingle of each length that starts at a place; null at
    place -1 and where the document ends before the shingle does."""
    whole = [F.when((F.col("place") >= 0) & (F.col("place") + n <= F.col("n_words")), _key("words", "place", n)) for n in lengths]
    if len(whole) == 1:
        return places.withColumn("key", whole[0])
    keys = F.when(F.col("place") < 0, F.array(F.lit(None).cast("long"))).otherwise(F.array(*whole))
    return places.withColumn("key", F.explode(keys))


def prefixes(documents: DataFrame, windows: DataFrame, shingle: int, broadcast_keys: int = BROADCAST_KEYS) -> tuple[DataFrame, list[int]]:
    """Stored windows that may occur (``window_id``, ``w``, ``key``, ``shift``:
    their rarest shingle and its place), and the lengths of shingles in use."""
    lengths = sorted(r.n for r in windows.select(F.least(F.size("w"), F.lit(shingle)).alias("n")).distinct().collect())
    if not lengths:
        return windows.select("*", F.lit(0).cast("long").alias("key"), F.lit(0).alias("shift")).limit(0), [shingle]
    placed = windows.withColumn("shift", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - shingle, F.lit(0)))))
    by_size = [F.when(F.least(F.size("w"), F.lit(shingle)) == n, _key("w", "shift", n)) for n in lengths]
    shingles = stored(placed.select("window_id", "shift", F.coalesce(*by_size).alias("key")), "shingles")
    keys = stored(shingles.select("key").distinct(), "shingle-keys")
    found = _keyed(_places(documents), lengths).where("key is not null").select("key")
    if keys.count() <= broadcast_keys:
        counts = found.join(F.broadcast(keys), "key", "left_semi").groupBy("key").count()
    else:
        counts = found.groupBy("key").count().join(keys, "key", "left_semi")
    rarest = (
        shingles.join(counts, "key", "left")
        .groupBy("window_id")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "key", "shift")).alias("first"))
        .where("first.count > 0")
        .select("window_id", "first.key", "first.shift")
    )
    chosen = stored(windows.join(rarest, "window_id"), "prefixes")
    discard(shingles, keys)
    return chosen, lengths


def occurrences(documents: DataFrame, chosen: DataFrame, lengths: list[int], block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Verified occurrences (``doc_id``, ``text_hash``, ``n_words``, ``start``,
    ``length``, ``window_id``), and a row without window for each document."""
    blocks = max(1, -(-chosen.count() // block_windows))
    keyed = _keyed(_places(documents), lengths)
    parts = []
    for block in range(blocks):
        side = chosen.where(F.pmod(F.xxhash64("window_id"), F.lit(blocks)) == block) if blocks > 1 else chosen
        side = side.withColumnRenamed("key", "prefix")
        start = F.col("place") - F.col("shift")
        inside = (start >= 0) & (start + F.size("w") <= F.col("n_words"))
        same = inside & (F.slice("words", start + 1, F.size("w")) == F.col("w"))
        kept = F.col("window_id").isNotNull() & same
        if block == 0:
            kept = (F.col("place") < 0) | kept
        parts.append(
            keyed.join(F.broadcast(side), F.col("key") == F.col("prefix"), "left" if block == 0 else "inner")
            .where(kept)
            .select("doc_id", "text_hash", "n_words", "window_id", start.alias("start"), F.size("w").alias("length"))
        )
    return reduce(DataFrame.unionAll, parts)


def _covered(spans: str) -> Column:
    """Words inside any of the spans (start, end)."""
    begin = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("upto"))
    step = lambda done, x: F.struct(
        (done["words"] + F.greatest(x["end"] - F.greatest(x["start"], done["upto"]), F.lit(0))).cast("long").alias("words"),
        F.greatest(x["end"], done["upto"]).alias("upto"),
    )
    return F.aggregate(F.array_sort(spans), begin, step, lambda done: done["words"])


def hits(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
    block_windows: int = BLOCK_WINDOWS,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``spans`` (the
    occurrences as word ranges, sorted) and ``items`` (ids as sorted strings)."""
    windows, held = item_windows(benchmark, window)
    chosen, lengths = prefixes(documents, windows, shingle, broadcast_keys)
    span = F.when(F.col("window_id").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end")))
    per_text = stored(
        occurrences(documents, chosen, lengths, block_windows)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count(F.when(F.col("window_id").isNull(), 1)).alias("copies"),
            F.array_sort(F.collect_set(span)).alias("spans"),
            F.collect_set("window_id").alias("windows"),
        )
        .withColumn("n_hit", _covered("spans")),
        "contaminated",
    )
    keys = ["doc_id", "text_hash"]
    items = (
        per_text.where("n_hit > 0")
        .select(*keys, F.explode("windows").alias("window_id"))
        .join(held, "window_id")
        .groupBy(*[F.col(k).alias(f"{k}_") for k in keys])
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    matched = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    return (
        per_text.join(items, matched, "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc_id", "n_words", "n_hit", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    )


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document, and a digest of the items found."""
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP11_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w
  FROM benchmark
), wins AS (
  SELECT DISTINCT item, w[s : s + {WINDOW_WORDS} - 1] AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS}, 0) + 2)) AS s FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(win) AS n FROM wins
), cut AS (
  SELECT rid, s, n, w[s : s + n - 1] AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN sizes ON len(w) >= n)
), occ AS (
  SELECT cut.rid, cut.s, cut.n, wins.item FROM cut JOIN wins ON cut.win = wins.win
), hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM occ))
  GROUP BY rid
), ids AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n_hit, 0)::BIGINT AS n_hit,
       coalesce(ids.n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids.items, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.rid = hit.rid LEFT JOIN ids ON d.rid = ids.rid
"""
