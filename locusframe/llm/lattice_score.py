"""Operator 2: marginal document probability over all subword segmentations.

The vocabulary of pieces exists beforehand. A word (with the mark of a word
start before it) is a lattice of its pieces; the forward recursion in log
space adds up all paths. A word of the learning texts is one more arc over the
whole lattice, weighted by its count; the paths of pieces share the
probability that Good and Turing leave for unseen words (words seen once, of
all tokens). Words are independent, so a text's log probability is the sum
over its words and its end.

A public vocabulary that holds only merge ranks is given scores first: the
pieces in its own segmentation of all distinct learning words are counted, and
(with ``PRIOR`` of each) shared out among pieces that start a word and, with
the stop after a word, among pieces that go on.

Defined results: a null text is empty and has only its end; A-Z count as
lower case; a null id belongs to the learning texts as the id '' would;
repeated rows are scored, and counted for learning, each; without a learning
text all counts are 0; an empty table gives no row; other columns are left
out. A character outside the vocabulary is spelled by its byte pieces.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import (
    arrow_stage,
    crc_bucket,
    stored,
    table,
    tokenizer_path,
    utf8_or_empty,
    worker_cache,
)

#: Most frequent words, at most so many, whose scores are broadcast; all other
#: words are joined. The least count of a broadcast word is read off a
#: histogram of counts.
COMMON_WORDS = 200_000
#: Added to each piece's count.
PRIOR = 0.1
#: Word counts a task holds before it sends them on.
HELD_WORDS = 300_000
_LN10 = math.log(10.0)
_MARK = "▁"


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes), ``c`` (in learning texts) and ``all`` over ``docs``
    (text as bytes, learn)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned: Counter = Counter()
        other: Counter = Counter()

        def flush():
            keys = list(learned.keys() | other.keys())
            columns = [keys, [learned[k] for k in keys], [other[k] for k in keys]]
            learned.clear(), other.clear()
            for low in range(0, len(keys), 50_000):
                part = [c[low : low + 50_000] for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.binary()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64())],
                    names=["word", "c", "other"],
                )

        for batch in batches:
            for text, learn in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (learned if learn else other).update(text.lower().split())
            if len(learned) + len(other) > HELD_WORDS:
                yield from flush()
        yield from flush()

    parts = arrow_stage(docs.select("text", "learn"), run, "word binary, c long, other long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("other").alias("other"))


def _processor(name: str):
    key = f"pieces {name}"
    cache = worker_cache(key)
    if key not in cache:
        import sentencepiece

        cache[key] = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
    return cache[key]


def piece_counts(words: DataFrame, vocabulary: str) -> DataFrame:
    """How often each piece id is found in the vocabulary's own segmentation
    of the distinct learning words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor, held = _processor(vocabulary), Counter()
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            for ids in processor.encode(texts, num_threads=1):
                held.update(ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], names=["piece", "n"]
        )

    found = arrow_stage(words.where("c > 0").select("word"), run, "piece long, n long", rows=10_000)
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


class Scores(NamedTuple):
    """Natural-log scores: pieces, the 256 byte pieces, the stop after a word."""

    pieces: dict[str, float]
    spelled: list[float]
    stop: float


def fitted_scores(words: DataFrame, vocabulary: str, n_words: int) -> Scores:
    """Scores from the ``n_words`` distinct learning words.

    Reads one count per piece to the driver: as many as the vocabulary has.
    """
    processor = _processor(vocabulary)
    counts = {row.piece: float(row.n) for row in piece_counts(words, vocabulary).collect()}
    starts, goes_on, spelled = {}, {}, [PRIOR] * 256
    for i in range(processor.get_piece_size()):
        piece, count = processor.id_to_piece(i), counts.get(i, 0.0) + PRIOR
        if processor.is_byte(i):
            spelled[int(piece[3:5], 16)] = count
        elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
            (starts if piece.startswith(_MARK) else goes_on)[piece] = count
    first, later = sum(starts.values()), sum(goes_on.values()) + sum(spelled) + n_words + PRIOR
    pieces = {p: math.log(c / first) for p, c in starts.items()} | {p: math.log(c / later) for p, c in goes_on.items()}
    return Scores(pieces, [math.log(c / later) for c in spelled], math.log((n_words + PRIOR) / later))


class Lattice:
    """Forward recursion over the pieces of a word."""

    def __init__(self, scores: Scores):
        pieces, self._spelled, self._stop = scores
        self._pieces = pieces
        self._longest = max(map(len, pieces), default=1)
        # Starts of pieces, so that the search from a place ends early.
        self._starts = {p[:k] for p in pieces for k in range(1, len(p) + 1)}

    def word(self, word: str) -> float:
        """Natural-log probability that pieces spell a word, in any way."""
        text = _MARK + word
        n = len(text)
        # Scaled forward sums: ways[i] * exp(shift[i]) is the probability of
        # the first i characters.
        best = [-math.inf] * (n + 1)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        best[0] = 0.0
        pieces, starts = self._pieces, self._starts
        for i in range(n):
            if i:
                terms = into[i]
                top = max(terms)
                best[i] = top if len(terms) == 1 else top + math.log(sum([math.exp(t - top) for t in terms]))
                into[i] = []
            here = best[i]
            spelled = here
            for b in text[i].encode("utf-8", "replace"):
                spelled += self._spelled[b]
            into[i + 1].append(spelled)
            for j in range(i + 1, min(n, i + self._longest) + 1):
                part = text[i:j]
                if part not in starts:
                    break
                score = pieces.get(part)
                if score is not None:
                    into[j].append(here + score)
        terms = into[n]
        top = max(terms)
        return top + math.log(sum([math.exp(t - top) for t in terms])) + self._stop


def common_count(words: DataFrame) -> int:
    """Least count such that at most ``COMMON_WORDS`` words reach it."""
    step = F.floor(F.log2(F.col("c") + F.col("other")) * 8)
    words_by_step = words.groupBy(step.alias("step")).count().collect()
    held, least = 0, None
    for row in sorted(words_by_step, key=lambda r: -r.step):
        held += row["count"]
        if held > COMMON_WORDS:
            break
        least = row.step
    return math.ceil(2.0 ** (least / 8)) if least is not None else 1 << 62


def word_scores(words: DataFrame, scores: Scores, tokens: int, unseen: float) -> DataFrame:
    """``words`` (word, c, other) with ``logp`` (natural), each word once.

    The broadcast scores are as many as the vocabulary has pieces.
    """
    # Broadcasts hold plain objects: workers may lack this package.
    model = words.sparkSession.sparkContext.broadcast(tuple(scores))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(Scores(*model.value))
        for batch in batches:
            found = []
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist(), strict=True):
                spelled = math.log(unseen) + lattice.word(word.decode("utf-8", "replace"))
                if c:
                    whole = math.log1p(-unseen) + math.log(c / tokens)
                    top = max(whole, spelled)
                    spelled = top + math.log(math.exp(whole - top) + math.exp(spelled - top))
                found.append(spelled)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "logp"]
            )

    return arrow_stage(words, run, "word binary, c long, other long, logp double", rows=10_000)


def score_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text, learn boolean): n_tokens, n_known,
    train_tokens, base_score (word counts) and score (lattice), log10."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", utf8_or_empty("text").alias("text"), "learn")
    n_texts = texts.where("learn").count()
    words = stored(word_counts(texts), "words")
    totals = words.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("once")).first()
    train_tokens = (totals.n or 0) + n_texts
    distinct = (totals.v or 0) + (1 if n_texts else 0)
    # Some room is left for unseen words even if none, or all, were seen once.
    unseen = ((totals.once or 0) + 0.5) / (train_tokens + 1)
    end_score = math.log1p(-unseen) + math.log((n_texts + PRIOR) / (train_tokens + PRIOR))
    scores = fitted_scores(words, vocabulary, totals.v or 0)
    scored = stored(
        word_scores(words, scores, train_tokens, unseen).select(
            "word",
            (F.col("c") > 0).cast("long").alias("known"),
            F.log10(F.col("c") + 1.0).alias("log_c"),
            (F.col("logp") / _LN10).alias("logp"),
            (F.col("c") + F.col("other") >= common_count(words)).alias("common"),
        ),
        "word-scores",
    )
    common = spark.sparkContext.broadcast(
        {bytes(r.word): (r.known, r.log_c, r.logp) for r in scored.where("common").toLocalIterator()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text with the sums over its common words, then rows of
        its other words."""
        get = common.value.get
        for batch in batches:
            facts = batch.column("row").to_pylist(), batch.column("text").to_pylist()
            sums: list[tuple] = []
            rare: list[tuple] = []
            for row_id, text in zip(*facts, strict=True):
                found = text.lower().split()
                known, log_c, logp = 0, 0.0, 0.0
                for word, n in Counter(found).items():
                    of_word = get(word)
                    if of_word is None:
                        rare.append((row_id, word, n))
                    else:
                        known += n * of_word[0]
                        log_c += n * of_word[1]
                        logp += n * of_word[2]
                sums.append((row_id, None, len(found), known, log_c, logp))
            columns = list(zip(*sums, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                + [batch.column("doc_id"), batch.column("learn")],
                names=names,
            )
            for low in range(0, len(rare), 50_000):
                part = list(zip(*rare[low : low + 50_000], strict=True))
                size = len(part[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(part, types, strict=False)]
                    + [pa.nulls(size, t) for t in (*types[3:], pa.int64(), pa.bool_())],
                    names=names,
                )

    types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    names = ["row", "word", "n", "known", "log_c", "logp", "doc_id", "learn"]
    keyed = texts.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", "learn"
    )
    schema = "row long, word binary, n long, known long, log_c double, logp double, doc_id long, learn boolean"
    parts = stored(arrow_stage(keyed, run, schema), "text-words")
    word = scored.where("not common").select(
        "word", F.col("known").alias("k"), F.col("log_c").alias("c"), F.col("logp").alias("p")
    )
    rare = (
        parts.where("word is not null")
        .select("row", "word", "n")
        .join(word, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.col("k")).alias("k"),
            F.sum(F.col("n") * F.col("c")).alias("c"),
            F.sum(F.col("n") * F.col("p")).alias("p"),
        )
    )
    end_known = 1 if n_texts else 0
    n_tokens = F.col("tokens") + 1
    texts_ = parts.where("word is null").withColumnRenamed("n", "tokens").drop("word").join(rare, "row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return texts_.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (plus("known", "k") + end_known).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (plus("log_c", "c") + math.log10(n_texts + 1) - n_tokens * math.log10(max(1, train_tokens + distinct + 1))).alias(
            "base_score"
        ),
        (plus("logp", "p") + end_score / _LN10).alias("score"),
    )


def op2_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; those whose remainder by 7 is 2 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("learn", crc_bucket(F.col("doc_id"), 7) != 2)
    return score_texts(docs, "piece_bpe_32k.model")
