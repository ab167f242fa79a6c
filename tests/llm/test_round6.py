from __future__ import annotations

import random

import numpy as np

from locusframe.llm import ngram_join, tokens, toxicity
from tests.llm.helpers import docs, prose
from tests.llm.test_documents import brute_classes


def test_new_words_with_signs_take_one_place():
    """A word seen for the first time with signs after it is kept without them."""
    encoded = []
    memory = tokens.ChunkMemory(lambda key: encoded.append(key) or tokens.packed(list(key)))
    words = [b"word%d" % i + b"abc" for i in range(1000)]
    for _ in range(3):
        for word in words:
            assert memory.pack([word + b","]) == tokens.packed(list(word + b","))
        if len(encoded) == 1001:
            assert len(memory) in (1001, 2001)
    assert len(encoded) == 1001 and len(memory) == 2001
    fresh = tokens.ChunkMemory(lambda key: tokens.packed(list(key)))
    fresh.pack([word + b"." for word in words])
    assert len(fresh) == 1001


def test_parity_bits_never_differ_more_than_the_sets():
    rng = np.random.default_rng(1)
    for size in (1, 2, 63, 64, 65, 500, 1025):
        for away in (0, 1, 3, size // 9, size // 3):
            pool = rng.integers(0, 2**63, size + away, dtype=np.uint64)
            x, y = pool[:size], pool[away:]
            bits = [ngram_join.parity_bits(t) for t in (x, y)]
            args = [v for b in bits for v in (int.from_bytes(b, "little"), 8 * len(b))]
            true = len(np.setxor1d(x, y))
            assert ngram_join.bits_apart(*args) <= true
            if size == 500 and away > 100:
                assert ngram_join.bits_apart(*args) > true / 2


def test_texts_of_documents_that_differ_too_much_stay(spark, monkeypatch):
    """Texts in blocks that share rare passages but are not similar are not moved."""
    rows = []
    for i in range(30):
        words = prose(500 + i // 2, 200).split()
        words[60 * (i % 2) : 60 * (i % 2) + 50] = prose(600 + i, 50).split()
        rows.append((i, " ".join(words), "x"))
    moved, packed = [], ngram_join.packed_texts

    def watched(some):
        moved.append(some.select("doc_id").distinct().count())
        return packed(some)

    monkeypatch.setattr(ngram_join, "packed_texts", watched)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(docs(spark, rows), 3, 90).collect()}
    assert got == brute_classes(rows, 3, 90)
    # The first call is that of the stars.
    assert sum(moved[1:]) == 0


def test_many_near_copies_and_pairs_just_below(spark):
    """Groups whose members are linked by some pairs only: the pairs verified
    second connect what the closest ones do not."""
    rng, rows = random.Random(5), []
    for group in range(4):
        base = prose(700 + group, 100).split()
        for i in range(25):
            words = list(base)
            for k in rng.sample(range(100), 1 + i % 4):
                words[k] = f"w{rng.random()}"
            rows.append((1000 * group + rng.randrange(1000), " ".join(words), "x"))
    rows = list({r[0]: r for r in rows}.values())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(docs(spark, rows), 3, 90).collect()}
    assert got == brute_classes(rows, 3, 90)


def test_second_round_verifies_what_the_first_left(spark):
    """The pair of least bits apart is no link; another between the same two
    components is."""
    base = prose(800, 100).split()
    far = prose(801, 100).split()
    near = [*base[:-1], "changed"]
    rows = [(1, " ".join(base), "x"), (2, " ".join(far), "x"), (3, " ".join(near), "x")]
    frame = docs(spark, rows).selectExpr("doc_id", "cast(text as binary) text").cache()
    frequent = spark.sparkContext.broadcast(np.empty(0, np.uint64))
    pairs = spark.createDataFrame(
        [(1, 2, 1, 2, 3), (1, 3, 1, 2, 7)], "a long, b long, a_root long, b_root long, apart long"
    )
    found = ngram_join.linked(pairs, frame, 3, 90, frequent).collect()
    assert [(r.a, r.b) for r in found] == [(1, 3)]


def test_frequent_tokens_are_kept_when_others_are_forgotten():
    """Numbers start anew with the tokens read more than once; what a text
    measures stays the same."""
    model = toxicity.CharModel.counted(np.ones(toxicity.CLASSES**3, np.int64))
    weights = {"nasty": 2.0, "w7": 1.0, "stupid": 3.0}
    small, large = (toxicity._Weights(model, weights, {"stupid": -3.0}, limit) for limit in (50, 10**6))
    small.lexicon.limit = 50
    common = b"nasty words st upid n@sty aagain, common".split()
    for k in range(20):
        texts = [common + [b"w%d" % (40 * k + i) for i in range(40)], common[::-1]]
        assert small.measured(texts) == large.measured(texts)
        assert len(small.by_number) == len(small.lexicon) == len(small.lexicon.raw)
    learned = []
    small.value = lambda token: learned.append(token) or 0.0
    kept = small.lexicon.raw[:]
    small.measured([common])
    assert not set(common) & {x for x in learned if x in small.lexicon}
    assert set(common) <= set(kept)
