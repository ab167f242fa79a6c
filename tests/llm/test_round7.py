"""Toxicity: tokens learned by batch, feature counts and arcs of the lattice."""

from __future__ import annotations

import random

import numpy as np

from locusframe.llm import toxicity

ODD = (
    "word word, (word) word!! _word_ w_rd wooord wooord. glass glass$$$ a | $ !!! x2 91.23 débile ΑΣ. İab st.upid "
    "st upid id iot thes,!! naïve… 中"
).encode()


def texts_of(n: int) -> list[list[bytes]]:
    rng = random.Random(5)
    tokens = ODD.lower().split() + [b"\xff\xfe", b"ab\xc3", b"\xc3."]
    return [[rng.choice(tokens) for _ in range(rng.randrange(30))] for _ in range(n)]


def counted(seed: int = 3) -> toxicity.CharModel:
    return toxicity.CharModel.counted(np.random.RandomState(seed).randint(0, 50, toxicity.CLASSES**3))


def test_weights_by_number_are_those_of_single_tokens():
    weights = {"word": 2.0, "glas": 1.0, "glas-": 1.5, "stupid": 3.0, "débi-": 2.5}
    known = {"word": -3.0, "stupid": -4.0, "as": -2.0}
    weight_of = toxicity._Weights(counted(), weights, known)
    weight_of.measured(texts_of(60))
    assert len(weight_of.by_number) == len(weight_of.lexicon) > 20
    for token, value in zip(weight_of.lexicon.raw, weight_of.by_number, strict=True):
        found = toxicity.token_features(token, weight_of.chars, weight_of.lexicon.restored)
        assert value == max([0.0, *(weights.get(x, 0.0) for x in found)]), token


def test_plain_tokens_are_not_decoded_one_by_one(monkeypatch):
    """Most tokens are letters with edge signs; these are learned together."""
    slow = []
    signed, value = toxicity.Lexicon._signed, toxicity._Weights.value
    monkeypatch.setattr(toxicity.Lexicon, "_signed", lambda self, token: slow.append(token) or signed(self, token))
    monkeypatch.setattr(toxicity._Weights, "value", lambda self, token: slow.append(token) or value(self, token))
    weight_of = toxicity._Weights(counted(), {"word": 2.0, "stupid": 3.0}, {})
    # One token a text: nothing to put together.
    weight_of.measured([[x.encode()] for x in ("word", "word,", "[word", "glass.", "débile,", "word$$$")])
    assert slow == []
    weight_of.measured([[b"w0rd"], [b"wooord,"]])
    assert set(slow) == {b"w0rd", b"wooord,"}


def test_feature_counts_count_each_text_once():
    chars = counted()
    counts = toxicity.FeatureCounts(chars)
    lexicon = toxicity.Lexicon(chars)
    expected: list[dict[str, int]] = [{}, {}]
    for low, texts in enumerate((texts_of(40), [[]], [], texts_of(7))):
        marks = [(k + low) % 2 for k in range(len(texts))]
        counts.add(texts, marks)
        for mark, words in zip(marks, lexicon.words_of(texts), strict=True):
            for name in {x for t in set(words) for x in toxicity.token_features(t, chars, {})} | {""}:
                expected[mark][name] = expected[mark].get(name, 0) + 1
    for kind in (0, 1):
        assert {x: n for x, n in zip(counts.names, counts.counts[kind].tolist(), strict=True) if n} == expected[kind]


def test_arcs_end_where_no_known_word_goes_on(monkeypatch):
    """A row of a table is one run; of each core only those beginnings are
    looked up that a known word has."""
    looked = []

    class Known(dict):
        def get(self, word, default=None):
            looked.append(word)
            return super().get(word, default)

    known = Known({"stupid": -2.0, "extraordinarily": -9.0})
    cores = ["some", "|", "st", "up", "id", "|", "cells", "|", "more", "|", "extra", "words"]
    joined = counted().joined(cores, [0] * 11, known, sorted(known))
    assert [2, 3, 4] in joined
    assert "stupid" in looked and "some|" not in looked and "extrawords" in looked
    assert sum(map(len, joined)) == len(cores)
    assert len(looked) < 3 * len(cores)
