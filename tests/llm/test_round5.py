from __future__ import annotations

import random

import numpy as np
import pytest

from locusframe.llm import token_files, tokens
from locusframe.llm.common import tokenizer_path


@pytest.mark.parametrize("name, lower", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_chunks_of_letters_equal_the_library(name, lower):
    from tokenizers import Tokenizer

    library, encode, rng = Tokenizer.from_file(tokenizer_path(name)), tokens.library_encoder(name, lower), random.Random(3)
    for size in range(1, 40):
        word = "".join(rng.choice("etaoinshrdluETAOI") for _ in range(size))
        for chunk in (word, " " + word, word + "é", "\n" + word, word + "'s"):
            assert encode(chunk.encode()) == tokens.packed(library.encode(chunk, add_special_tokens=False).ids)


def _expanded(grammar):
    flat, start, size = token_files._expansions(grammar.first, grammar.rules, grammar.lengths)
    return np.concatenate([flat[start[s] : start[s] + size[s]] for s in grammar.symbols])


@pytest.mark.parametrize("first, max_rules", [(50, 400), (50, 70_000), (65_536, 65_536), (65_530, 6)])
def test_grammar_gives_the_ids_back(first, max_rules):
    """Pairs of 32 and of 64 bits, runs of one symbol, ends side by side."""
    ids = np.random.default_rng(2).zipf(1.4, 20_000).clip(1, 50).astype(np.uint32) - 1
    ids[3000:3500], ids[9000:9003] = 7, 1
    grammar = token_files.compress(ids, first, 1, max_rules)
    assert len(grammar.rules) <= max_rules and len(grammar.symbols) < len(ids)
    assert (_expanded(grammar) == ids).all()
    # The end id stays a symbol of its own.
    assert np.count_nonzero(grammar.symbols == 1) == np.count_nonzero(ids == 1)


def test_late_rounds_count_few_pairs(monkeypatch):
    """Only pairs that were frequent or hold a new symbol are counted again."""
    ids = np.random.default_rng(4).zipf(1.3, 400_000).clip(1, 5_000).astype(np.uint32)
    counted, found = [], token_files._frequent_pairs

    def watched(pairs, *rest):
        counted.append(len(pairs))
        return found(pairs, *rest)

    monkeypatch.setattr(token_files, "_frequent_pairs", watched)
    grammar = token_files.compress(ids, 5_001, 0, 60_000)
    assert len(counted) > 3 and counted[-1] < len(grammar.symbols) / 2
    # No pair was overlooked: no pair of neighbours is left 16 times.
    pairs, n = np.unique(grammar.symbols[:-1].astype(np.uint64) << np.uint64(32) | grammar.symbols[1:], return_counts=True)
    apart = (pairs >> np.uint64(32) != pairs & np.uint64(0xFFFFFFFF)) & (n >= 16)
    assert not apart.any()
