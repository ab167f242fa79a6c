"""Registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from locusframe.llm import (
    byte_bpe,
    cover_tree,
    decontaminate,
    hard_negatives,
    lattice_score,
    ngram_join,
    packing,
    prefix_trie,
    quality_rules,
    token_files,
    toxicity,
    url_filter,
    warc,
)

QUERIES = {
    "op1_warc_index": warc.op1_warc_index,
    "op2_lattice_score": lattice_score.op2_lattice_score,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_cover_tree": cover_tree.op5_cover_tree,
    "op6_token_files": token_files.op6_token_files,
    "op7_packing": packing.op7_packing,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op11_decontaminate": decontaminate.op11_decontaminate,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLE = {
    "op3_quality_rules": quality_rules.OP3_SQL,
    "op4_url_filter": url_filter.OP4_SQL,
    "op5_cover_tree": cover_tree.OP5_SQL,
    "op11_decontaminate": decontaminate.OP11_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
