"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from arrivo.llm import (bpe, covertree, htmltext, mixing, quality, setjoin, sharding, simhash, tokencounts, toxicity,
                        vptree, warc, whitening)

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_warc": warc.op3_warc,
    "op4_token_counts": tokencounts.op4_token_counts,
    "op5_mixing": mixing.op5_mixing,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_nearest_neighbours": vptree.op7_nearest_neighbours,
    "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
    "op9_sharding": sharding.op9_sharding,
    "op10_html_extraction": htmltext.op10_html_extraction,
    "op11_hard_negatives": covertree.op11_hard_negatives,
    "op12_whitening": whitening.op12_whitening,
    "op13_jaccard_join": setjoin.op13_jaccard_join,
}

ORACLE_SQL = {
    "op3_warc": warc.OP3_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op11_hard_negatives": covertree.OP11_SQL,
}
