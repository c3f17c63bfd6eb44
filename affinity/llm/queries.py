"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from affinity.llm import align, decontam, html_main, lm, neardup, pieces, prefix_trie, quality, quotes, sharding, suffix_dedup, topk, toxicity


def queries():
    return {
        "op1_bm25_decontam": decontam.query,
        "op2_quote_links": quotes.query,
        "op3_weighted_minhash": neardup.query,
        "op4_hashed_maxent": lm.query,
        "op5_piece_lattice": pieces.query,
        "op6_host_suffixes": html_main.query,
        "op7_bigru_attention": toxicity.query,
        "op8_best_fit_shards": sharding.query,
        "op9_pivot_topk": topk.query,
        "op10_line_crf": quality.query,
        "op11_token_alignment": align.query,
        "op12_merged_transforms": suffix_dedup.query,
        "op13_zfast_trie": prefix_trie.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quote_links": quotes.SQL,
        "op9_pivot_topk": topk.SQL,
        "op13_zfast_trie": prefix_trie.SQL,
    }
