"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from threadmill.llm import byte_bpe, chosen_path, kd_sharding, learned_ann, norm_buckets, packing, parity_join, pii, recipe_dedup, suffix_dedup, toxicity, trie_variants, warc

QUERIES = {
    "op1_learned_ann": learned_ann.op1,
    "op2_byte_bpe": byte_bpe.op2,
    "op3_recipe_dedup": recipe_dedup.op3,
    "op4_pii_anchors": pii.op4,
    "op5_suffix_dedup": suffix_dedup.op5,
    "op6_parity_join": parity_join.op6,
    "op7_toxicity": toxicity.op7,
    "op8_best_fit_packing": packing.op8,
    "op9_warc": warc.op9,
    "op10_kd_sharding": kd_sharding.op10,
    "op11_trie_variants": trie_variants.op11,
    "op12_chosen_path": chosen_path.op12,
    "op13_norm_buckets": norm_buckets.op13,
}

ORACLE_SQL = {
    "op3_recipe_dedup": recipe_dedup.OP3_SQL,
    "op9_warc": warc.OP9_SQL,
    "op13_norm_buckets": norm_buckets.OP13_SQL,
}
