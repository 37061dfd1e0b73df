"""The queries of this package by name, and DuckDB SQL where SQL can state them."""

from . import balltree, decontaminate, dialogue, jaccard, mixing, packing, passages, pii, sharding, tokens, topk, toxicity, warc

QUERIES = {
    "op1_hilbert_shards": sharding.op1_hilbert_shards,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_warc_derivatives": warc.op3_warc_derivatives,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_passages": passages.op5_passages,
    "op6_top_k": topk.op6_top_k,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_pii": pii.op9_pii,
    "op10_token_ids": tokens.op10_token_ids,
    "op11_ball_tree": balltree.op11_ball_tree,
    "op12_pack": packing.op12_pack,
    "op13_repair": dialogue.op13_repair,
}

ORACLE_SQL = {"op6_top_k": topk.OP6_SQL, "op7_mix_sources": mixing.OP7_SQL, "op11_ball_tree": balltree.OP11_SQL}
