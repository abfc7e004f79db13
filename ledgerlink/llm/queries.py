"""The registered queries of the corpus operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlink.llm import decontaminate, divergence, language_id, line_dedup, mtree, near_dedup, passages, raking, repair, sharding, simple8b, toxicity, url_reputation

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_minimax_shards": sharding.op1,
    "op2_host_reputation": url_reputation.op2,
    "op3_simple8b_tokens": simple8b.op3,
    "op4_line_edit_join": line_dedup.op4,
    "op5_raked_mix": raking.op5,
    "op6_ppm_language": language_id.op6,
    "op7_factorization_toxicity": toxicity.op7,
    "op8_simhash_decontamination": decontaminate.op8,
    "op9_hyperminhash_near_dedup": near_dedup.op9,
    "op10_mtree_top5": mtree.op10,
    "op11_chunk_divergence": divergence.op11,
    "op12_auction_repair": repair.op12,
    "op13_attention_quality": passages.op13,
}

SQL: dict[str, str] = {
    "op2_host_reputation": url_reputation.OP2_SQL,
    "op8_simhash_decontamination": decontaminate.OP8_SQL,
    "op11_chunk_divergence": divergence.OP11_SQL,
}
