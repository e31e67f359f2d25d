"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from posloom.llm import (
    centroids,
    exact_dedup,
    hard_negatives,
    language_model,
    mixing,
    near_dedup,
    packing,
    quality,
    sharding,
    substring,
    token_files,
    toxicity,
    warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_lm_scoring": language_model.op6_lm_scoring,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_shard_shuffle": sharding.op8_shard_shuffle,
    "op9_repeated_substrings": substring.op9_repeated_substrings,
    "op10_warc_revisits": warc.op10_warc_revisits,
    "op11_token_files": token_files.op11_token_files,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_centroid_clusters": centroids.op13_centroid_clusters,
}
TWIN_SQL = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op4_quality_rules": quality.OP4_SQL,
    "op10_warc_revisits": warc.OP10_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_centroid_clusters": centroids.OP13_SQL,
}
