"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from tidemark.llm import bpe, centroids, chat, exact_dedup, packing, periodic, pii, quality_model, quality_rules, sharding, simhash, substring_dedup, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_shards": sharding.op2_shards,
    "op3_packing": packing.op3_packing,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_quality_model": quality_model.op5_quality_model,
    "op6_chat": chat.op6_chat,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_simhash": simhash.op8_simhash,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_byte_bpe": bpe.op10_byte_bpe,
    "op11_centroids": centroids.op11_centroids,
    "op12_pii": pii.op12_pii,
    "op13_periodic": periodic.op13_periodic,
}

ORACLES = {
    "op1_warc": warc.ORACLE,
    "op2_shards": sharding.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op6_chat": chat.ORACLE,
    "op7_quality_rules": quality_rules.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op11_centroids": centroids.ORACLE,
}
