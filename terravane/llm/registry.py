"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from terravane.llm import bpe, decontaminate, neardup, pii, quality, sharding, tokencounts, tokenfiles, toxicity, urlfilter


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_benchmark_decontamination": decontaminate.op2_benchmark_decontamination,
        "op3_token_counts": tokencounts.op3_token_counts,
        "op4_pii": pii.op4_pii,
        "op5_url_filters": urlfilter.op5_url_filters,
        "op6_token_files": tokenfiles.op6_token_files,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_sharding": sharding.op8_sharding,
        "op9_byte_level_bpe": bpe.op9_byte_level_bpe,
        "op10_minhash_near_dedup": neardup.op10_minhash_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_benchmark_decontamination": decontaminate.ORACLE, "op5_url_filters": urlfilter.ORACLE}
