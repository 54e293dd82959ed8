"""The corpus pipeline: quality rules, near-dedup, decontamination, personal data, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terravane.llm import bpe, decontaminate, neardup, pii, quality
from terravane.llm.jobs import read_table, stored


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that came through."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_rules", quality.stage),
    ("near_dedup", neardup.stage),
    ("decontamination", decontaminate.stage),
    ("personal_data", pii.stage),
    ("byte_level_bpe", encode),
]
#: Learnt verdicts and a vocabulary are not SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again, over the documents of sf_dir."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
