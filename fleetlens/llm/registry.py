"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from fleetlens.llm import (ann, chat, dac, exact_dedup, jaccard_join, lm_score, merkle, mixing, packing, pii,
                           repair, rlz, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_mixing": mixing.op2_mixing,
    "op3_ann": ann.op3_ann,
    "op4_pii": pii.op4_pii,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_jaccard": jaccard_join.op6_jaccard,
    "op7_token_files": dac.op7_token_files,
    "op8_packing": packing.op8_packing,
    "op9_chat_rotation": chat.op9_chat_rotation,
    "op10_lm_score": lm_score.op10_lm_score,
    "op11_substring_dedup": rlz.op11_substring_dedup,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_conversation_repair": repair.op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_mixing": mixing.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op9_chat_rotation": chat.ORACLE,
    "op11_substring_dedup": rlz.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_conversation_repair": repair.ORACLE,
}
