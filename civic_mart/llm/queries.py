"""The registered queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civic_mart.llm.bpe import op4_bpe
from civic_mart.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from civic_mart.llm.hnsw import op8_hnsw
from civic_mart.llm.importance import OP13_SQL, op13_importance
from civic_mart.llm.language import op3_language
from civic_mart.llm.packing import op6_packing
from civic_mart.llm.pii import op11_pii
from civic_mart.llm.pitman_yor import op2_lm
from civic_mart.llm.quality import OP7_SQL, op7_quality
from civic_mart.llm.secret_scan import op9_secrets
from civic_mart.llm.simhash import op1_simhash
from civic_mart.llm.toxicity import op5_toxicity
from civic_mart.llm.warc import OP10_SQL, op10_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_lm": op2_lm,
    "op3_language": op3_language,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_hnsw": op8_hnsw,
    "op9_secrets": op9_secrets,
    "op10_warc": op10_warc,
    "op11_pii": op11_pii,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_importance": op13_importance,
}

ORACLES: dict[str, str] = {"op7_quality": OP7_SQL, "op10_warc": OP10_SQL, "op12_hard_negatives": OP12_SQL,
                           "op13_importance": OP13_SQL}
