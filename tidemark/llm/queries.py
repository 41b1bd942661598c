"""Queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, html_text, line_dedup, near_dedup, packing, quality, substring_dedup, token_counts, token_files, toxicity

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_packing": packing.op6_packing,
    "op7_html_text": html_text.op7_html_text,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_token_counts": token_counts.op10_token_counts,
}
_ORACLES: dict[str, str] = {
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op3_quality_rules": quality.ORACLE,
    "op4_near_dedup": near_dedup.ORACLE,
    "op8_decontamination": decontamination.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
