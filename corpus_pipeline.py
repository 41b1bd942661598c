"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage reads all that the one before it kept, as a written table. All but the last return the columns of
`documents`, extra ones and their names untouched; the last returns where the documents' pieces lie in packed sequences.

Defined results, as the operators state them: null and empty texts have no words, so the quality rules refuse them; rows with the
same or no id are documents of their own, but equal texts are one group of near duplicates whatever their ids, of
which the smallest id (of equal ids the first row) stays; null columns pass through; very long texts are taken whole; an empty
table passes every stage as an empty table; without labels the quality rules keep what passes the base rules, and without
benchmark items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table
from tidemark.llm.decontamination import decontaminate
from tidemark.llm.line_dedup import without_repeated_lines
from tidemark.llm.near_dedup import near_dedup
from tidemark.llm.packing import described, pack
from tidemark.llm.quality import quality_filter
from tidemark.llm.tokens import path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules refuse go."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten documents or more go; `n_chars` follows the text."""
    out = without_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return described(pack(docs, path("byte_bpe_50k.json"), "byte"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL has no form of the near-duplicate stage; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
