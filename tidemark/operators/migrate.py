"""Trades of the older layout, which had no source and stood 0 for a missing clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.datasets import BACKFILL, LIVE


def with_source(trades: DataFrame) -> DataFrame:
    """Add `source`, and put NULL for the sentinel; rows that have a source already stay as they are."""
    if "source" in trades.columns:
        sentinel = (F.col("ts_ns") == 0) & (F.col("source") == BACKFILL)
        return trades.withColumn("ts_ns", F.when(~F.coalesce(sentinel, F.lit(False)), F.col("ts_ns")))
    return trades.withColumn("source", F.when(F.col("ts_ns") == 0, BACKFILL).otherwise(LIVE)).withColumn("ts_ns", F.when(F.col("ts_ns") != 0, F.col("ts_ns")))


def report(trades: DataFrame) -> DataFrame:
    """(total_rows, sentinel_rows)."""
    return trades.agg(F.count("*").alias("total_rows"), F.count_if(F.col("ts_ns") == 0).alias("sentinel_rows"))


def migrate(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """Rewrite a trade table to `target`, and check that no row is lost and no sentinel is left."""
    old = spark.read.option("pathGlobFilter", "*.parquet").parquet(source)
    with_source(old).write.partitionBy(*[c for c in ("date", "part", "hour") if c in old.columns]).parquet(target)
    before, after = report(old).first(), report(spark.read.parquet(target)).first()
    if before["total_rows"] != after["total_rows"] or after["sentinel_rows"]:
        raise RuntimeError(f"{before['total_rows']} rows became {after['total_rows']}, {after['sentinel_rows']} of them with the sentinel")
    return {"rows": after["total_rows"], "sentinels": before["sentinel_rows"]}
