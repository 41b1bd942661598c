"""Sessions with the settings that the library's semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC everywhere (epoch columns are the truth), overflow is an error, duplicate JSON keys: the last one wins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(master: str | None = None, name: str = "tidemark", **settings: str) -> SparkSession:
    """A session; the cluster's own settings for cores, memory and shuffle partitions stay as they are."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that can change at run time to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
