"""The stored datasets: one layout for what is compacted, pulled and streamed, and the folders below it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.datasets import LAYOUT


def folder_of(root: str, dataset: str) -> str:
    return f"{root}/type={dataset}"


def write_parts(rows: DataFrame, root: str, dataset: str) -> None:
    """Write rows with `date` and `part`; each (date, part) among them replaces what was stored under it."""
    # a part's rows come together, and AQE splits those that are too large for one file
    together = rows.hint("rebalance", *LAYOUT)
    together.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(folder_of(root, dataset))


def hadoop_path(spark: SparkSession, path: str):
    """A file system and a path in it, in any store that Spark can reach."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def files_below(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths of files below a folder, in order."""
    fs, p = hadoop_path(spark, folder)
    found = fs.listFiles(p, True) if fs.exists(p) else None
    out = []
    while found is not None and found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(suffix):
            out.append(name)
    return sorted(out)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, in place of what has the new name."""
    fs, old = hadoop_path(spark, source)
    _, new = hadoop_path(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new):
        fs.delete(new, False)
    if not fs.rename(old, new):
        raise OSError(f"{source} can't be renamed to {target}")


def scratch(spark: SparkSession) -> str:
    """A new folder below the session's `spark.checkpoint.dir`; only a local session may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: a folder that the driver and all executors share is needed")
        base = "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """(date, part, n, bytes) of a file-based table with the stored layout: rows and file sizes as they lie there."""
    files = rows.select("date", "part", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).groupBy("date", "part", "f").agg(F.count("*").alias("n"), F.max("s").alias("s"))
    return files.groupBy(F.col("date").cast("string").alias("date"), F.col("part").cast("string").alias("part")).agg(F.sum("n").alias("n"), F.sum("s").alias("bytes"))
