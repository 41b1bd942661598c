"""Which raw files may go: five conditions, each with a reason where it fails."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_AGE_DAYS = 7.0


def age_days(now: datetime) -> Column:
    """Days since the end of a file's hour."""
    end = F.to_timestamp(F.concat_ws(" ", "date", "hour"), "yyyy-MM-dd HH") + F.expr("INTERVAL 1 HOUR")
    return (F.lit(int(now.timestamp() * 1_000_000)) - F.unix_micros(end)) / F.lit(86_400_000_000.0)


def expected_outputs(manifest: DataFrame) -> DataFrame:
    """(path, type): outputs that a processed file must have left, types without rows left none."""
    return manifest.select("path", F.explode("rows_by_type").alias("type", "n")).filter("n > 0").select("path", "type")


def missing_outputs(files: DataFrame, manifest: DataFrame, outputs: DataFrame) -> DataFrame:
    """(path, type) whose output (type, date, part) isn't among `outputs`."""
    wanted = expected_outputs(manifest).join(files.select("path", "date", "part"), "path")
    return wanted.join(outputs.select("type", "date", "part").distinct(), ["type", "date", "part"], "left_anti").select("path", "type")


def assess(files: DataFrame, manifest: DataFrame, outputs: DataFrame, now: datetime | None = None, min_age_days: float = MIN_AGE_DAYS) -> DataFrame:
    """Every raw file with its conditions, `deletable` and `reasons`."""
    now = now or datetime.now(UTC)
    entry = manifest.select("path", F.col("size").alias("m_size"), F.col("mtime_ns").alias("m_mtime_ns"), "total_lines", "rows_by_type", "rejects", F.lit(True).alias("found"))
    missing = missing_outputs(files, manifest, outputs).groupBy("path").agg(F.count("*").alias("n_missing"))
    rows = F.aggregate(F.map_values("rows_by_type"), F.lit(0).cast("long"), lambda a, x: a + x)
    out = files.join(entry, "path", "left").join(missing, "path", "left")
    known, laid_out = F.coalesce("found", F.lit(False)), F.col("date").isNotNull() & F.col("hour").isNotNull()
    out = out.withColumn("age_days", age_days(now)).withColumns(
        {
            "old_enough": laid_out & (F.coalesce("age_days", F.lit(-1.0)) >= min_age_days),
            "in_manifest": laid_out & known,
            "reconciled": laid_out & known & F.coalesce(rows + F.col("rejects") == F.col("total_lines"), F.lit(False)),
            "matches_disk": laid_out & known & F.coalesce((F.col("m_size") == F.col("size")) & (F.col("m_mtime_ns") == F.col("mtime_ns")), F.lit(False)),
            "outputs_exist": laid_out & known & F.col("n_missing").isNull(),
        }
    )
    checks = ["old_enough", "in_manifest", "reconciled", "matches_disk", "outputs_exist"]
    deletable = F.lit(True)
    for c in checks:
        deletable = deletable & F.col(c)
    reasons = F.array(
        F.when(~laid_out, "unknown layout"),
        F.when(laid_out & ~F.col("old_enough"), "too young"),
        F.when(laid_out & ~known, "not in the manifest"),
        F.when(known & laid_out & ~F.col("reconciled"), "counts differ"),
        F.when(known & laid_out & ~F.col("matches_disk"), "changed since"),
        F.when(known & laid_out & ~F.col("outputs_exist"), "outputs missing"),
    )
    return out.select("path", "date", "hour", "age_days", *checks, deletable.alias("deletable"), F.filter(reasons, lambda x: x.isNotNull()).alias("reasons"))


def delete(spark: SparkSession, assessed: DataFrame, dry_run: bool = True) -> list[str]:
    """Delete what may go, unless it is a dry run; returns the paths, one file at a time."""
    done = []
    for row in assessed.filter("deletable").select("path").orderBy("path").toLocalIterator():
        if not dry_run:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(row["path"])
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
        done.append(row["path"])
    return done
