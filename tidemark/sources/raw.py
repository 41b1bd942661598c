"""Raw message logs: files `raw/<date>/<hour>[-<segment>].ndjson[.zst|.gz]`, landed, found, described and read as lines."""

from __future__ import annotations

import re
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.store import delete, files_below, hadoop_path, move

#: Date, name and hour of a raw file's path; an hour's file may come in segments.
LAYOUT = r"(?:^|/)(\d{4}-\d{2}-\d{2})/((\d{2})(?:-[^/.]+)?)\.ndjson(?:\.zst|\.gz)?$"


def one_form(path):
    """A path in one spelling, whichever reader reports it."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def raw_files(spark: SparkSession, root: str, mode: str = "all", target: str | None = None) -> DataFrame:
    """(path, size, mtime_ns, date, hour, part) of raw files in order: one `file`, a `date`, or `all`; the last three are NULL for other layouts."""
    where = {"all": root, "date": f"{root}/{target}", "file": target}
    if mode not in where or mode != "all" and not target:
        raise ValueError(f"mode {mode!r} with target {target!r}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where[mode])
    return with_partition(files.select(one_form(F.col("path")).alias("path"), F.col("length").alias("size"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"))).orderBy("path")


def with_partition(files: DataFrame) -> DataFrame:
    """Add date, hour and part (the name without its endings) from `path`."""
    found = lambda k: F.nullif(F.regexp_extract("path", LAYOUT, k), F.lit(""))
    return files.withColumns({"date": found(1), "hour": found(3), "part": found(2)})


def land(lines: DataFrame, root: str, segment: str = "") -> list[str]:
    """Write lines (date, hour, line, and `at` to order them by) as `<root>/<date>/<hour>[-<segment>].ndjson.gz`, a file per hour; the same segment written again replaces itself."""
    spark = lines.sparkSession
    staged = f"{root}/_landing/{uuid.uuid4().hex}"
    try:
        # The writer sorts by date and hour, and Spark drops the sort below if it doesn't begin with both. A constant is struck from it, so they
        # come out of a generator: nothing that the optimizer knows of its input passes one
        opaque = lines.select(F.inline(F.array(F.struct("date", "hour", "at", "line"))))
        ordered = opaque.repartition("date", "hour").sortWithinPartitions("date", "hour", "at")
        ordered.select("date", "hour", F.col("line").alias("value")).write.partitionBy("date", "hour").option("compression", "gzip").text(staged)
        out = []
        for path in files_below(spark, staged, ".gz"):  # one per hour
            date, hour = re.search(r"/date=([^/]+)/hour=([^/]+)/[^/]+$", path).groups()
            out.append(f"{root}/{date}/{hour}{f'-{segment}' if segment else ''}.ndjson.gz")
            move(spark, path, out[-1])
        return out
    finally:
        delete(spark, staged)


def completed(files: DataFrame, now: datetime | None = None) -> DataFrame:
    """Files of hours that are over: (date, hour) before the current one; other layouts are left out."""
    now = (now or datetime.now(UTC)).astimezone(UTC)
    return files.filter(F.concat_ws(" ", "date", "hour") < now.strftime("%Y-%m-%d %H")).filter("date is not null and hour is not null").orderBy("date", "hour", "path")


def raw_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, line_number, line) of raw files, numbered from 1 with empty lines counted but left out.

    A file's lines are one partition in order: compressed files can't be split, and plain ones are read with splits larger than any of them."""
    if plain := [f for p in ([paths] if isinstance(paths, str) else paths) for f in (files_below(spark, p, ".ndjson") if not p.endswith((".zst", ".gz")) else [])]:
        longest = max(int(fs.getFileStatus(p).getLen()) for fs, p in (hadoop_path(spark, f) for f in plain))
        if longest >= spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")):
            raise ValueError(f"a plain file of {longest} bytes would be split and its lines misnumbered: compress it, or raise spark.sql.files.maxPartitionBytes")
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    read = lines.select(one_form(F.col("_metadata.file_path")).alias("path"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    first = read.groupBy("path").agg(F.min("at").alias("first"))
    numbered = read.join(F.broadcast(first) if isinstance(paths, list) and len(paths) <= 10_000 else first, "path")
    return numbered.select("path", (F.col("at") - F.col("first") + 1).alias("line_number"), "line").filter("line <> ''")
