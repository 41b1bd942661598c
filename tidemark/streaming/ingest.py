"""Streams: raw messages into hourly folders, typed rows as files come, late copies, hourly volumes, silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.clock import ns_to_date, ns_to_hour, ns_to_timestamp
from tidemark.operators.ingest import classify, rows_of
from tidemark.plans.datasets import DATASETS
from tidemark.sources.raw import land, one_form, raw_files, raw_lines
from tidemark.sources.store import write_parts


def hourly(messages: DataFrame) -> DataFrame:
    """Messages with the UTC date and hour of their wall clock: a late message goes to its own hour."""
    return messages.withColumns({"date": ns_to_date(F.col("ts_wall")), "hour": ns_to_hour(F.col("ts_wall"))})


def ticker_of(raw: Column) -> Column:
    return F.get_json_object(raw, "$.msg.market_ticker")


def wanted(messages: DataFrame, prefixes: list[str]) -> DataFrame:
    """Messages of tickers with one of the prefixes, and all that name no ticker (control messages, gap markers)."""
    if not prefixes:
        return messages
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | ticker_of(F.col("raw")).startswith(p)
    return messages.filter(ticker_of(F.col("raw")).isNull() | hit)


def log_line(messages: DataFrame) -> Column:
    """The line that a row of the feed leaves in a raw file: a message with its clocks, or a gap marker."""
    gap = ["gap_start_ns", "gap_start_wall", "gap_end_ns", "gap_end_wall"]
    known = [c for c in ("ts_ns", "ts_wall", "raw", "marker", *gap) if c in messages.columns]
    return F.to_json(F.struct(*known))  # without what is NULL


def write_raw(messages: DataFrame, folder: str, checkpoint: str, prefixes: list[str] | None = None, **trigger: object) -> StreamingQuery:
    """Land messages as `<folder>/<date>/<hour>-<batch>.ndjson.gz`, as compaction reads them; a batch that runs again replaces its own files."""

    def write(batch: DataFrame, number: int) -> None:
        rows = hourly(wanted(batch, prefixes or []))
        land(rows.select(F.col("date").cast("string").alias("date"), "hour", log_line(batch).alias("line"), F.col("ts_wall").alias("at")), folder, f"{number:08d}")

    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def lines_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """New raw files as lines; the rate limit holds files back, it drops nothing."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").load(folder)
    return lines.select(one_form(F.col("_metadata.file_path")).alias("path"), F.lit(None).cast("long").alias("line_number"), F.col("value").alias("line")).filter("line <> ''")


INGESTED = "path string, size long, mtime_ns long"


def _store_files(lines: DataFrame, out: str) -> None:
    """Classify whole files' lines and store them, a part per file: a file that is stored again replaces its part."""
    rows = classify(lines).withColumn("part", F.concat(F.lit("stream_"), F.left(F.sha1(F.col("path").cast("binary")), F.lit(16)))).persist()
    try:
        for d in DATASETS.values():
            write_parts(rows_of(rows, d, "part").withColumn("date", ns_to_date(F.col("ts_wall"))), out, d.name)
        refused = rows.filter("reason is not null").select("path", "reason", "line", "part")
        refused.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").json(f"{out}/stream_rejects")
    finally:
        rows.unpersist()


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Classify new raw files and store each dataset's rows, a part per file; a batch that runs again replaces its own parts. What was read is noted as it lay there then."""

    def write(batch: DataFrame, number: int) -> None:
        paths = [r[0] for r in batch.select("path").distinct().collect()]  # at most a batch's files
        files = raw_files(spark, folder).select("path", "size", "mtime_ns").filter(F.col("path").isin(paths))
        noted = [tuple(r) for r in files.collect()]
        _store_files(batch, out)
        spark.createDataFrame(noted, INGESTED).coalesce(1).write.mode("overwrite").parquet(f"{out}/stream_files/batch={number:08d}")

    return lines_stream(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changed_files(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """(path, size, mtime_ns) of files that the stream has read and that grew or changed since: a stream reads a file once."""
    noted = spark.read.schema(INGESTED).option("recursiveFileLookup", "true").parquet(f"{out}/stream_files")
    now = raw_files(spark, folder).select("path", "size", "mtime_ns")
    last = noted.groupBy("path").agg(F.max_by(F.struct("size", "mtime_ns"), "mtime_ns").alias("was"))
    return now.join(last, "path").filter((F.col("size") != F.col("was.size")) | (F.col("mtime_ns") != F.col("was.mtime_ns"))).select("path", "size", "mtime_ns")


def reingest(spark: SparkSession, folder: str, out: str, at: str) -> int:
    """Store files anew that changed since the stream read them; `at` names the run. Returns how many."""
    changed = [tuple(r) for r in changed_files(spark, folder, out).collect()]  # one row per changed file
    if changed:
        _store_files(raw_lines(spark, [p for p, *_ in changed]), out)
        spark.createDataFrame(changed, INGESTED).coalesce(1).write.mode("overwrite").parquet(f"{out}/stream_files/again={at}")
    return len(changed)


def first_copies(trades: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The first arriving copy of each trade within the watermark (an extension: it keeps the first, not the live copy)."""
    return trades.withColumn("at", ns_to_timestamp(F.col("ts_wall"))).withWatermark("at", delay).dropDuplicatesWithinWatermark(["trade_id"])


def hourly_volume(trades: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Trades and contracts per ticker and hour; on a stream, hours close after the delay."""
    rows = trades.withColumn("at", ns_to_timestamp(F.col("ts_wall")))
    rows = rows.withWatermark("at", delay) if trades.isStreaming else rows
    out = rows.groupBy(F.window("at", "1 hour"), "market_ticker").agg(F.count("*").alias("n"), F.sum("count_fp").alias("count_fp"))
    return out.select(F.col("window.start").alias("hour"), "market_ticker", "n", "count_fp")


MINUTE, DAY = 60_000_000_000, 86_400_000_000_000


def runs(messages: DataFrame, silence_ns: int) -> DataFrame:
    """(start_wall, end_wall, n): runs of messages (ts_wall) between which nothing came for `silence_ns` (over a minute) or longer.

    A minute holds no silence, so its ends and its count stand for it; they are added up before any shuffle. Runs are found day by day, and the few
    of each day are joined to those of the days beside it."""
    if silence_ns <= MINUTE:
        raise ValueError("a silence of a minute or less may lie within a minute")
    per = lambda step: F.call_function("div", F.col("ts_wall"), F.lit(step).cast("bigint"))
    minutes = messages.groupBy(per(DAY).alias("day"), per(MINUTE).alias("minute")).agg(F.min("ts_wall").alias("a"), F.max("ts_wall").alias("b"), F.count("*").alias("n"))
    return _stitched(_stitched(minutes, silence_ns, "day"), silence_ns).select(F.col("a").alias("start_wall"), F.col("b").alias("end_wall"), "n")


def _stitched(rows: DataFrame, silence_ns: int, *by: str) -> DataFrame:
    """Stretches (a, b, n) that lie closer together than the silence, as one."""
    order = Window.partitionBy(*by).orderBy("a")
    fresh = F.coalesce(F.col("a") - F.lag("b").over(order) >= silence_ns, F.lit(True)).cast("int")
    numbered = rows.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    return numbered.groupBy(*by, "run").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"))


def silences(messages: DataFrame, longer_than_ns: int) -> DataFrame:
    """(gap_start_wall, gap_end_wall): stretches longer than that between consecutive messages (ts_wall)."""
    found = runs(messages, longer_than_ns + 1)  # one row per run: few enough for one window
    before = F.lag("end_wall").over(Window.orderBy("start_wall"))
    return found.select(before.alias("gap_start_wall"), F.col("start_wall").alias("gap_end_wall")).filter("gap_start_wall is not null")


def sessions(messages: DataFrame, silence: str = "30 minutes", delay: str = "10 minutes", key: str | None = None) -> DataFrame:
    """Runs of messages with no longer silence between them (an extension): outages lie between the runs. With a key, the runs of each; a stream needs one, as all its state would lie in one task."""
    if messages.isStreaming and key is None:
        raise ValueError("sessions of a stream need a key")
    if key is None:
        length = int(messages.sparkSession.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL {silence})").first()[0]) * 1000
        found = runs(messages, length)
        return found.select(ns_to_timestamp(F.col("start_wall")).alias("start"), ns_to_timestamp(F.col("end_wall") + length).alias("end"), "n")
    rows = messages.withColumn("at", ns_to_timestamp(F.col("ts_wall")))
    rows = rows.withWatermark("at", delay) if messages.isStreaming else rows
    return rows.groupBy(F.session_window("at", silence), key).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
