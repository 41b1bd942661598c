"""Typed time-window queries over the stored datasets, guarded by the recorded coverage."""

from __future__ import annotations

import base64
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.clock import TimeArg, ns_to_timestamp, to_ns, utc_date
from tidemark.functions.scaled import unscale
from tidemark.plans.datasets import BACKFILL, DATASETS, LIVE
from tidemark.sources.store import files_below, folder_of

BATCH_ROWS = 65_536


class CoverageError(RuntimeError):
    """The window overlaps an outage, and the caller hasn't accepted that."""


class SchemaError(RuntimeError):
    """A stored column lacks what its type needs."""


@dataclass(frozen=True)
class Out:
    """An output column: its name, its source column, and whether it is unscaled or shown as a time."""

    name: str
    source: str
    kind: str = "same"


# The output columns of each query, in their order.
PRICE_SERIES = [
    Out("ts_wall", "ts_wall", "time"),
    Out("ts_ns", "ts_ns"),
    Out("market_ticker", "market_ticker"),
    Out("price", "price_dollars", "decimal"),
    Out("yes_bid", "yes_bid_dollars", "decimal"),
    Out("yes_ask", "yes_ask_dollars", "decimal"),
    Out("yes_bid_size", "yes_bid_size_fp", "decimal"),
    Out("yes_ask_size", "yes_ask_size_fp", "decimal"),
    Out("last_trade_size", "last_trade_size_fp", "decimal"),
    Out("volume", "volume_fp", "decimal"),
    Out("open_interest", "open_interest_fp", "decimal"),
]
TRADES = [
    Out("ts_wall", "ts_wall", "time"),
    Out("ts_ns", "ts_ns"),
    Out("source", "source"),
    Out("market_ticker", "market_ticker"),
    Out("trade_id", "trade_id"),
    Out("yes_price", "yes_price_dollars", "decimal"),
    Out("no_price", "no_price_dollars", "decimal"),
    Out("count", "count_fp", "decimal"),
    Out("taker_side", "taker_side"),
    Out("taker_outcome_side", "taker_outcome_side"),
    Out("taker_book_side", "taker_book_side"),
    Out("is_block_trade", "is_block_trade"),
]
TICKERS = [Out("market_ticker", "market_ticker")]
COVERAGE = [
    Out("ts_wall", "ts_wall", "time"),
    Out("gap_start", "gap_start_wall", "time"),
    Out("gap_end", "gap_end_wall", "time"),
    Out("gap_start_wall", "gap_start_wall"),
    Out("gap_end_wall", "gap_end_wall"),
]


def project(rows: DataFrame, outputs: list[Out], scales: dict[str, int]) -> DataFrame:
    """Rename, unscale and show times; Catalyst prunes the scan to the sources."""
    missing = [o.source for o in outputs if o.kind == "decimal" and o.source not in scales]
    if missing:
        raise SchemaError(f"no scale is known for {', '.join(missing)}")
    shown = {"same": lambda o: F.col(o.source), "time": lambda o: ns_to_timestamp(F.col(o.source)), "decimal": lambda o: unscale(F.col(o.source), scales[o.source])}
    return rows.select(*[shown[o.kind](o).alias(o.name) for o in outputs])


def overlaps(start: Column | str, end: Column | str, low: Column | int, high: Column | int) -> Column:
    """Do two closed intervals meet? Touching counts."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    return (col(start) <= high) & (col(end) >= low)


def dedup_trades(rows: DataFrame) -> DataFrame:
    """One copy of each trade, the live one where both exist; the earliest of several copies."""
    first = Window.partitionBy("trade_id").orderBy((F.col("source") == LIVE).desc(), "ts_wall", F.col("ts_ns").asc_nulls_last())
    return rows.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")


def in_time_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("ts_wall", F.col("ts_ns").asc_nulls_last())


@dataclass(frozen=True)
class Coverage:
    """The outages that a window overlaps."""

    gaps: DataFrame

    @cached_property
    def has_gaps(self) -> bool:
        return not self.gaps.isEmpty()


class QueryResult:
    """A lazy result: a plan, and the coverage of its window."""

    def __init__(self, plan: DataFrame, coverage: Coverage):
        self.plan, self.coverage = plan, coverage

    def dataframe(self, *, allow_gaps: bool = False) -> DataFrame:
        """The rows, unless the window has gaps that the caller hasn't accepted."""
        if not allow_gaps and self.coverage.has_gaps:
            raise CoverageError("the window overlaps recorded gaps; pass allow_gaps=True to read it all the same")
        return self.plan

    def frame(self, *, allow_gaps: bool = False) -> pd.DataFrame:
        return self.dataframe(allow_gaps=allow_gaps).toPandas()

    def iter_batches(self, batch_rows: int = BATCH_ROWS, *, allow_gaps: bool = False) -> Iterator[pd.DataFrame]:
        """Frames of at most `batch_rows` rows; the driver holds one partition at a time. The guard acts at once."""
        plan = self.dataframe(allow_gaps=allow_gaps)

        def batches() -> Iterator[pd.DataFrame]:
            held: list[tuple] = []
            for row in plan.toLocalIterator():
                held.append(tuple(row))
                if len(held) == batch_rows:
                    yield pd.DataFrame(held, columns=plan.columns)
                    held = []
            if held:
                yield pd.DataFrame(held, columns=plan.columns)

        return batches()

    def explain(self, *, analyze: bool = False) -> str:
        """The plan as text; with `analyze`, the plan that ran, after this very plan has run, with its rows and seconds."""
        query = self.plan._jdf.queryExecution()
        if not analyze:
            return query.toString()
        began = time.monotonic()
        rows = query.toRdd().count()
        return f"{rows} rows in {time.monotonic() - began:.3f} s\n{query.toString()}"


class Reader:
    """Queries over `<root>/type=<dataset>/date=<date>/part=<part>`, whoever wrote the parts; times are inclusive at both ends."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def close(self) -> None:
        """Nothing is held open; the session is the caller's."""

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def _has_files(self, dataset: str) -> bool:
        return bool(files_below(self.spark, folder_of(self.root, dataset), ".parquet"))

    def table(self, dataset: str, parts: str | None = None) -> DataFrame:
        """A dataset's rows with `date` and `part`, of all writers or of parts whose name starts as given; temporary files of writers are left out."""
        schema = DATASETS[dataset].schema
        if not self._has_files(dataset):
            return self.spark.createDataFrame([], StructType([*schema, *StructType.fromDDL("date date, part string")]))
        rows = self.spark.read.option("basePath", folder_of(self.root, dataset)).option("pathGlobFilter", "*.parquet").parquet(folder_of(self.root, dataset))
        if "date" not in rows.columns:
            rows = rows.withColumn("date", F.to_date(ns_to_timestamp(F.col("ts_wall"))))
        # files of other writers lie in the date's folder itself: their names stand for parts
        part = F.col("part").cast("string") if "part" in rows.columns else F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.parquet$", 1)
        rows = rows.withColumn("part", part)
        return rows if parts is None else rows.filter(F.col("part").startswith(parts))

    def _scales(self, dataset: str, rows: DataFrame) -> dict[str, int]:
        """Scales by column: what the stored columns say, or the Arrow metadata of files that another writer made."""
        found = {f.name: int(f.metadata["scale"]) for f in rows.schema if "scale" in f.metadata}
        if not found and self._has_files(dataset):
            found = foreign_scales(rows)
        return found or ({} if self._has_files(dataset) else {f.name: s for f in DATASETS[dataset].fields if (s := DATASETS[dataset].scale(f.name))})

    def coverage(self, start: TimeArg, end: TimeArg) -> Coverage:
        """Outages that meet the window. Gap rows lie in the date of their end, so no date is pruned."""
        low, high = _window(start, end)
        gaps = self.table("gap").filter(overlaps("gap_start_wall", "gap_end_wall", low, high)).orderBy("gap_start_wall")
        return Coverage(project(gaps, COVERAGE, {}))

    def _result(self, dataset: str, start: TimeArg, end: TimeArg, outputs: list[Out], *where: Column, dedup: bool = False, distinct: bool = False) -> QueryResult:
        low, high = _window(start, end)
        rows = self.table(dataset)
        rows = rows.filter(F.col("date").between(F.lit(utc_date(low)).cast("date"), F.lit(utc_date(high)).cast("date")) & F.col("ts_wall").between(low, high))
        for condition in where:
            rows = rows.filter(condition)
        if dedup:
            rows = dedup_trades(rows)
        scales = self._scales(dataset, self.table(dataset))
        if distinct:
            plan = project(rows, outputs, scales).distinct().orderBy(outputs[0].name)
        else:
            plan = project(in_time_order(rows), outputs, scales)
        return QueryResult(plan, self.coverage(start, end))

    def list_tickers(self, start: TimeArg, end: TimeArg, prefix: str | None = None) -> QueryResult:
        """Distinct tickers in order."""
        return self._result("ticker", start, end, TICKERS, *([F.col("market_ticker").startswith(prefix)] if prefix is not None else []), distinct=True)

    def price_series(self, ticker: str, start: TimeArg, end: TimeArg) -> QueryResult:
        """One ticker's quotes in time order."""
        return self._result("ticker", start, end, PRICE_SERIES, F.col("market_ticker") == ticker)

    def trades(self, ticker_or_prefix: str, start: TimeArg, end: TimeArg, *, source: str | None = None, raw: bool = False, exact: bool = False) -> QueryResult:
        """Trades of tickers with a prefix (all: empty; `exact`: that ticker alone), one copy each unless `raw`."""
        if source is not None and source not in (LIVE, BACKFILL):
            raise ValueError(f"source {source!r} is neither {LIVE!r} nor {BACKFILL!r}")
        ticker = F.col("market_ticker")
        where = [ticker == ticker_or_prefix if exact else ticker.startswith(ticker_or_prefix)]
        if source is not None:
            where.append(F.col("source") == source)
        return self._result("trade", start, end, TRADES, *where, dedup=not raw)


def _window(start: TimeArg, end: TimeArg) -> tuple[int, int]:
    low, high = to_ns(start), to_ns(end)
    if high < low:
        raise ValueError("the window ends before it starts")
    return low, high


def foreign_scales(rows: DataFrame) -> dict[str, int]:
    """Scales in the Arrow schema that other writers leave in a file's footer, read through Spark's file system."""
    import pyarrow as pa

    files = sorted(rows.inputFiles())
    if not files:
        return {}
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(files[0]), conf))
    try:
        stored = reader.getFooter().getFileMetaData().getKeyValueMetaData().get("ARROW:schema")
    finally:
        reader.close()
    if not stored:
        return {}
    schema = pa.ipc.read_schema(pa.py_buffer(base64.b64decode(stored)))
    return {f.name: int(f.metadata[b"scale"]) for f in schema if f.metadata and b"scale" in f.metadata}
