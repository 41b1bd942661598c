"""History pulls: what is stored per trade, what a pull would cost, which series and markets to pull, and their state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import floor_millis, floor_seconds, ns_to_date, timestamp_to_ns
from tidemark.functions.scaled import none_if_empty, parse_scaled
from tidemark.functions.text import series_of
from tidemark.plans.datasets import BACKFILL
from tidemark.sources.store import write_parts

#: Series with fewer stored trades have no mean of their own.
TRUSTED_TRADES, DEFAULT_MEAN = 100, 1.0
PAGE_ROWS, DEFAULT_REQUESTS_S = 1000, 12.0
STATUSES = ("not_started", "in_progress", "complete", "failed")
CENSUS = "series string, total long, est_tradeable long, mean_vol double"
MARKETS = "ticker string, series string, status string, cursor string, pages long, trades long, reason string, updated double, volume_fp long"
REASON_TEXT = 500


# --- stored pages ---------------------------------------------------------------------------


def trade_rows(pages: DataFrame, *keep: str) -> DataFrame:
    """REST trades (a column per JSON field) as stored rows, without a clock of their own; lenient where live rows are strict."""
    ns = timestamp_to_ns(F.to_timestamp("created_time"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = pages.withColumn("ts_wall", ns)
    return rows.select(
        F.lit(None).cast("long").alias("ts_ns"),
        "ts_wall",
        F.lit(0).cast("long").alias("sid"),
        F.lit(0).cast("long").alias("seq"),
        text("trade_id").alias("trade_id"),
        text("ticker").alias("market_ticker"),
        parse_scaled(F.col("yes_price_dollars"), 4).alias("yes_price_dollars", metadata={"scale": "10000"}),
        parse_scaled(F.col("no_price_dollars"), 4).alias("no_price_dollars", metadata={"scale": "10000"}),
        parse_scaled(F.col("count_fp"), 2).alias("count_fp", metadata={"scale": "100"}),
        *[text(c).alias(c) for c in ("taker_side", "taker_outcome_side", "taker_book_side")],
        F.coalesce(F.col("is_block_trade").cast("boolean"), F.lit(False)).alias("is_block_trade"),
        floor_seconds(F.col("ts_wall")).alias("ts"),
        floor_millis(F.col("ts_wall")).alias("ts_ms"),
        F.lit(BACKFILL).alias("source"),
        ns_to_date(F.col("ts_wall")).alias("date"),
        *keep,
    )


def page_name(ticker: Column, page: Column) -> Column:
    """The same name for the same page of the same market, whenever it is pulled."""
    return F.concat(F.lit("backfill_"), F.left(F.sha1(ticker.cast("binary")), F.lit(16)), F.lit("_"), F.lpad(page.cast("string"), 5, "0"))


def write_pages(rows: DataFrame, root: str) -> None:
    """Write trades with `page` below the datasets' root, a part per date and page; a page pulled again replaces itself."""
    write_parts(rows.withColumn("part", page_name(F.col("market_ticker"), F.col("page"))).drop("page"), root, "trade")


def market_meta(markets: DataFrame, discovered_ts_ns: int, *keep: str) -> DataFrame:
    """Metadata rows of markets; empty texts are NULL."""
    optional = ["event_ticker", "market_type", "status", "result", "title", "open_time", "close_time", "expiration_time"]
    return markets.select("ticker", series_of(F.col("ticker")).alias("series"), *[none_if_empty(F.col(c)).alias(c) for c in optional], F.lit(discovered_ts_ns).cast("long").alias("discovered_ts_ns"), *keep)


# --- cost -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class CostBasis:
    """Mean contracts of a trade by series, the mean for all others, and the bytes of a stored trade."""

    means: DataFrame
    fallback: float
    bytes_per_row: float


def trusted_means(trades: DataFrame) -> DataFrame:
    """(series, n, mean_count) of series with enough trades and a positive mean."""
    stats = trades.groupBy(series_of(F.col("market_ticker")).alias("series")).agg(F.count("*").alias("n"), F.avg("count_fp").alias("m"))
    return stats.filter((F.col("n") >= TRUSTED_TRADES) & (F.col("m") > 0)).select("series", "n", (F.col("m") / 100.0).alias("mean_count"))


def fallback_mean(means: DataFrame) -> DataFrame:
    """(fallback): the median of the trusted means, or 1."""
    return means.agg(F.coalesce(F.median("mean_count"), F.lit(DEFAULT_MEAN)).alias("fallback"))


def stored_bytes(rows: DataFrame) -> DataFrame:
    """(bytes, rows, bytes_per_row) of a file-based table, each file's size once."""
    files = rows.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).groupBy("f").agg(F.max("s").alias("s"), F.count("*").alias("n"))
    return files.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).withColumn("bytes_per_row", F.col("bytes") / F.nullif("rows", F.lit(0)))


def cost_basis(trades: DataFrame) -> CostBasis:
    means = trusted_means(trades)
    return CostBasis(means, fallback_mean(means).first()[0], stored_bytes(trades).first()["bytes_per_row"] or 0.0)


def with_mean(rows: DataFrame, basis_means: DataFrame, fallback: Column) -> DataFrame:
    """Add `mean_count`: the series' own if it is positive, else the fallback."""
    return rows.join(basis_means.select("series", F.col("mean_count").alias("own")), "series", "left").withColumn("mean_count", F.when(F.col("own") > 0, F.col("own")).otherwise(fallback)).drop("own")


def est_rows_of_series() -> Column:
    """Rows to expect of a series, half to even."""
    return F.bround(F.col("est_tradeable") * F.col("mean_vol") / F.col("mean_count")).cast("long")


def est_rows_of_market() -> Column:
    return F.bround(F.col("volume_fp") / 100.0 / F.col("mean_count")).cast("long")


def pages_for(rows: Column) -> Column:
    return F.ceil(rows / float(PAGE_ROWS)).cast("long")


def cost_preview(plans: DataFrame, bytes_per_row: float, requests_s: float = DEFAULT_REQUESTS_S) -> DataFrame:
    """Plans (series, est_tradeable, est_rows) with bytes, requests and seconds, per series and in all (series NULL)."""
    # a request for each market, and one for each page of rows
    priced = plans.withColumns({"est_bytes": (F.col("est_rows") * bytes_per_row).cast("long"), "est_requests": F.col("est_tradeable") + pages_for(F.col("est_rows"))})
    total = priced.rollup("series").agg(*[F.sum(c).alias(c) for c in ("est_tradeable", "est_rows", "est_bytes", "est_requests")])
    return total.withColumn("est_seconds", F.col("est_requests") / F.lit(requests_s))


def fits(preview: DataFrame, free_bytes: int, margin_gb: float) -> bool:
    """Do the expected bytes leave the margin free?"""
    return (preview.filter("series is null").first()["est_bytes"] or 0) <= free_bytes - margin_gb * 1e9


# --- choice ---------------------------------------------------------------------------------


def census(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CENSUS).option("multiLine", "true").json(path)


def top_series(rows: DataFrame, top_n: int, excluded: list[str], combined_series: str | None = None) -> DataFrame:
    """Series by tradeable markets, most first (ties: by name); none of an excluded prefix; all if `top_n` isn't positive."""
    kept = rows.filter("est_tradeable > 0")
    for prefix in [*excluded, combined_series or ""]:
        if prefix:
            kept = kept.filter(~F.col("series").startswith(prefix))
    ranked = kept.orderBy(F.desc("est_tradeable"), "series")
    return ranked.limit(top_n) if top_n > 0 else ranked


def top_markets(markets: DataFrame, k: int) -> DataFrame:
    """The k markets of most volume (ties: by ticker)."""
    return markets.orderBy(F.desc("volume_fp"), "ticker").limit(max(0, k))


def legs(combined: DataFrame, volumes: DataFrame) -> DataFrame:
    """(leg, volume_fp): distinct legs of combined markets; a leg without a known volume is kept with NULL."""
    found = combined.select(F.explode("legs").alias("leg")).distinct()
    return found.join(volumes.select(F.col("ticker").alias("leg"), "volume_fp"), "leg", "left")


def orphans(combined: DataFrame) -> DataFrame:
    """Combined markets that name no legs."""
    return combined.filter(F.col("legs").isNull() | (F.size("legs") == 0))


# --- state ----------------------------------------------------------------------------------


def merge_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State after changes: the newest row of a ticker, changes before what was there; a change's NULL volume keeps the old one."""
    both = state.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    newest = Window.partitionBy("ticker").orderBy(F.desc("_new"), F.desc("updated"))
    volume = F.first("volume_fp", ignorenulls=True).over(newest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return both.withColumns({"volume_fp": volume, "_n": F.row_number().over(newest)}).filter("_n = 1").drop("_n", "_new")


def seed(state: DataFrame, markets: DataFrame, now: float = 0.0) -> DataFrame:
    """State with new markets (ticker, volume_fp) added; of known ones only the volume follows."""
    fresh = markets.select("ticker", F.col("volume_fp").alias("_v")).join(state, "ticker", "full_outer")
    return fresh.select(
        "ticker",
        F.coalesce("series", series_of(F.col("ticker"))).alias("series"),
        F.coalesce("status", F.lit(STATUSES[0])).alias("status"),
        "cursor",
        F.coalesce("pages", F.lit(0).cast("long")).alias("pages"),
        F.coalesce("trades", F.lit(0).cast("long")).alias("trades"),
        "reason",
        F.coalesce("updated", F.lit(now)).alias("updated"),
        F.coalesce("_v", "volume_fp").alias("volume_fp"),
    )


def record_page(state: DataFrame, ticker: str, cursor: str | None, rows: int, last: bool, now: float) -> DataFrame:
    """State after a page; the last page completes its market in the same step."""
    here = F.col("ticker") == ticker
    put = lambda c, v: F.when(here, v).otherwise(F.col(c))
    return state.withColumns(
        {
            "cursor": put("cursor", F.lit(None if last else cursor).cast("string")),
            "status": put("status", F.lit("complete" if last else "in_progress")),
            "pages": put("pages", F.col("pages") + 1),
            "trades": put("trades", F.col("trades") + rows),
            "updated": put("updated", F.lit(now)),
        }
    )


def set_failed(state: DataFrame, ticker: str, reason: str, now: float) -> DataFrame:
    here = F.col("ticker") == ticker
    return state.withColumns({"status": F.when(here, "failed").otherwise(F.col("status")), "reason": F.when(here, reason[:REASON_TEXT]).otherwise(F.col("reason")), "updated": F.when(here, now).otherwise(F.col("updated"))})


def _like(prefix: str) -> Column:
    """The prefix test of the state store: ASCII case doesn't count, `_` and `%` are wildcards."""
    return F.col("ticker").ilike(f"{prefix}%")


def reset_failed(state: DataFrame, prefix: str) -> DataFrame:
    hit = (F.col("status") == "failed") & _like(prefix)
    return state.withColumns({"status": F.when(hit, STATUSES[0]).otherwise(F.col("status")), "reason": F.when(~hit, F.col("reason"))})


def to_pull(state: DataFrame, prefix: str | None = None, series: list[str] | None = None, min_volume: float = 0.0) -> DataFrame:
    """Tickers still to pull, in order: by prefix, or by series and least volume (in contracts; 0: any)."""
    out = state.filter(F.col("status").isin("not_started", "in_progress"))
    if prefix is not None:
        out = out.filter(_like(prefix))
    if series is not None:
        out = out.filter(F.col("series").isin(*series))
    least = round(min_volume * 100)
    if least > 0:
        out = out.filter(F.col("volume_fp").isNotNull() & (F.col("volume_fp") >= least))
    return out.select("ticker").orderBy("ticker")


def pending_tickers(tickers: DataFrame, state: DataFrame) -> DataFrame:
    """Given tickers that aren't complete, known or not."""
    return tickers.join(state.select("ticker", "status"), "ticker", "left").filter(F.coalesce("status", F.lit("")) != "complete").select("ticker")


def status_summary(state: DataFrame) -> DataFrame:
    """(status, markets, trades) of every status, also of those without markets."""
    known = state.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    counts = state.groupBy("status").agg(F.count("*").alias("markets"), F.coalesce(F.sum("trades"), F.lit(0)).alias("trades"))
    return known.join(counts, "status", "left").select("status", F.coalesce("markets", F.lit(0)).alias("markets"), F.coalesce("trades", F.lit(0)).alias("trades"))


def touched(state: DataFrame) -> DataFrame:
    """Markets that a pull has in view: with a known volume, or not waiting any more."""
    return state.filter(F.col("volume_fp").isNotNull() | (F.col("status") != STATUSES[0]))


def status_by_series(state: DataFrame, series: list[str] | None = None) -> DataFrame:
    """A row per series with, for each status, a count of markets (`complete`) and their trades (`complete_trades`)."""
    rows = state if series is None else state.filter(F.col("series").isin(*series))
    counts = {f"{s}{end}": f for s in STATUSES for end, f in (("", F.count_if(F.col("status") == s)), ("_trades", F.coalesce(F.sum(F.when(F.col("status") == s, F.col("trades"))), F.lit(0))))}
    return rows.groupBy("series").agg(*[f.alias(n) for n, f in counts.items()])
