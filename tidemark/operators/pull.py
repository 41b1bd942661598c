"""Runs of history pulls: markets are discovered, their trades are pulled page by page, and the state says where to go on.

A run goes in waves. A wave's pages are read once, by tasks that share one request rate, and written as they come; then trades go to
their parts, and only then the state changes, for all markets of the wave in one step. So a run that breaks off repeats
pages, which replace themselves, and loses none.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scaled import volume_or_zero
from tidemark.functions.text import human_bytes, human_eta, legs_of, series_of
from tidemark.operators import backfill as B
from tidemark.operators.reader import Reader
from tidemark.operators.state import StateStore
from tidemark.sources.rest import BackfillError, Chain, Client, Transport, limits, lookup_chains, markets_chain, read_pages, trade_columns, trades_chain
from tidemark.sources.store import delete, folder_of, hadoop_path, scratch

# Fixed values of the service: the states of markets that have a history.
SCOPES = ("settled", "closed")
#: Markets of a wave, and pages that a wave reads of one market at most.
WAVE, WAVE_PAGES = 1000, 200
MARKET_FIELDS = "ticker string, event_ticker string, market_type string, status string, result string, title string, open_time string, close_time string, expiration_time string, volume_fp string"


@dataclass(frozen=True)
class PullResult:
    """What a pull did."""

    markets: int = 0
    complete: int = 0
    failed: int = 0
    trades: int = 0
    requests: int = 0
    seconds: float = 0.0


class Puller:
    """Pulls into the datasets below `root`; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, state: StateStore, transport: Transport, rate: float | None = None, capacity: float = 1.0, say: Callable[[str], None] = print, wave: int = WAVE, wave_pages: int = WAVE_PAGES):
        self.spark, self.root, self.state, self.transport, self.rate, self.capacity, self.say, self.wave, self.wave_pages = spark, root, state, transport, rate, capacity, say, wave, wave_pages

    def keep_to_limits(self) -> None:
        """Take the request rate from the account's limits."""
        self.rate, self.capacity = limits(Client(self.transport))
        self.say(f"{self.rate:.1f} requests/s, {self.capacity:.0f} at once")

    def _read(self, chains: list[Chain], max_pages: int | None = None) -> tuple[DataFrame, str]:
        """Pages of some chains, requested once: written to a scratch folder, which is the caller's to delete."""
        folder = scratch(self.spark)
        read_pages(self.spark, self.transport, chains, max_pages=max_pages, rate=self.rate, capacity=self.capacity).write.parquet(folder)
        return self.spark.read.parquet(folder), folder

    # --- discovery ---------------------------------------------------------------------------

    def discover(self, series: list[str] | None = None, with_volume: bool = False) -> int:
        """Crawl the markets of all or of some series, each scope on from where it stopped; write their metadata and add them to the state. Returns how many were seen."""
        seen = 0
        while True:
            chains = []
            for name, status, one in self._scopes(series, with_volume):
                known = self.state.discovery(name)
                if not (known and known["done"]):
                    chains.append(markets_chain(name, status, one, known and known["cursor"], known["pages"] if known else 0))
            if not chains:
                return seen
            pages, folder = self._read(chains, self.wave_pages)
            try:
                markets = self._markets(pages)
                self._write_meta(markets)
                volume = volume_or_zero(F.col("volume_fp")) if with_volume else F.lit(None).cast("long")
                found = markets.groupBy("ticker").agg(F.max(volume).alias("volume_fp"))
                seen += found.count()
                self.state.seed(found)
                failed = self._advance_scopes(pages, {c.name: c for c in chains})
            finally:
                delete(self.spark, folder)
            if failed:
                raise BackfillError(f"discovery: {failed}")

    @staticmethod
    def _scopes(series: list[str] | None, with_volume: bool) -> list[tuple[str, str, str | None]]:
        """(name, status, series) of the scopes that a discovery crawls; those with volumes are kept apart."""
        if not series:
            return [(s, s, None) for s in SCOPES]
        return [(f"{s}:census:{x}" if with_volume else f"{s}:{x}", s, x) for x in series for s in SCOPES]

    def _advance_scopes(self, pages: DataFrame, chains: dict[str, Chain]) -> dict[str, str]:
        """Note how far each scope came; returns the failures."""
        last = pages.filter("record is null").groupBy("chain").agg(F.max("page").alias("page"), F.max_by("cursor", "page").alias("cursor"), F.max("error").alias("error")).collect()  # a row per scope
        failed = {}
        rows = []
        for r in last:
            if r["page"] is not None:
                done = not r["cursor"]
                rows.append((r["chain"], None if done else r["cursor"], r["page"] + 1, done, time.time()))
            if r["error"]:
                failed[r["chain"]] = r["error"]
        self.state.set_discoveries(rows)
        return failed

    @staticmethod
    def _markets(pages: DataFrame) -> DataFrame:
        """(chain, page, record, and a column per field of a market)."""
        return pages.filter("record is not null").select("chain", "page", "record", F.from_json("record", MARKET_FIELDS).alias("m")).select("chain", "page", "record", "m.*").filter("ticker is not null")

    def _write_meta(self, markets: DataFrame) -> None:
        """Metadata of markets, a part per scope and page: a page that is read again replaces itself."""
        part = F.concat(F.regexp_replace("chain", ":", "_"), F.lit("_"), F.lpad(F.col("page").cast("string"), 5, "0"))
        rows = B.market_meta(markets.withColumn("part", part), time.time_ns(), "part").hint("rebalance", "part")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(folder_of(self.root, "market_meta"))

    # --- trades ------------------------------------------------------------------------------

    def pull(self, tickers: DataFrame, label: str = "all markets") -> PullResult:
        """Pull the trades of markets (ticker) to their ends. The observed request rate is kept for later estimates."""
        began, total = time.time(), {"markets": 0, "complete": 0, "failed": 0, "trades": 0, "requests": 0}
        held: list[str] = []
        rows = tickers.select("ticker").distinct().orderBy("ticker").toLocalIterator()
        for row in rows:
            held.append(row["ticker"])
            if len(held) == self.wave:
                self._pull_wave(held, total)
                held = []
        if held:
            self._pull_wave(held, total)
        result = PullResult(**total, seconds=time.time() - began)
        if result.requests:
            self.state.set_meta("requests_s", f"{result.requests / max(result.seconds, 1e-9):.4f}")
        self.say(f"{label}: {result.complete} of {result.markets} markets complete, {result.failed} failed, {result.trades} trades, {result.requests} requests in {human_eta(result.seconds)}")
        return result

    def _pull_wave(self, tickers: list[str], total: dict[str, int]) -> None:
        total["markets"] += len(tickers)
        left = tickers
        while left:
            wanted = self.spark.createDataFrame([(t,) for t in left], "ticker string")
            known = {r["ticker"]: r for r in self.state.table("markets").join(F.broadcast(wanted), "ticker").collect()}  # a wave's markets
            chains = [trades_chain(t, known[t]["cursor"] if t in known else None, int(known[t]["pages"] or 0) if t in known else 0) for t in left]
            pages, folder = self._read(chains, self.wave_pages)
            try:
                B.write_pages(B.trade_rows(trade_columns(pages), "page"), self.root)
                changes = self._changes(pages, known).persist()
                self.state.merge(changes.drop("seen", "requests"))
                by_status = {r["status"]: r for r in changes.groupBy("status").agg(F.count("*").alias("n"), F.sum("seen").alias("seen"), F.sum("requests").alias("requests")).collect()}
                left = [r["ticker"] for r in changes.filter("status = 'in_progress'").select("ticker").orderBy("ticker").collect()]
                changes.unpersist()
            finally:
                delete(self.spark, folder)
            for status, r in by_status.items():
                total["trades"] += r["seen"] or 0
                total["requests"] += r["requests"] or 0
                if status in ("complete", "failed"):
                    total[status] += r["n"]

    def _changes(self, pages: DataFrame, known: dict) -> DataFrame:
        """Rows of the state after some pages: cursor, counts and status, and a reason where a market failed."""
        names = [c.split()[0] for c in B.MARKETS.split(", ")]
        before = self.spark.createDataFrame([tuple(r[n] for n in names) for r in known.values()], B.MARKETS)
        got = pages.groupBy(F.col("chain").alias("ticker")).agg(
            F.max("page").alias("last"), F.max_by("cursor", F.when(F.col("record").isNull() & F.col("page").isNotNull(), F.col("page"))).alias("next"), F.max("error").alias("error"), F.count("record").alias("seen"), F.sum("requests").alias("requests")
        )
        rows = got.join(before, "ticker", "left")
        moved = F.col("last").isNotNull()
        done = moved & (F.coalesce("next", F.lit("")) == "") & F.col("error").isNull()
        return rows.select(
            "ticker",
            F.coalesce("series", series_of(F.col("ticker"))).alias("series"),
            F.when(F.col("error").isNotNull(), "failed").when(done, "complete").otherwise("in_progress").alias("status"),
            F.when(done, None).when(moved, F.nullif("next", F.lit(""))).otherwise(F.col("cursor")).alias("cursor"),
            F.when(moved, F.col("last") + 1).otherwise(F.coalesce("pages", F.lit(0))).cast("long").alias("pages"),
            (F.coalesce("trades", F.lit(0)) + F.col("seen")).alias("trades"),
            F.left("error", F.lit(B.REASON_TEXT)).alias("reason"),
            F.lit(time.time()).alias("updated"),
            "volume_fp",
            "seen",
            "requests",
        )

    # --- plans -------------------------------------------------------------------------------

    def preview(self, title: str, plans: DataFrame, margin_gb: float, free_bytes: int | None = None) -> bool:
        """Say what plans (series, est_tradeable, est_rows) would cost; False if it doesn't fit beside the margin."""
        basis = self.basis()
        rate, measured = self.state.requests_s()
        priced = B.cost_preview(plans, basis.bytes_per_row, rate)
        free = self.free_bytes() if free_bytes is None else free_bytes
        rows = priced.orderBy(F.col("series").isNull(), F.desc("est_rows"), "series").toLocalIterator()
        self.say(title)
        for r in rows:
            self.say(f"  {r['series'] or 'TOTAL':<28} {r['est_tradeable'] or 0:>9} markets {r['est_rows'] or 0:>14,} rows {human_bytes(r['est_bytes'] or 0):>10}" + (f" {r['est_requests'] or 0:,} requests, {human_eta(r['est_seconds'] or 0)}" if r["series"] is None else ""))
        self.say(f"{rate:.1f} requests/s ({'observed' if measured else 'assumed'}), {basis.bytes_per_row:.1f} bytes a row, {human_bytes(free)} free, margin {margin_gb} GB")
        fits = B.fits(priced, free, margin_gb)
        self.say("it fits" if fits else "REFUSED: it doesn't fit beside the margin")
        return fits

    def basis(self) -> B.CostBasis:
        """What the stored trades cost; where none are stored, the defaults."""
        reader = Reader(self.spark, self.root)
        return B.cost_basis(reader.table("trade")) if reader._has_files("trade") else B.CostBasis(self.spark.createDataFrame([], "series string, n long, mean_count double"), B.DEFAULT_MEAN, 0.0)

    def free_bytes(self) -> int:
        fs, path = hadoop_path(self.spark, self.root)
        return int(fs.getStatus(path if fs.exists(path) else None).getRemaining())

    def census(self, path: str, top_n: int, excluded: list[str], min_volume: float, margin_gb: float, combined_series: str | None = None, dry_run: bool = False) -> PullResult | None:
        """Pull the top series of a census: preview, discovery of the selected series, pull. None where nothing is pulled."""
        chosen = B.top_series(B.census(self.spark, path), top_n, excluded, combined_series)
        if chosen.isEmpty():
            self.say("the census names no series to pull")
            return None
        basis = self.basis()
        plans = B.with_mean(chosen, basis.means, F.lit(float(basis.fallback))).withColumn("est_rows", B.est_rows_of_series())
        if not self.preview(f"census, top {top_n or 'all'}", plans, margin_gb) or dry_run:
            return None
        series = [r["series"] for r in chosen.select("series").collect()]  # the selection: `top_n` names
        self.discover(series, with_volume=True)
        result = self.pull(B.to_pull(self.state.table("markets"), series=series, min_volume=min_volume), f"{len(series)} series")
        self.status(series)
        return result

    def combined(self, series: str, top_n: int, scan_pages: int, margin_gb: float, dry_run: bool = False) -> PullResult | None:
        """Pull the combined markets of most volume among the first pages of each scope, and their legs. Those that name no legs are reported and left out."""
        pages, folder = self._read([markets_chain(s, s, series) for s in SCOPES], scan_pages)
        try:
            markets = self._markets(pages).select("ticker", volume_or_zero(F.col("volume_fp")).alias("volume_fp"), legs_of(F.col("record")).alias("legs")).dropDuplicates(["ticker"])
            ranked = B.top_markets(markets, top_n).persist()
            self.say(f"{markets.count()} combined markets seen, {ranked.count()} taken")
            for r in B.orphans(ranked).orderBy(F.desc("volume_fp")).limit(10).collect():
                self.say(f"  no legs, not pulled: {r['ticker']} (volume {r['volume_fp'] / 100:.0f})")
            whole = ranked.filter("legs is not null")
            names = [r[0] for r in whole.select(F.explode("legs").alias("leg")).distinct().orderBy("leg").collect()]  # legs of `top_n` markets
            found, looked = self._read(lookup_chains(names)) if names else (pages.limit(0), None)
            try:
                legs = B.legs(whole, self._markets(found).select("ticker", volume_or_zero(F.col("volume_fp")).alias("volume_fp")).dropDuplicates(["ticker"])).persist()
                basis = self.basis()
                priced = whole.select(F.lit(f"{series} (combined)").alias("plan"), F.lit(series).alias("series"), "volume_fp").unionByName(legs.filter("volume_fp is not null").select(F.lit("legs").alias("plan"), series_of(F.col("leg")).alias("series"), "volume_fp"))
                priced = B.with_mean(priced, basis.means, F.lit(float(basis.fallback))).withColumn("rows", B.est_rows_of_market())
                plans = priced.groupBy(F.col("plan").alias("series")).agg(F.count("*").alias("est_tradeable"), F.sum("rows").alias("est_rows"))
                if not self.preview(f"combined markets, top {top_n} of those seen", plans, margin_gb):
                    return None
                if dry_run:
                    for r in whole.orderBy(F.desc("volume_fp"), "ticker").limit(20).collect():
                        self.say(f"  {r['ticker']} (volume {r['volume_fp'] / 100:.0f}): {', '.join(r['legs'])}")
                    return None
                known = whole.select("ticker", "volume_fp").unionByName(legs.filter("volume_fp is not null").select(F.col("leg").alias("ticker"), "volume_fp"))
                self.state.seed(known.dropDuplicates(["ticker"]))
                wanted = whole.select("ticker").unionByName(legs.select(F.col("leg").alias("ticker")))
                return self.pull(B.pending_tickers(wanted, self.state.table("markets")), f"top {top_n} combined markets and their legs")
            finally:
                if looked:
                    delete(self.spark, looked)
        finally:
            delete(self.spark, folder)

    def status(self, series: list[str] | None = None) -> None:
        """Say where all pulls stand."""
        if series is None:
            for r in self.state.summary().orderBy(F.array_position(F.array(*map(F.lit, B.STATUSES)), F.col("status"))).collect():
                self.say(f"  {r['status']:12} markets={r['markets']:7} trades={r['trades']}")
            scopes = self.state.table("discovery").orderBy("scope").collect()
            for r in scopes:
                self.say(f"  discovery[{r['scope']}]: {'complete' if r['done'] else 'in progress'} (pages={r['pages']})")
            if not scopes:
                self.say("  discovery: not started")
        state = self.state.table("markets")
        rows = B.status_by_series(B.touched(state) if series is None else state, series).orderBy("series")
        for r in rows.toLocalIterator():
            self.say(f"  {r['series']:<28} " + " ".join(f"{s}={r[s]}" for s in B.STATUSES) + f" trades={sum(r[f'{s}_trades'] for s in B.STATUSES)}")
