"""Command line: record, compact, retain, migrate, backfill, space."""

from __future__ import annotations

import argparse
import os
import signal
import sys
import threading
import time
import urllib.parse

from pyspark.sql import SparkSession

from tidemark import config
from tidemark.functions.text import human_bytes
from tidemark.operators import ingest, migrate, retention
from tidemark.operators.backfill import to_pull
from tidemark.operators.pull import Puller
from tidemark.operators.state import StateStore
from tidemark.session import session
from tidemark.sources.auth import Signer
from tidemark.sources.raw import completed, raw_files, with_partition
from tidemark.sources.rest import Transport, http_transport
from tidemark.sources.socket import Recorder, feed_source, websocket
from tidemark.streaming import guards
from tidemark.streaming.guards import free_gb
from tidemark.streaming.ingest import write_raw


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)
    f = sub.add_parser("record", help="land the live feed as raw files until it is told to stop")
    f.add_argument("url", help="the feed's web socket")
    f.add_argument("--seconds", type=float, help="stop after so long")
    f.add_argument("--report-every", type=float, default=60.0, metavar="SECONDS")
    c = sub.add_parser("compact", help="raw files to typed Parquet")
    c.add_argument("data_dir")
    c.add_argument("mode", choices=["file", "date", "all", "completed"])
    c.add_argument("target", nargs="?")
    c.add_argument("--dry-run", action="store_true")
    r = sub.add_parser("retain", help="delete raw files that are safely stored")
    r.add_argument("data_dir")
    r.add_argument("--min-age-days", type=float, default=retention.MIN_AGE_DAYS)
    r.add_argument("--delete", action="store_true", help="without it nothing is deleted")
    m = sub.add_parser("migrate", help="rewrite trades of the older layout")
    m.add_argument("source")
    m.add_argument("target")
    b = sub.add_parser("backfill", help="pull history over REST")
    b.add_argument("data_dir")
    b.add_argument("--discover", action="store_true", help="enumerate markets that have a history")
    b.add_argument("--pull", nargs="?", const="", metavar="PREFIX", help="pull the trades of all markets, or of those with a prefix")
    b.add_argument("--series", metavar="PREFIX", help="the series to discover, and the prefix to pull")
    b.add_argument("--status", action="store_true", help="say where all pulls stand")
    b.add_argument("--retry-failed", action="store_true", help="let failed markets wait again, then pull")
    b.add_argument("--dry-run", action="store_true", help="say what would be done")
    b.add_argument("--series-from-census", action="store_true", help="discover and pull the top series of the census")
    b.add_argument("--top-n", type=int, default=0, metavar="N", help="series of the census to take (0: all)")
    b.add_argument("--exclude", action="append", default=[], metavar="PREFIX", help="series of the census to leave out (repeatable)")
    b.add_argument("--include-parlay", action="store_true", help="don't leave the combined series out of the census")
    b.add_argument("--min-volume", type=float, default=0.0, metavar="V", help="least traded contracts of a market")
    b.add_argument("--parlay-top-n", type=int, metavar="N", help="pull the N combined markets of most volume, and their legs")
    b.add_argument("--parlay-scan-cap", type=int, default=50, metavar="PAGES", help="pages of each scope that are looked at for that")
    b.add_argument("--parlay-series", default="", metavar="SERIES", help="the series of combined markets")
    b.add_argument("--safety-margin-gb", type=float, metavar="GB", help="space that a pull must leave free")
    b.add_argument("--census-file", default="_census_rows.json", metavar="PATH")
    b.add_argument("--base-url", metavar="URL", help="the service (or TIDEMARK_BASE_URL)")
    s = sub.add_parser("space", help="exit 1 if less is free")
    s.add_argument("path")
    s.add_argument("least_gb", type=float)
    return p


def transport_of(base_url: str | None) -> Transport:
    """Signed requests to the service, with the key that the environment names."""
    c = config.load()
    url = base_url or c.base_url
    if not url:
        raise config.ConfigError("not set: TIDEMARK_BASE_URL")
    signer = Signer(c.key_id, None, pem_path=c.key_file)
    return http_transport(url, signer.headers)


def record(a: argparse.Namespace, spark: SparkSession) -> int:
    """The `record` command: lands the feed, says how it goes, and stops cleanly when asked to, or when disk or memory run low."""
    c = config.load()
    signer = Signer(c.key_id, None, pem_path=c.key_file)
    recorder = Recorder(websocket(a.url, signer.headers, urllib.parse.urlsplit(a.url).path), list(c.channels))
    ended = threading.Event()
    reasons: list[str] = []

    def stop(reason: str) -> None:
        reasons.append(reason)
        ended.set()

    seen = guards.Throughput([guards.disk_check(c.data_dir, c.min_free_gb), guards.memory_check()], stop, c.data_dir, c.min_free_gb)
    os.makedirs(c.data_dir, exist_ok=True)
    spark.streams.addListener(seen)
    spark.dataSource.register(feed_source(recorder))
    query = write_raw(spark.readStream.format("tick_feed").load(), c.raw_dir, f"{c.data_dir}/feed_checkpoint", list(c.prefixes), processingTime="5 seconds")
    before = {s: signal.signal(s, lambda *_: stop("told to")) for s in (signal.SIGINT, signal.SIGTERM)} if threading.current_thread() is threading.main_thread() else {}
    began = time.monotonic()
    try:
        while not ended.wait(min(a.report_every, a.seconds or a.report_every)):
            print(seen.report(), flush=True)
            if a.seconds and time.monotonic() - began >= a.seconds:
                stop("the time is up")
            if not query.isActive:
                stop("the stream ended")
        guards.drain(query)
    finally:
        for s, handler in before.items():
            signal.signal(s, handler)
        spark.streams.removeListener(seen)
    print(f"stopped: {reasons[0]}; {seen.report()}")
    return int(reasons[0] not in ("told to", "the time is up"))


def backfill(a: argparse.Namespace, spark: SparkSession) -> int:
    """The `backfill` command; 2 if it names nothing to do, 1 if there is nothing to pull from."""
    wants_pull = a.pull is not None or a.retry_failed
    if not (a.discover or wants_pull or a.status or a.series_from_census or a.parlay_top_n is not None):
        parser().parse_args(["backfill", "--help"])
    prefix = a.series if a.series is not None else a.pull or ""
    margin = a.safety_margin_gb if a.safety_margin_gb is not None else config.Config.min_free_gb
    state = StateStore(spark, f"{a.data_dir}/backfill_state")
    offline = a.dry_run and a.parlay_top_n is None or a.status and not (a.discover or wants_pull or a.series_from_census or a.parlay_top_n is not None)
    puller = Puller(spark, f"{a.data_dir}/parquet", state, None if offline else transport_of(a.base_url))
    if not offline:
        puller.keep_to_limits()
    if a.status:
        puller.status()
    if a.discover:
        series = [a.series] if a.series else None
        if a.dry_run:
            for name, *_ in puller._scopes(series, False):
                known = state.discovery(name)
                print(f"would crawl {name} ({'complete' if known and known['done'] else 'pending'})")
        else:
            print(f"{puller.discover(series)} markets discovered")
    if a.retry_failed and not a.dry_run:
        print(f"{state.reset_failed(prefix)} failed markets wait again")
    if wants_pull:
        if not state.count_markets():
            print("no markets are known; run --discover first", file=sys.stderr)
            return 1
        wanted = to_pull(state.table("markets"), prefix=prefix or None)
        if a.dry_run:
            print(f"would pull {wanted.count()} markets")
        else:
            puller.pull(wanted, f"markets with {prefix!r}" if prefix else "all markets")
    if a.series_from_census:
        puller.census(a.census_file, a.top_n, a.exclude, a.min_volume, margin, None if a.include_parlay else a.parlay_series or None, a.dry_run)
    if a.parlay_top_n is not None:
        puller.combined(a.parlay_series, a.parlay_top_n, a.parlay_scan_cap, margin, a.dry_run)
    return 0


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "space":
        print(f"{free_gb(a.path):.1f} GB free")
        return int(free_gb(a.path) < a.least_gb)
    spark = session()
    if a.command in ("backfill", "record"):
        return {"backfill": backfill, "record": record}[a.command](a, spark)
    if a.command == "migrate":
        print(migrate.migrate(spark, a.source, a.target))
        return 0
    compactor = ingest.Compactor(spark, f"{a.data_dir}/raw", f"{a.data_dir}/parquet")
    if a.command == "compact":
        files = raw_files(spark, compactor.raw_root, "all" if a.mode == "completed" else a.mode, a.target)
        files = completed(files) if a.mode == "completed" else files
        if a.dry_run:
            row = ingest.dry_run(ingest.pending(files, compactor.manifest())).first()
            print(f"{row['files']} files, {human_bytes(row['input_bytes'])} to about {human_bytes(row['est_output_bytes'])}")
            return 0
        result = compactor.run(files=files)
        for f in result.files:
            print(f"{f['path']}: {f['total_lines']} lines, {f['rejects']} refused, {human_bytes(f['size'])} to {human_bytes(f['output_bytes'])}" + ("" if f["reconciled"] else ", DOESN'T ADD UP"))
        x = result.summary
        print(f"{x['files']} files, {x['rows']} rows, {x['rejects']} refused ({x['reject_percent']:.4f} %), {human_bytes(x['input_bytes'])} to {human_bytes(x['output_bytes'])} (ratio {x['ratio']:.3f}), {x['mismatched']} don't add up")
        return int(not result.reconciled)
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{a.data_dir}/parquet").select("path")
    outputs = stored.selectExpr("regexp_extract(path, 'type=([^/]+)', 1) AS type", "regexp_extract(path, 'date=([^/]+)', 1) AS date", "regexp_extract(path, 'part=([^/]+)', 1) AS part").distinct()
    assessed = retention.assess(with_partition(raw_files(spark, compactor.raw_root)), compactor.manifest(), outputs, min_age_days=a.min_age_days)
    for path in retention.delete(spark, assessed, dry_run=not a.delete):
        print(("deleted " if a.delete else "would delete ") + path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
