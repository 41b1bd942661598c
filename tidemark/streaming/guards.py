"""Watching streams: throughput, projected runtime, and a stop when disk or memory run low."""

from __future__ import annotations

import shutil
import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener

MAX_RSS_MB = 400.0


def free_gb(path: str) -> float:
    return shutil.disk_usage(path).free / 1e9


def rss_mb() -> float:
    """This process' resident memory."""
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


def hours_left(free: float, margin_gb: float, gb_per_hour: float) -> float | None:
    """Hours until only the margin is free; None if nothing is written."""
    return max(0.0, free - margin_gb) / gb_per_hour if gb_per_hour > 0 else None


class Throughput(StreamingQueryListener):
    """Rows and batches of all queries, how long the disk lasts at the pace so far, and reasons to stop them after a batch."""

    def __init__(self, checks: list[Callable[[], str | None]] | None = None, stop: Callable[[str], None] | None = None, path: str | None = None, margin_gb: float = 0.0, clock: Callable[[], float] = time.monotonic):
        self.rows = self.batches = 0
        self.rate = 0.0
        self.checks, self.stop, self.path, self.margin_gb, self.clock = checks or [], stop, path, margin_gb, clock
        self.began, self.free_at_first = clock(), free_gb(path) if path else 0.0

    @property
    def gb_per_hour(self) -> float:
        """What has been written since the start, by the space that is gone."""
        hours = (self.clock() - self.began) / 3600
        return max(0.0, self.free_at_first - free_gb(self.path)) / hours if self.path and hours > 0 else 0.0

    @property
    def hours_left(self) -> float | None:
        """Hours until only the margin is free, at the pace so far; None if nothing is written."""
        return hours_left(free_gb(self.path), self.margin_gb, self.gb_per_hour) if self.path else None

    def report(self) -> str:
        left = self.hours_left
        return f"{self.rows} rows in {self.batches} batches, {self.rate:.1f} rows/s, {self.gb_per_hour:.3f} GB/h, " + ("space for any time" if left is None else f"space for {left:.1f} h")

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        self.rows += event.progress.numInputRows
        self.batches += 1
        self.rate = event.progress.processedRowsPerSecond or 0.0
        for check in self.checks:
            if (reason := check()) and self.stop:
                self.stop(reason)

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass


def disk_check(path: str, least_gb: float) -> Callable[[], str | None]:
    return lambda: f"less than {least_gb} GB are free" if free_gb(path) < least_gb else None


def memory_check(most_mb: float = MAX_RSS_MB) -> Callable[[], str | None]:
    return lambda: f"more than {most_mb} MB are resident" if rss_mb() > most_mb else None


def drain(query: StreamingQuery) -> None:
    """Stop a query after what it has read is written."""
    query.processAllAvailable()
    query.stop()
