"""The state of history pulls on plain Parquet: each change writes a whole new version, and readers take the newest complete one."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.backfill import DEFAULT_REQUESTS_S, MARKETS, merge_state, record_page, reset_failed, seed, set_failed, status_summary

DISCOVERY = "scope string, cursor string, pages long, done boolean, updated double"
META = "key string, value string"
TABLES = {"markets": MARKETS, "discovery": DISCOVERY, "meta": META}
#: Versions kept behind the newest, for readers that still use them.
KEPT = 2


class StateStore:
    """Markets, discovery scopes and settings of one writer, below `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _versions(self, table: str) -> list[int]:
        """Complete versions (a commit leaves `_SUCCESS`), oldest first."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/v=*/_SUCCESS")) or []
        return sorted(int(f.getPath().getParent().getName()[2:]) for f in found)

    def table(self, name: str) -> DataFrame:
        versions = self._versions(name)
        if not versions:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{name}/v={versions[-1]}")

    def put(self, name: str, rows: DataFrame) -> None:
        """Make `rows` the newest version."""
        versions = self._versions(name)
        columns = [F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in TABLES[name].split(", ")]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{name}/v={(versions[-1] if versions else 0) + 1}")
        jvm = self.spark.sparkContext._jvm
        for old in versions[:-KEPT]:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/v={old}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    # markets
    def seed(self, markets: DataFrame) -> None:
        """Add markets (ticker, volume_fp); of known ones only the volume changes."""
        self.put("markets", seed(self.table("markets"), markets, time.time()))

    def record_page(self, ticker: str, cursor: str | None, rows: int, last: bool) -> None:
        self.put("markets", record_page(self.table("markets"), ticker, cursor, rows, last, time.time()))

    def reset_failed(self, prefix: str) -> int:
        """Failed markets of a prefix wait again; returns how many."""
        before = self.table("markets")
        after = reset_failed(before, prefix)
        n = before.filter("status = 'failed'").count() - after.filter("status = 'failed'").count()
        self.put("markets", after)
        return n

    def set_failed(self, ticker: str, reason: str) -> None:
        self.put("markets", set_failed(self.table("markets"), ticker, reason, time.time()))

    def merge(self, changes: DataFrame) -> None:
        """Many changes at once, as a distributed pull reports them."""
        self.put("markets", merge_state(self.table("markets"), changes))

    def get(self, ticker: str) -> dict | None:
        row = self.table("markets").filter(F.col("ticker") == ticker).first()
        return row.asDict() if row else None

    def count_markets(self) -> int:
        return self.table("markets").count()

    def summary(self) -> DataFrame:
        return status_summary(self.table("markets"))

    # discovery and settings
    def _upsert(self, name: str, key: str, row: tuple) -> None:
        rest = self.table(name).filter(F.col(key) != row[0])
        self.put(name, rest.unionByName(self.spark.createDataFrame([row], TABLES[name])))

    def discovery(self, scope: str) -> dict | None:
        row = self.table("discovery").filter(F.col("scope") == scope).first()
        return row.asDict() if row else None

    def set_discoveries(self, rows: list[tuple]) -> None:
        """Many scopes (rows of `DISCOVERY`) in one step."""
        if rows:
            new = self.spark.createDataFrame(rows, DISCOVERY)
            self.put("discovery", self.table("discovery").join(new.select("scope"), "scope", "left_anti").unionByName(new))

    def set_discovery(self, scope: str, cursor: str | None, pages: int, done: bool) -> None:
        self._upsert("discovery", "scope", (scope, cursor, pages, done, time.time()))

    def meta(self, key: str) -> str | None:
        row = self.table("meta").filter(F.col("key") == key).first()
        return row["value"] if row else None

    def set_meta(self, key: str, value: str) -> None:
        self._upsert("meta", "key", (key, value))

    def requests_s(self) -> tuple[float, bool]:
        """The observed request rate and True, or the assumed one and False."""
        try:
            rate = float(self.meta("requests_s") or "")
        except ValueError:
            rate = 0.0
        return (rate, True) if rate > 0 else (DEFAULT_REQUESTS_S, False)
