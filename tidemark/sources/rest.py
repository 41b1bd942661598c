"""Paged REST sources over any transport: chains of pages, dealt to tasks that share one request rate."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from email.utils import parsedate_to_datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

PAGE_LIMIT = 1000
LOOKUP_CHUNK = 100
RETRIES, LONGEST_WAIT_S = 8, 60.0
#: The share of the account's limits that pulls use.
LIMITS_SHARE = 0.5
TRADE_FIELDS = "created_time string, trade_id string, yes_price_dollars string, no_price_dollars string, count_fp string, taker_side string, taker_outcome_side string, taker_book_side string, is_block_trade boolean"

#: Path and parameters to (status, headers, parsed body).
Transport = Callable[[str, dict], tuple[int, dict, dict]]


class BackfillError(RuntimeError):
    """A request that failed for good, or a page that doesn't advance."""


class TokenBucket:
    """At most `rate` tokens a second, `capacity` at once."""

    def __init__(self, rate: float, capacity: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.capacity, self.clock, self.sleep = rate, capacity, clock, sleep
        self.tokens, self.at = capacity, clock()

    def acquire(self, n: float = 1.0) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.capacity, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < n:
            self.sleep((n - self.tokens) / self.rate)
            self.at, self.tokens = self.clock(), n
        self.tokens -= n


def retry_after_s(value: str | None, now: Callable[[], float] = time.time) -> float | None:
    """What a Retry-After header says, in seconds: a number or a date; None for anything else."""
    if not value:
        return None
    try:
        seconds = float(value)
    except ValueError:
        try:
            seconds = parsedate_to_datetime(value).timestamp() - now()
        except ValueError:
            return None
    return max(0.0, seconds) if math.isfinite(seconds) else None


def backoff_s(attempt: int, retry_after: float | None = None, jitter: Callable[[], float] = random.random) -> float:
    """Seconds to wait: what the server says, or twice as long each time."""
    return min(LONGEST_WAIT_S, retry_after) if retry_after is not None else min(LONGEST_WAIT_S, 0.5 * 2**attempt) * (0.5 + 0.5 * jitter())


@dataclass
class Client:
    """Requests with pacing and retries."""

    transport: Transport
    bucket: TokenBucket | None = None
    sleep: Callable[[float], None] = time.sleep
    requests: int = 0

    def get(self, path: str, params: dict) -> dict:
        for attempt in range(RETRIES + 1):
            if self.bucket:
                self.bucket.acquire()
            self.requests += 1
            status, headers, body = self.transport(path, params)
            if status == 200:
                if not isinstance(body, dict):
                    raise BackfillError(f"{path}: no JSON object")
                return body
            if status != 429 and status < 500:
                break
            self.sleep(backoff_s(attempt, retry_after_s(headers.get("Retry-After"))))
        raise BackfillError(f"{path}: status {status}")

    def pages(self, path: str, params: dict, key: str, cursor: str | None = None, most: int | None = None) -> Iterator[tuple[int, str, list[dict]]]:
        """(page, next cursor, records) to the end or for `most` pages; a cursor that doesn't advance is an error."""
        page = 0
        while most is None or page < most:
            body = self.get(path, params | ({"cursor": cursor} if cursor else {}))
            page, after = page + 1, body.get("cursor") or ""
            yield page, after, body.get(key) or []
            if not after:
                return
            if after == cursor:
                raise BackfillError(f"{path}: the cursor {cursor!r} doesn't advance")
            cursor = after

    def volumes(self, tickers: list[str]) -> dict[str, str]:
        """Volumes of markets by chunks; unknown markets are absent."""
        out = {}
        for i in range(0, len(tickers), LOOKUP_CHUNK):
            body = self.get("/markets", {"tickers": ",".join(tickers[i : i + LOOKUP_CHUNK])})
            out |= {m["ticker"]: m.get("volume_fp") for m in body.get("markets") or []}
        return out


def limits(client: Client) -> tuple[float, float]:
    """Requests a second and at once that pulls may use: a share of the account's read limits."""
    read = client.get("/account/limits", {})["read"]
    return LIMITS_SHARE * read["refill_rate"], LIMITS_SHARE * read["bucket_capacity"]


@dataclass(frozen=True)
class Chain:
    """Pages that follow each other: where they are, the key of their records, and where to go on."""

    name: str
    path: str
    params: dict
    key: str
    cursor: str | None = None
    page: int = 0


PAGES = "chain string, page int, cursor string, record string, requests int, error string"


@dataclass
class _Share(InputPartition):
    chains: tuple[Chain, ...]


class _PageReader(DataSourceReader):
    def __init__(self, transport: Transport, chains: list[Chain], shares: int, most_pages: int | None, rate: float | None, capacity: float):
        self.transport, self.chains, self.shares, self.most_pages, self.rate, self.capacity = transport, chains, max(1, min(shares, len(chains))), most_pages, rate, capacity

    def partitions(self) -> list[InputPartition]:
        return [_Share(tuple(self.chains[i :: self.shares])) for i in range(self.shares)] if self.chains else [_Share(())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        # all tasks at once keep to the rate: each has its share of it
        client = Client(self.transport, TokenBucket(self.rate / self.shares, max(1.0, self.capacity / self.shares)) if self.rate else None)
        for c in partition.chains:
            before = client.requests
            try:
                for page, cursor, records in client.pages(c.path, c.params, c.key, c.cursor, self.most_pages):
                    # a row for the page itself, then one for each record
                    yield c.name, c.page + page - 1, cursor, None, client.requests - before, None
                    before = client.requests
                    for r in records:
                        yield c.name, c.page + page - 1, None, json.dumps(r), 0, None
            except Exception as e:  # one chain's failure doesn't end the others
                yield c.name, None, None, None, client.requests - before, repr(e)


def page_source(transport: Transport) -> type[DataSource]:
    """A data source `tick_pages` over a transport. Options: `chains` (JSON), `shares` (tasks), `max_pages` of a chain, `rate` and `capacity` of all requests."""

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tick_pages"

        def schema(self) -> str:
            return PAGES

        def reader(self, schema: StructType) -> DataSourceReader:
            o = self.options
            return _PageReader(transport, [Chain(**c) for c in json.loads(o["chains"])], int(o.get("shares", "1")), int(o["max_pages"]) if o.get("max_pages") else None, float(o["rate"]) if o.get("rate") else None, float(o.get("capacity", "1")))

    return Pages


def read_pages(spark: SparkSession, transport: Transport, chains: list[Chain], shares: int | None = None, max_pages: int | None = None, rate: float | None = None, capacity: float = 1.0) -> DataFrame:
    """`PAGES` of some chains: for each page a row with the cursor of the next one, and a row per record (JSON); a chain that fails ends with a row that says why."""
    spark.dataSource.register(page_source(transport))
    options = {"chains": json.dumps([asdict(c) for c in chains]), "shares": str(shares or spark.sparkContext.defaultParallelism), "capacity": str(capacity)}
    options |= ({"max_pages": str(max_pages)} if max_pages else {}) | ({"rate": str(rate)} if rate else {})
    return spark.read.format("tick_pages").options(**options).load()


def trades_chain(ticker: str, cursor: str | None = None, page: int = 0) -> Chain:
    return Chain(ticker, "/markets/trades", {"ticker": ticker, "limit": PAGE_LIMIT}, "trades", cursor, page)


def markets_chain(name: str, status: str, series: str | None = None, cursor: str | None = None, page: int = 0) -> Chain:
    return Chain(name, "/markets", {"limit": PAGE_LIMIT, "status": status, **({"series_ticker": series} if series else {})}, "markets", cursor, page)


def lookup_chains(tickers: list[str]) -> list[Chain]:
    """Markets by their tickers, some in each request."""
    return [Chain(f"lookup {i}", "/markets", {"tickers": ",".join(tickers[i : i + LOOKUP_CHUNK])}, "markets") for i in range(0, len(tickers), LOOKUP_CHUNK)]


def read_trades(spark: SparkSession, transport: Transport, tickers: list[str], **options) -> DataFrame:
    """REST trades of markets, a column per field."""
    pages = read_pages(spark, transport, [trades_chain(t) for t in tickers], **options)
    return trade_columns(pages)


def trade_columns(pages: DataFrame) -> DataFrame:
    """(ticker, page, and a column per field of a trade) from `PAGES` of trades."""
    fields = F.from_json("record", TRADE_FIELDS)
    return pages.filter("record is not null").select(F.col("chain").alias("ticker"), "page", fields.alias("t")).select("ticker", "page", "t.*")


def http_transport(base_url: str, headers: Callable[[str, str], dict] | None = None) -> Transport:
    """A transport over HTTPS; `headers` signs a method and path."""
    import urllib.error
    import urllib.parse
    import urllib.request

    def call(path: str, params: dict) -> tuple[int, dict, dict]:
        url = f"{base_url}{path}?{urllib.parse.urlencode(params)}"
        request = urllib.request.Request(url, headers=headers("GET", path) if headers else {})
        try:
            with urllib.request.urlopen(request, timeout=30) as response:
                return response.status, dict(response.headers), json.load(response)
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), {}

    return call
