"""The query catalogue: every operator over the supplied tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import ns_to_date, ns_to_hour, timestamp_to_ns, to_ns
from tidemark.functions.scaled import parse_scaled, unscale, volume_or_zero
from tidemark.functions.text import legs_of, series_of
from tidemark.operators import backfill as B
from tidemark.operators import ingest as I
from tidemark.operators import reader as R
from tidemark.operators import retention as T
from tidemark.operators.migrate import report, with_source
from tidemark.operators.pull import Puller
from tidemark.operators.state import StateStore
from tidemark.session import prepare
from tidemark.sources.raw import LAYOUT, completed, land, raw_files, raw_lines, with_partition
from tidemark.sources.socket import LOST, MADE, feed_source
from tidemark.sources.store import exists, scratch, write_parts
from tidemark.streaming import ingest as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
START, END = "2024-01-05T00:00:00", "2024-01-20T00:00:00"
LOW, HIGH = to_ns(START), to_ns(END)
NOW = datetime(2024, 1, 20, 12, 0, tzinfo=UTC)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its SQL."""

    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: f(prepare(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return f

    return add


# --- views over `events` --------------------------------------------------------------------


def ticks(spark: SparkSession, sf_dir: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Events as quotes: the stored columns that the queries read. Bounds (epoch ns) go to the scan."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    if low is not None:
        moment = lambda ns: F.lit(datetime.fromtimestamp(ns // 10**9, UTC).replace(tzinfo=None))
        e = e.filter(F.col("ts").between(moment(low).cast("timestamp_ntz"), moment(high).cast("timestamp_ntz")))
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.col("event_id").alias("ts_ns"),
        timestamp_to_ns(F.col("ts")).alias("ts_wall"),
        F.concat(F.upper("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("market_ticker"),
        F.round(F.col("value") * 10000).cast("bigint").alias("price_dollars"),
        (k * 100).alias("volume_fp"),
    )


def trades(spark: SparkSession, sf_dir: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Events as trades: live ones, backfilled ones (stamped 0.2 s earlier), and some in both copies."""
    t = ticks(spark, sf_dir, low, high and high + 10**9).select(F.col("ts_ns").alias("trade_id"), "market_ticker", F.col("price_dollars").alias("yes_price_dollars"), F.col("volume_fp").alias("count_fp"), "ts_wall")
    live = t.filter("trade_id % 10 < 7").withColumns({"ts_ns": F.col("trade_id"), "source": F.lit("live")})
    pulled = t.filter("trade_id % 10 >= 4").withColumns({"ts_wall": F.col("ts_wall") - 200_000_000, "ts_ns": F.lit(None).cast("bigint"), "source": F.lit("backfill")})
    return live.unionByName(pulled)


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silences of over half an hour between events."""
    return S.silences(ticks(spark, sf_dir).select("ts_wall"), 1_800_000_000_000)


_TICKS = """e AS (SELECT event_id, upper(event_type) || '-' || CAST(user_id AS VARCHAR) AS market_ticker, CAST(round(value * 10000) AS BIGINT) AS price_s,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 AS qty_fp, epoch_ns(ts) AS w FROM events)"""
_TRADES = f"""{_TICKS}, t AS (SELECT event_id AS trade_id, market_ticker, price_s, qty_fp, w AS ts_wall, event_id AS ts_ns, 'live' AS source FROM e WHERE event_id % 10 < 7
    UNION ALL SELECT event_id, market_ticker, price_s, qty_fp, w - 200000000, NULL, 'backfill' FROM e WHERE event_id % 10 >= 4)"""
_GAPS = """g AS (SELECT a AS gap_start_wall, w AS gap_end_wall FROM (SELECT w, lag(w) OVER (ORDER BY w) AS a FROM (SELECT epoch_ns(ts) AS w FROM events)) WHERE w - a > 1800000000000)"""
_PRICE = "CAST(CAST(price_s AS DECIMAL(19,0)) * 0.0001 AS DECIMAL(19,4))"
_COUNT = "CAST(CAST(qty_fp AS DECIMAL(19,0)) * 0.01 AS DECIMAL(19,2))"
_IN = f"ts_wall BETWEEN {LOW} AND {HIGH}"
_TRADE_OUT = f"SELECT trade_id, market_ticker, {_PRICE} AS yes_price, {_COUNT} AS count, ts_wall, ts_ns, source FROM t"
_FIRST = "QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY (source = 'live') DESC, ts_wall, ts_ns NULLS LAST) = 1"

_SHOWN = [R.Out("trade_id", "trade_id"), R.Out("market_ticker", "market_ticker"), R.Out("yes_price", "yes_price_dollars", "decimal"), R.Out("count", "count_fp", "decimal"), R.Out("ts_wall", "ts_wall"), R.Out("ts_ns", "ts_ns"), R.Out("source", "source")]
_SCALES = {"yes_price_dollars": 10_000, "count_fp": 100, "price_dollars": 10_000, "volume_fp": 100}


def _trades(spark: SparkSession, sf_dir: str, prefix: str, source: str | None = None, raw: bool = False) -> DataFrame:
    rows = trades(spark, sf_dir, LOW, HIGH).filter(F.col("ts_wall").between(LOW, HIGH) & F.col("market_ticker").startswith(prefix))
    rows = rows.filter(F.col("source") == source) if source else rows
    return R.project(R.in_time_order(rows if raw else R.dedup_trades(rows)), _SHOWN, _SCALES)


@query("trades_dedup", f"WITH {_TRADES} {_TRADE_OUT} WHERE {_IN} AND starts_with(market_ticker, 'C') {_FIRST}")
def trades_dedup(spark, sf_dir):
    return _trades(spark, sf_dir, "C")


@query("trades_all", f"WITH {_TRADES} {_TRADE_OUT} WHERE {_IN} {_FIRST}")
def trades_all(spark, sf_dir):
    return _trades(spark, sf_dir, "")


@query("trades_raw", f"WITH {_TRADES} {_TRADE_OUT} WHERE {_IN} AND starts_with(market_ticker, 'V')")
def trades_raw(spark, sf_dir):
    return _trades(spark, sf_dir, "V", raw=True)


@query("trades_live", f"WITH {_TRADES} {_TRADE_OUT} WHERE {_IN} AND source = 'live' {_FIRST}")
def trades_live(spark, sf_dir):
    return _trades(spark, sf_dir, "", "live")


@query("trades_backfill", f"WITH {_TRADES} {_TRADE_OUT} WHERE {_IN} AND source = 'backfill' {_FIRST}")
def trades_backfill(spark, sf_dir):
    return _trades(spark, sf_dir, "", "backfill")


@query("price_series", f"WITH {_TICKS} SELECT w AS ts_wall, event_id AS ts_ns, market_ticker, {_PRICE} AS price, {_COUNT} AS volume FROM e WHERE w BETWEEN {LOW} AND {HIGH} AND market_ticker = 'CLICK-7'")
def price_series(spark, sf_dir):
    rows = ticks(spark, sf_dir, LOW, HIGH).filter(F.col("ts_wall").between(LOW, HIGH) & (F.col("market_ticker") == "CLICK-7"))
    return R.project(R.in_time_order(rows), [R.Out("ts_wall", "ts_wall"), R.Out("ts_ns", "ts_ns"), R.Out("market_ticker", "market_ticker"), R.Out("price", "price_dollars", "decimal"), R.Out("volume", "volume_fp", "decimal")], _SCALES)


@query("list_tickers", f"WITH {_TICKS} SELECT DISTINCT market_ticker FROM e WHERE w BETWEEN {LOW} AND {HIGH}")
def list_tickers(spark, sf_dir):
    return ticks(spark, sf_dir, LOW, HIGH).filter(F.col("ts_wall").between(LOW, HIGH)).select("market_ticker").distinct().orderBy("market_ticker")


@query("list_tickers_prefix", f"WITH {_TICKS} SELECT DISTINCT market_ticker FROM e WHERE w BETWEEN {LOW} AND {HIGH} AND starts_with(market_ticker, 'PUR')")
def list_tickers_prefix(spark, sf_dir):
    return list_tickers(spark, sf_dir).filter(F.col("market_ticker").startswith("PUR"))


@query("coverage_overlap", f"WITH {_GAPS} SELECT gap_start_wall, gap_end_wall FROM g WHERE gap_start_wall <= {HIGH} AND gap_end_wall >= {LOW}")
def coverage_overlap(spark, sf_dir):
    return gaps(spark, sf_dir).filter(R.overlaps("gap_start_wall", "gap_end_wall", LOW, HIGH)).orderBy("gap_start_wall")


@query(
    "trades_near_gaps",
    f"WITH {_TRADES}, {_GAPS} SELECT trade_id, source, gap_start_wall FROM t JOIN g ON ts_wall BETWEEN gap_start_wall - 60000000000 AND gap_end_wall + 60000000000",
)
def trades_near_gaps(spark, sf_dir):
    """Trades within a minute of an outage: an interval join on hour buckets, each gap in every bucket that it touches."""
    bucket, margin = 3_600_000_000_000, 60_000_000_000
    low, high = F.col("gap_start_wall") - margin, F.col("gap_end_wall") + margin
    cells = gaps(spark, sf_dir).withColumns({"low": low, "high": high}).withColumn("bucket", F.explode(F.expr(f"sequence(low div {bucket}, high div {bucket})")))
    rows = trades(spark, sf_dir).withColumn("bucket", F.expr(f"ts_wall div {bucket}"))
    return rows.join(cells, "bucket").filter("ts_wall between low and high").select("trade_id", "source", "gap_start_wall")


@query("partition_keys", f"WITH {_TICKS} SELECT event_id, w AS ts_wall, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour FROM e JOIN (SELECT event_id, ts FROM events) USING (event_id)")
def partition_keys(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.select(F.col("ts_ns").alias("event_id"), "ts_wall", ns_to_date(F.col("ts_wall")).cast("string").alias("date"), ns_to_hour(F.col("ts_wall")).alias("hour"))


_CASES = ["0.6700", "1.", ".5", "-3", "1e3", "0.12345", " 2.00 ", "-0.0030", "", "+1", "12.3456", "abc", "99999999999999999999", "922337203685477.5807", "--1", "0"]


@query(
    "parse_scaled_cases",
    "SELECT v, CASE WHEN regexp_full_match(trim(v), '-?[0-9]+(\\.[0-9]{0,4})?') THEN TRY_CAST(TRY_CAST(rtrim(trim(v), '.') AS DECIMAL(38,4)) * 10000 AS BIGINT) END AS scaled FROM (VALUES "
    + ", ".join(f"('{c}')" for c in _CASES)
    + ") x(v)",
)
def parse_scaled_cases(spark, sf_dir):
    return spark.createDataFrame([(c,) for c in _CASES], "v string").select("v", parse_scaled(F.col("v"), 4).alias("scaled"))


@query("unscale", f"WITH {_TICKS} SELECT event_id, {_PRICE} AS price, {_COUNT} AS count FROM e")
def unscaled(spark, sf_dir):
    return ticks(spark, sf_dir).select(F.col("ts_ns").alias("event_id"), unscale(F.col("price_dollars"), 10_000).alias("price"), unscale(F.col("volume_fp"), 100).alias("count"))


# --- ingest ---------------------------------------------------------------------------------

_OUTCOMES = ["trade", "ticker", "subscribed", "gap", "bad_outer_json", "bad_outer_json", "missing_field", "bad_inner_json", "unhandled_type", "schema_violation", "schema_violation", "unhandled_type"]


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line per event, of twelve forms in turn, from a table that is written once."""
    return spark.read.parquet(_once(spark, sf_dir, "lines", lambda root: _log_lines(spark, sf_dir).write.parquet(root)))


_MADE: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], object]) -> str:
    """The folder of a store that `make` fills, once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MADE or not exists(spark, _MADE[key]):
        root = scratch(spark)
        make(root)
        _MADE[key] = root  # only now: what a stopped run left is not read
    return _MADE[key]


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "user_id", "value", timestamp_to_ns(F.col("ts")).alias("w"))
    two, four = (lambda c, d=d: F.format_string(f"%.{d}f", c) for d in (2, 4))
    msg_trade = F.to_json(F.struct(F.lit("trade").alias("type"), F.lit(1).alias("sid"), F.col("event_id").alias("seq"), F.struct(
        F.col("event_id").cast("string").alias("trade_id"), F.col("event_type").alias("market_ticker"), four(F.col("value")).alias("yes_price_dollars"), F.lit("0.1").alias("no_price_dollars"), two(F.col("value")).alias("count_fp"),
        *[F.lit("yes").alias(c) for c in ("taker_side", "taker_outcome_side", "taker_book_side")], F.lit(False).alias("is_block_trade"), F.lit(1).alias("ts"), F.lit(1000).alias("ts_ms")).alias("msg")))
    msg_tick = F.to_json(F.struct(F.lit("ticker").alias("type"), F.lit(1).alias("sid"), F.struct(
        F.col("event_type").alias("market_ticker"), F.lit("m").alias("market_id"), *[four(F.col("value")).alias(c) for c in ("price_dollars", "yes_bid_dollars", "yes_ask_dollars")],
        *[F.lit("1.00").alias(c) for c in ("yes_bid_size_fp", "yes_ask_size_fp", "last_trade_size_fp", "volume_fp", "open_interest_fp")], *[F.lit(1).alias(c) for c in ("dollar_volume", "dollar_open_interest", "ts", "ts_ms")], F.lit("t").alias("time")).alias("msg")))
    msg_sub = F.lit('{"type":"subscribed","id":1,"msg":{"channel":"trade","sid":2}}')
    clock = [F.col("event_id").alias("ts_ns"), F.col("w").alias("ts_wall")]
    sent = lambda raw: F.to_json(F.struct(*clock, raw.alias("raw")))
    forms = [
        sent(msg_trade), sent(msg_tick), sent(msg_sub),
        F.to_json(F.struct(*clock, F.lit("gap").alias("marker"), *[F.lit(i).alias(c) for i, c in enumerate(("gap_start_ns", "gap_start_wall", "gap_end_ns", "gap_end_wall"))])),
        F.lit("{not json"), F.lit("[1, 2]"), F.to_json(F.struct(*clock)), sent(F.lit("{oops")), sent(F.lit('{"type":"other"}')),
        sent(F.regexp_replace(msg_trade, '"seq":[0-9]+', '"seq":5.0')), sent(F.regexp_replace(msg_tick, '"price_dollars":"[^"]*"', '"price_dollars":0.5')), sent(F.lit("[]")),
    ]
    line = F.element_at(F.array(*forms), (F.col("event_id") % len(forms) + 1).cast("int"))
    path = F.concat(F.lit("raw/2024-01-01/"), F.lpad((F.col("user_id") % 24).cast("string"), 2, "0"), F.lit(".ndjson.zst"))
    return e.select("event_id", path.alias("path"), F.col("event_id").alias("line_number"), line.alias("line"))


_OUTCOME_SQL = "CASE event_id % 12 " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(_OUTCOMES)) + " END"


@query("classify_lines", f"SELECT event_id, CASE WHEN event_id % 12 < 4 THEN {_OUTCOME_SQL} END AS type, CASE WHEN event_id % 12 >= 4 THEN {_OUTCOME_SQL} END AS reason FROM events")
def classify_lines(spark, sf_dir):
    return I.classify(log_lines(spark, sf_dir)).select("event_id", "type", "reason")


@query("typed_trades", f"WITH {_TICKS} SELECT event_id AS seq, split_part(market_ticker, '-', 1) AS market_ticker, price_s AS yes_price_dollars, w AS ts_wall FROM e WHERE event_id % 12 = 0")
def typed_trades(spark, sf_dir):
    from tidemark.plans.datasets import DATASETS

    return I.rows_of(I.classify(log_lines(spark, sf_dir)), DATASETS["trade"]).select("seq", F.upper("market_ticker").alias("market_ticker"), "yes_price_dollars", "ts_wall")


@query(
    "reconcile",
    "SELECT 'raw/2024-01-01/' || lpad(CAST(user_id % 24 AS VARCHAR), 2, '0') || '.ndjson.zst' AS path, count(*) AS total_lines, count(*) FILTER (event_id % 12 = 1) AS n_ticker, count(*) FILTER (event_id % 12 = 0) AS n_trade,"
    " count(*) FILTER (event_id % 12 = 2) AS n_subscribed, count(*) FILTER (event_id % 12 = 3) AS n_gap, count(*) FILTER (event_id % 12 >= 4) AS rejects, true AS reconciled FROM events GROUP BY 1",
)
def reconcile(spark, sf_dir):
    raw, out = _log_store(spark, sf_dir)
    lines = I.line_counts(raw_lines(spark, raw))
    todo = [r.asDict() for r in raw_files(spark, raw).collect()]  # 24 files
    found = I.reconcile(lines, I.Compactor(spark, raw, out).stored(todo))
    return found.withColumn("path", _log_path(F.col("path")))


def _log_store(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Raw files of the log lines, and where they are compacted to."""

    def make(root: str) -> None:
        lines = log_lines(spark, sf_dir).select(F.lit("2024-01-01").alias("date"), F.regexp_extract("path", LAYOUT, 3).alias("hour"), "line", F.col("event_id").alias("at"))
        land(lines, f"{root}/raw")
        I.Compactor(spark, f"{root}/raw", f"{root}/out").run()

    root = _once(spark, sf_dir, "logs", make)
    return f"{root}/raw", f"{root}/out"


def _log_path(path: Column) -> Column:
    return F.regexp_replace(path, r"^.*/raw/(.*)\.gz$", "raw/$1.zst")


_LOG_SQL = f"""l AS (SELECT 'raw/2024-01-01/' || lpad(CAST(user_id % 24 AS VARCHAR), 2, '0') || '.ndjson.zst' AS path, event_id,
    row_number() OVER (PARTITION BY user_id % 24 ORDER BY event_id) AS line_number, {_OUTCOME_SQL} AS outcome FROM events)"""


@query("stored_rejects", f"WITH {_LOG_SQL} SELECT path, line_number, outcome AS reason FROM l WHERE event_id % 12 >= 4")
def stored_rejects(spark, sf_dir):
    rows = spark.read.schema("source string, line_number long, reason string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{_log_store(spark, sf_dir)[1]}/rejects")
    return rows.select(_log_path(F.col("source")).alias("path"), "line_number", "reason")


@query(
    "stored_manifest",
    f"WITH {_LOG_SQL} SELECT path, count(*) AS total_lines, count(*) FILTER (outcome = 'trade') AS trades, count(*) FILTER (outcome = 'gap') AS gaps, count(*) FILTER (event_id % 12 >= 4) AS rejects FROM l GROUP BY path",
)
def stored_manifest(spark, sf_dir):
    m = I.Compactor(spark, *_log_store(spark, sf_dir)).manifest()
    return m.select(_log_path(F.col("path")).alias("path"), "total_lines", F.col("rows_by_type")["trade"].alias("trades"), F.col("rows_by_type")["gap"].alias("gaps"), "rejects")


# --- stored partitions: compacted, streamed and pulled trades, read as one --------------------

_SPLIT = "2024-01-15"


def market_store(spark: SparkSession, sf_dir: str) -> str:
    """A store of the events: live messages compacted (to the middle of the month) or streamed (after it), and backfilled trades as pages."""

    def make(root: str) -> None:
        e = spark.read.parquet(f"{sf_dir}/events.parquet")
        k = F.get_json_object("props", "$.k")
        t = e.select("event_id", timestamp_to_ns(F.col("ts")).alias("w"), F.concat(F.upper("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("market_ticker"), F.format_string("%.4f", F.col("value")).alias("price"), F.concat(k, F.lit(".00")).alias("count"))
        one = F.lit("1.00")
        tick = F.struct("market_ticker", F.lit("m").alias("market_id"), *[F.col("price").alias(c) for c in ("price_dollars", "yes_bid_dollars", "yes_ask_dollars")], *[one.alias(c) for c in ("yes_bid_size_fp", "yes_ask_size_fp", "last_trade_size_fp")],
                        F.col("count").alias("volume_fp"), one.alias("open_interest_fp"), *[F.lit(1).alias(c) for c in ("dollar_volume", "dollar_open_interest", "ts", "ts_ms")], F.lit("t").alias("time"))
        trade = F.struct(F.col("event_id").cast("string").alias("trade_id"), "market_ticker", F.col("price").alias("yes_price_dollars"), F.lit("0.5").alias("no_price_dollars"), F.col("count").alias("count_fp"),
                         *[F.lit("yes").alias(c) for c in ("taker_side", "taker_outcome_side", "taker_book_side")], F.lit(False).alias("is_block_trade"), F.lit(1).alias("ts"), F.lit(1000).alias("ts_ms"))
        clock = [F.col("event_id").alias("ts_ns"), F.col("w").alias("ts_wall")]
        sent = lambda kind, seq, msg: F.to_json(F.struct(*clock, F.to_json(F.struct(F.lit(kind).alias("type"), F.lit(1).alias("sid"), *seq, msg.alias("msg"))).alias("raw")))
        live = t.select("w", sent("ticker", [], tick).alias("line")).unionByName(t.filter("event_id % 10 < 7").select("w", sent("trade", [F.col("event_id").alias("seq")], trade).alias("line")))
        ends = [F.lit(i).alias(c) if c.endswith("_ns") else F.col(c) for i, c in enumerate(("gap_start_ns", "gap_start_wall", "gap_end_ns", "gap_end_wall"))]
        marks = gaps(spark, sf_dir).select(F.col("gap_end_wall").alias("w"), F.to_json(F.struct(F.lit(1).alias("ts_ns"), F.col("gap_end_wall").alias("ts_wall"), F.lit("gap").alias("marker"), *ends)).alias("line"))
        lines = live.unionByName(marks).select(ns_to_date(F.col("w")).cast("string").alias("date"), F.lit("00").alias("hour"), "line", F.col("w").alias("at"))  # a file per day
        land(lines.filter(F.col("date") < _SPLIT), f"{root}/raw")
        I.Compactor(spark, f"{root}/raw", f"{root}/out").run()
        land(lines.filter(F.col("date") >= _SPLIT), f"{root}/late")
        S.ingest(spark, f"{root}/late", f"{root}/out", f"{root}/checkpoint").awaitTermination()
        pulled = t.filter("event_id % 10 >= 4").withColumn("w", F.col("w") - 200_000_000)
        iso = F.concat(F.date_format(F.timestamp_micros(F.expr("w div 1000")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
        page = pulled.select(iso.alias("created_time"), F.col("event_id").alias("trade_id"), F.col("market_ticker").alias("ticker"), F.col("price").alias("yes_price_dollars"), F.lit("0.5").alias("no_price_dollars"), F.col("count").alias("count_fp"),
                             *[F.lit("yes").alias(c) for c in ("taker_side", "taker_outcome_side", "taker_book_side")], F.lit(None).cast("boolean").alias("is_block_trade"))
        rows = B.trade_rows(page)
        write_parts(rows.withColumn("part", B.page_name(series_of(F.col("market_ticker")), F.lit(0))), f"{root}/out", "trade")

    return f"{_once(spark, sf_dir, 'market', make)}/out"


def _reader(spark: SparkSession, sf_dir: str) -> R.Reader:
    return R.Reader(spark, market_store(spark, sf_dir))


def _shown(rows: DataFrame) -> DataFrame:
    """Trades of the reader with their time as a number."""
    return rows.select("trade_id", "market_ticker", "yes_price", "count", F.unix_micros("ts_wall").alias("ts_us"), "ts_ns", "source")


_STORED_OUT = f"SELECT CAST(trade_id AS VARCHAR) AS trade_id, market_ticker, {_PRICE} AS yes_price, {_COUNT} AS count, ts_wall // 1000 AS ts_us, ts_ns, source FROM t"


@query("stored_trades", f"WITH {_TRADES} {_STORED_OUT} WHERE {_IN} AND starts_with(market_ticker, 'C') {_FIRST}")
def stored_trades(spark, sf_dir):
    return _shown(_reader(spark, sf_dir).trades("C", START, END).dataframe(allow_gaps=True))


@query("stored_trades_raw", f"WITH {_TRADES} {_STORED_OUT} WHERE {_IN}")
def stored_trades_raw(spark, sf_dir):
    return _shown(_reader(spark, sf_dir).trades("", START, END, raw=True).dataframe(allow_gaps=True))


@query("stored_backfill", f"WITH {_TRADES} SELECT source, strftime(make_timestamp_ns(ts_wall), '%Y-%m-%d') AS date, count(*) AS n, CAST(sum(qty_fp) AS BIGINT) AS count_fp FROM t WHERE source = 'backfill' GROUP BY ALL")
def stored_backfill(spark, sf_dir):
    rows = _reader(spark, sf_dir).table("trade", "backfill_")
    return rows.groupBy("source", F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"), F.sum("count_fp").alias("count_fp"))


@query("stored_prices", f"WITH {_TICKS} SELECT w // 1000 AS ts_us, event_id AS ts_ns, market_ticker, {_PRICE} AS price, {_COUNT} AS volume FROM e WHERE w BETWEEN {LOW} AND {HIGH} AND market_ticker = 'CLICK-7'")
def stored_prices(spark, sf_dir):
    rows = _reader(spark, sf_dir).price_series("CLICK-7", START, END).dataframe(allow_gaps=True)
    return rows.select(F.unix_micros("ts_wall").alias("ts_us"), "ts_ns", "market_ticker", "price", "volume")


@query("stored_tickers", f"WITH {_TICKS} SELECT DISTINCT market_ticker FROM e WHERE w BETWEEN {LOW} AND {HIGH} AND starts_with(market_ticker, 'PUR')")
def stored_tickers(spark, sf_dir):
    return _reader(spark, sf_dir).list_tickers(START, END, "PUR").dataframe(allow_gaps=True)


@query("stored_coverage", f"WITH {_GAPS} SELECT gap_start_wall, gap_end_wall FROM g WHERE gap_start_wall <= {HIGH} AND gap_end_wall >= {LOW}")
def stored_coverage(spark, sf_dir):
    return _reader(spark, sf_dir).coverage(START, END).gaps.select("gap_start_wall", "gap_end_wall")


# --- files, manifest, retention: orders stand in for raw files, line items for outputs -------

_FILES_SQL = """f AS (SELECT 'raw/' || strftime(DATE '2024-01-01' + CAST(o_orderkey % 20 AS INTEGER), '%Y-%m-%d') || '/' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '.ndjson.zst' AS path,
    CAST(max(o_custkey) AS BIGINT) AS size, CAST(min(o_custkey) AS BIGINT) AS mtime_ns, count(*) AS n, CAST(max(o_orderkey) % 7 AS BIGINT) AS k FROM orders GROUP BY 1)"""
_MANIFEST_SQL = "m AS (SELECT path, size + CASE WHEN k = 1 THEN 1 ELSE 0 END AS size, mtime_ns, n AS total_lines, n - CASE WHEN k = 2 THEN 1 ELSE 0 END AS rows_written, k FROM f WHERE k <> 3)"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 20).cast("int")), "yyyy-MM-dd")
    path = F.concat(F.lit("raw/"), day, F.lit("/"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(".ndjson.zst"))
    files = o.groupBy(path.alias("path")).agg(F.max("o_custkey").alias("size"), F.min("o_custkey").alias("mtime_ns"), F.count("*").alias("n"), (F.max("o_orderkey") % 7).alias("k"))
    return with_partition(files)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest has of the files: some not at all, some of another size, some that don't add up."""
    f = _files(spark, sf_dir).filter("k <> 3")
    rows = F.create_map(F.lit("trade"), F.col("n") - F.when(F.col("k") == 2, 1).otherwise(0), F.lit("gap"), F.lit(0).cast("bigint"))
    return f.select("path", (F.col("size") + F.when(F.col("k") == 1, 1).otherwise(0)).alias("size"), "mtime_ns", F.col("n").alias("total_lines"), rows.alias("rows_by_type"), F.lit(0).cast("bigint").alias("rejects"))


def _outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).filter("k <> 4").select(F.lit("trade").alias("type"), "date", "part")


@query("pending_files", f"WITH {_FILES_SQL}, {_MANIFEST_SQL} SELECT path, size FROM f WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.path = f.path AND m.size = f.size AND m.mtime_ns = f.mtime_ns)")
def pending_files(spark, sf_dir):
    return I.pending(_files(spark, sf_dir), _manifest(spark, sf_dir)).select("path", "size")


@query("processed_files", f"WITH {_FILES_SQL}, {_MANIFEST_SQL} SELECT path, size FROM f WHERE EXISTS (SELECT 1 FROM m WHERE m.path = f.path AND m.size = f.size AND m.mtime_ns = f.mtime_ns)")
def processed_files(spark, sf_dir):
    return I.processed(_files(spark, sf_dir), _manifest(spark, sf_dir)).select("path", "size")


@query("completed_hours", f"WITH {_FILES_SQL} SELECT path FROM f WHERE path < 'raw/2024-01-20/12'")
def completed_hours(spark, sf_dir):
    return completed(_files(spark, sf_dir), NOW).select("path")


@query("dry_run_size", f"WITH {_FILES_SQL} SELECT count(*) AS files, CAST(sum(size) AS BIGINT) AS input_bytes, CAST(floor(sum(size) * 0.85) AS BIGINT) AS est_output_bytes FROM f")
def dry_run_size(spark, sf_dir):
    return I.dry_run(_files(spark, sf_dir))


@query("missing_outputs", f"WITH {_FILES_SQL}, {_MANIFEST_SQL} SELECT path, 'trade' AS type FROM m WHERE k = 4 AND rows_written > 0")
def missing_outputs(spark, sf_dir):
    return T.missing_outputs(_files(spark, sf_dir), _manifest(spark, sf_dir), _outputs(spark, sf_dir))


@query(
    "retention_assess",
    f"""WITH {_FILES_SQL}, {_MANIFEST_SQL} SELECT f.path, epoch_ns(TIMESTAMP '2024-01-20 12:00:00') - epoch_ns(strptime(f.path, 'raw/%Y-%m-%d/%H.ndjson.zst') + INTERVAL 1 HOUR) >= 7 * 86400000000000 AS old_enough,
    m.path IS NOT NULL AS in_manifest, coalesce(m.rows_written = m.total_lines, false) AS reconciled, coalesce(m.size = f.size, false) AS matches_disk, m.path IS NOT NULL AND (f.k <> 4 OR m.rows_written = 0) AS outputs_exist,
    old_enough AND in_manifest AND reconciled AND matches_disk AND outputs_exist AS deletable FROM f LEFT JOIN m ON m.path = f.path""",
)
def retention_assess(spark, sf_dir):
    return T.assess(_files(spark, sf_dir), _manifest(spark, sf_dir), _outputs(spark, sf_dir), NOW).select("path", "old_enough", "in_manifest", "reconciled", "matches_disk", "outputs_exist", "deletable")


@query("manifest_latest", "SELECT path, max(v) AS size FROM (SELECT 'raw/' || CAST(o_custkey AS VARCHAR) AS path, o_orderkey AS v FROM orders) GROUP BY path")
def manifest_latest(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = o.select(F.concat(F.lit("raw/"), F.col("o_custkey").cast("string")).alias("path"), F.col("o_orderkey").alias("size"), F.col("o_orderkey").alias("mtime_ns"), F.timestamp_seconds("o_orderkey").alias("processed_at"))
    return I.latest(rows).select("path", "size")


@query("migrate_sentinel", f"WITH {_TRADES} SELECT trade_id, ts_wall, CASE WHEN coalesce(ts_ns, 0) <> 0 THEN ts_ns END AS ts_ns, CASE WHEN coalesce(ts_ns, 0) = 0 THEN 'backfill' ELSE 'live' END AS source FROM t")
def migrate_sentinel(spark, sf_dir):
    old = trades(spark, sf_dir).select("trade_id", "ts_wall", F.coalesce("ts_ns", F.lit(0)).cast("bigint").alias("ts_ns"))
    return with_source(old)


# --- backfill planning ----------------------------------------------------------------------

_MEANS = "means AS (SELECT split_part(market_ticker, '-', 1) AS series, count(*) AS n, avg(qty_fp) / 100.0 AS mean_count FROM t GROUP BY 1 HAVING count(*) >= 100 AND avg(qty_fp) > 0)"


@query("cost_basis", f"WITH {_TRADES}, {_MEANS} SELECT series, n, round(mean_count, 6) AS mean_count FROM means")
def cost_basis(spark, sf_dir):
    return B.trusted_means(trades(spark, sf_dir)).withColumn("mean_count", F.round("mean_count", 6))


@query("fallback_median", f"WITH {_TRADES}, {_MEANS} SELECT round(coalesce(median(mean_count), 1.0), 6) AS fallback FROM means")
def fallback_median(spark, sf_dir):
    return B.fallback_mean(B.trusted_means(trades(spark, sf_dir))).select(F.round("fallback", 6).alias("fallback"))


def _census(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    series = F.concat(F.upper(F.left("p_type", F.lit(3))), F.col("p_partkey").cast("string"))
    return p.select(series.alias("series"), F.col("p_size").cast("bigint").alias("total"), (F.col("p_size") % 9).cast("bigint").alias("est_tradeable"), F.col("p_retailprice").alias("mean_vol"))


_CENSUS_SQL = "c AS (SELECT upper(left(p_type, 3)) || CAST(p_partkey AS VARCHAR) AS series, CAST(p_size % 9 AS BIGINT) AS est_tradeable, p_retailprice AS mean_vol FROM part)"
_TOP_SQL = f"{_CENSUS_SQL}, top AS (SELECT * FROM c WHERE est_tradeable > 0 AND NOT starts_with(series, 'ECO') ORDER BY est_tradeable DESC, series LIMIT 25)"


@query("census_topn", f"WITH {_TOP_SQL} SELECT series, est_tradeable FROM top")
def census_topn(spark, sf_dir):
    return B.top_series(_census(spark, sf_dir), 25, ["ECO"]).select("series", "est_tradeable")


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All series of the census with tradeable markets."""
    rows = B.with_mean(B.top_series(_census(spark, sf_dir), 0, []), spark.createDataFrame([], "series string, mean_count double"), F.lit(4.0))
    return rows.withColumn("est_rows", B.est_rows_of_series())


_PLANS_SQL = f"{_CENSUS_SQL}, plans AS (SELECT series, est_tradeable, CAST(round_even(est_tradeable * mean_vol / 4.0, 0) AS BIGINT) AS est_rows FROM c WHERE est_tradeable > 0)"


@query("est_rows", f"WITH {_PLANS_SQL} SELECT series, est_rows FROM plans")
def est_rows(spark, sf_dir):
    return _plans(spark, sf_dir).select("series", "est_rows")


@query("market_rows", f"WITH {_TICKS} SELECT event_id, CAST(round_even(qty_fp / 100.0 / 4.0, 0) AS BIGINT) AS est_rows FROM e")
def market_rows(spark, sf_dir):
    return ticks(spark, sf_dir).withColumn("mean_count", F.lit(4.0)).select(F.col("ts_ns").alias("event_id"), B.est_rows_of_market().alias("est_rows"))


@query(
    "cost_rollup",
    f"""WITH {_PLANS_SQL},
    q AS (SELECT *, est_rows * 40 AS est_bytes, est_tradeable + CAST(ceil(est_rows / 1000.0) AS BIGINT) AS est_requests FROM plans)
    SELECT series, CAST(sum(est_tradeable) AS BIGINT) AS est_tradeable, CAST(sum(est_rows) AS BIGINT) AS est_rows, CAST(sum(est_bytes) AS BIGINT) AS est_bytes, CAST(sum(est_requests) AS BIGINT) AS est_requests FROM q GROUP BY ROLLUP (series)""",
)
def cost_rollup(spark, sf_dir):
    return B.cost_preview(_plans(spark, sf_dir), 40.0).drop("est_seconds")


def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as combined markets: the suppliers of an order's items are its legs."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    leg = F.struct(F.concat(F.lit("S-"), F.col("l_suppkey").cast("string")).alias("market_ticker"))
    rows = items.groupBy(F.col("l_orderkey")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(leg)).alias("mve_selected_legs"))).alias("market"), F.sum(F.col("l_quantity").cast("bigint")).alias("v"))
    return rows.select(F.concat(F.lit("M-"), F.col("l_orderkey").cast("string")).alias("ticker"), legs_of(F.col("market")).alias("legs"), volume_or_zero(F.col("v")).alias("volume_fp"))


_COMBINED_SQL = "x AS (SELECT 'M-' || CAST(l_orderkey AS VARCHAR) AS ticker, list_sort(list(DISTINCT 'S-' || CAST(l_suppkey AS VARCHAR))) AS legs, CAST(sum(CAST(l_quantity AS BIGINT)) * 100 AS BIGINT) AS volume_fp FROM lineitem GROUP BY l_orderkey)"


@query("combined_topk", f"WITH {_COMBINED_SQL} SELECT ticker, volume_fp FROM x ORDER BY volume_fp DESC, ticker LIMIT 20")
def combined_topk(spark, sf_dir):
    return B.top_markets(_combined(spark, sf_dir), 20).select("ticker", "volume_fp")


@query("combined_legs", f"WITH {_COMBINED_SQL}, s AS (SELECT ticker AS leg, volume_fp FROM (SELECT 'S-' || CAST(s_suppkey AS VARCHAR) AS ticker, CAST(s_suppkey * 100 AS BIGINT) AS volume_fp FROM supplier WHERE s_suppkey % 3 <> 0)) SELECT leg, volume_fp FROM (SELECT DISTINCT unnest(legs) AS leg FROM x) LEFT JOIN s USING (leg)")
def combined_legs(spark, sf_dir):
    known = spark.read.parquet(f"{sf_dir}/supplier.parquet").filter("s_suppkey % 3 <> 0").select(F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("ticker"), (F.col("s_suppkey") * 100).alias("volume_fp"))
    return B.legs(_combined(spark, sf_dir), known)


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as markets in some state."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    status = F.element_at(F.array(*[F.lit(s) for s in B.STATUSES[:3]]), (F.col("c_custkey") % 3 + 1).cast("int"))
    return c.select(
        F.concat(F.left("c_mktsegment", F.lit(4)), F.lit("-"), F.col("c_custkey").cast("string")).alias("ticker"), F.left("c_mktsegment", F.lit(4)).alias("series"), status.alias("status"), F.lit(None).cast("string").alias("cursor"),
        F.lit(1).cast("bigint").alias("pages"), (F.col("c_custkey") % 50).alias("trades"), F.lit(None).cast("string").alias("reason"), F.lit(0.0).alias("updated"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey") * 10).alias("volume_fp"),
    )


_STATE_SQL = """st AS (SELECT left(c_mktsegment, 4) || '-' || CAST(c_custkey AS VARCHAR) AS ticker, left(c_mktsegment, 4) AS series, ['not_started', 'in_progress', 'complete'][CAST(c_custkey % 3 + 1 AS INTEGER)] AS status,
    c_custkey % 50 AS trades, CASE WHEN c_custkey % 5 > 0 THEN c_custkey * 10 END AS volume_fp, c_custkey FROM customer)"""


@query("status_summary", f"WITH {_STATE_SQL} SELECT s.status, count(st.ticker) AS markets, CAST(coalesce(sum(trades), 0) AS BIGINT) AS trades FROM (VALUES ('not_started'), ('in_progress'), ('complete'), ('failed')) s(status) LEFT JOIN st ON st.status = s.status GROUP BY s.status")
def status_summary(spark, sf_dir):
    return B.status_summary(_state(spark, sf_dir))


@query("status_by_series", f"WITH {_STATE_SQL} SELECT series, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in B.STATUSES) + " FROM st GROUP BY series")
def status_by_series(spark, sf_dir):
    return B.status_by_series(_state(spark, sf_dir)).select("series", *B.STATUSES)


@query("status_trades_by_series", f"WITH {_STATE_SQL} SELECT series, " + ", ".join(f"CAST(coalesce(sum(trades) FILTER (status = '{s}'), 0) AS BIGINT) AS {s}_trades" for s in B.STATUSES) + " FROM st WHERE volume_fp IS NOT NULL OR status <> 'not_started' GROUP BY series")
def status_trades_by_series(spark, sf_dir):
    return B.status_by_series(B.touched(_state(spark, sf_dir))).select("series", *[f"{s}_trades" for s in B.STATUSES])


@query("to_pull_prefix", f"WITH {_STATE_SQL} SELECT ticker FROM st WHERE status IN ('not_started', 'in_progress') AND ticker ILIKE 'auto%'")
def to_pull_prefix(spark, sf_dir):
    return B.to_pull(_state(spark, sf_dir), prefix="auto")


@query("to_pull_series", f"WITH {_STATE_SQL} SELECT ticker FROM st WHERE status IN ('not_started', 'in_progress') AND series IN ('AUTO', 'BUIL') AND volume_fp >= 1000")
def to_pull_series(spark, sf_dir):
    return B.to_pull(_state(spark, sf_dir), series=["AUTO", "BUIL"], min_volume=10.0)


@query("pending_tickers", f"WITH {_STATE_SQL} SELECT w.ticker FROM (SELECT ticker FROM st WHERE c_custkey % 2 = 0 UNION ALL SELECT 'NEW-' || CAST(s_suppkey AS VARCHAR) FROM supplier) w LEFT JOIN st USING (ticker) WHERE coalesce(status, '') <> 'complete'")
def pending_tickers(spark, sf_dir):
    state = _state(spark, sf_dir)
    new = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("NEW-"), F.col("s_suppkey").cast("string")).alias("ticker"))
    return B.pending_tickers(state.filter("int(split_part(ticker, '-', 2)) % 2 = 0").select("ticker").unionByName(new), state)


@query("seed_state", f"WITH {_STATE_SQL}, n AS (SELECT 'NEW-' || CAST(s_suppkey AS VARCHAR) AS ticker, CAST(s_suppkey AS BIGINT) AS v FROM supplier UNION ALL SELECT ticker, CAST(7 AS BIGINT) FROM st WHERE c_custkey % 4 = 0) SELECT ticker, coalesce(status, 'not_started') AS status, coalesce(v, volume_fp) AS volume_fp FROM st FULL JOIN n USING (ticker)")
def seed_state(spark, sf_dir):
    state = _state(spark, sf_dir)
    new = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("NEW-"), F.col("s_suppkey").cast("string")).alias("ticker"), F.col("s_suppkey").alias("volume_fp"))
    again = state.filter("int(split_part(ticker, '-', 2)) % 4 = 0").select("ticker", F.lit(7).cast("bigint").alias("volume_fp"))
    return B.seed(state, new.unionByName(again)).select("ticker", "status", "volume_fp")


@query("merge_state", f"WITH {_STATE_SQL} SELECT ticker, CASE WHEN c_custkey % 4 = 0 THEN 'complete' ELSE status END AS status, volume_fp FROM st")
def merge_state(spark, sf_dir):
    state = _state(spark, sf_dir)
    done = state.filter("int(split_part(ticker, '-', 2)) % 4 = 0").withColumns({"status": F.lit("complete"), "volume_fp": F.lit(None).cast("bigint")})
    return B.merge_state(state, done).select("ticker", "status", "volume_fp")


@query("page_names", "SELECT c_custkey, 'backfill_' || left(sha1(c_name), 16) || '_' || lpad(CAST(c_custkey % 12 AS VARCHAR), 5, '0') AS page FROM customer")
def page_names(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", B.page_name(F.col("c_name"), F.col("c_custkey") % 12).alias("page"))


@query("backfill_rows", f"WITH {_TICKS} SELECT CAST(event_id AS VARCHAR) AS trade_id, market_ticker, price_s AS yes_price_dollars, w AS ts_wall, w // 1000000000 AS ts, w // 1000000 AS ts_ms, strftime(make_timestamp_ns(w), '%Y-%m-%d') AS date FROM e")
def backfill_rows(spark, sf_dir):
    t = ticks(spark, sf_dir)
    iso = F.concat(F.date_format(F.timestamp_micros(F.expr("ts_wall div 1000")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    page = t.select(
        iso.alias("created_time"), F.col("ts_ns").alias("trade_id"), F.col("market_ticker").alias("ticker"), unscale(F.col("price_dollars"), 10_000).cast("string").alias("yes_price_dollars"), F.lit("0.5").alias("no_price_dollars"),
        F.lit("1").alias("count_fp"), *[F.lit("yes").alias(c) for c in ("taker_side", "taker_outcome_side", "taker_book_side")], F.lit(None).cast("boolean").alias("is_block_trade"),
    )
    return B.trade_rows(page).select("trade_id", "market_ticker", "yes_price_dollars", "ts_wall", "ts", "ts_ms", F.col("date").cast("string").alias("date"))


# --- streams, as batches --------------------------------------------------------------------


@query("hourly_volume", f"WITH {_TRADES} SELECT ts_wall // 3600000000000 AS hour_no, market_ticker, count(*) AS n, CAST(sum(qty_fp) AS BIGINT) AS count_fp FROM t GROUP BY 1, 2")
def hourly_volume(spark, sf_dir):
    out = S.hourly_volume(trades(spark, sf_dir))
    return out.select(F.expr("unix_seconds(hour) div 3600").alias("hour_no"), "market_ticker", "n", "count_fp")


@query("message_sessions", f"WITH {_TICKS}, s AS (SELECT w, sum(CASE WHEN w - coalesce(a, 0) >= 1800000000000 THEN 1 ELSE 0 END) OVER (ORDER BY w) AS k FROM (SELECT w, lag(w) OVER (ORDER BY w) AS a FROM e)) SELECT min(w) // 1000 AS start_us, max(w) // 1000 + 1800000000 AS end_us, count(*) AS n FROM s GROUP BY k")
def message_sessions(spark, sf_dir):
    return S.sessions(ticks(spark, sf_dir)).select(F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


# --- sources and sinks, over stored logs and services in memory --------------------------------


@query("raw_discovery", f"WITH {_LOG_SQL} SELECT DISTINCT path, '2024-01-01' AS date, substr(path, 16, 2) AS hour FROM l")
def raw_discovery(spark, sf_dir):
    return raw_files(spark, _log_store(spark, sf_dir)[0]).select(_log_path(F.col("path")).alias("path"), "date", "hour")


@query("numbered_lines", f"WITH {_LOG_SQL} SELECT path, line_number, CASE WHEN event_id % 12 < 4 THEN outcome END AS type FROM l")
def numbered_lines(spark, sf_dir):
    return I.classify(raw_lines(spark, _log_store(spark, sf_dir)[0])).select(_log_path(F.col("path")).alias("path"), "line_number", "type")


@query(
    "stored_rows",
    f"WITH {_TRADES}, {_GAPS} SELECT 'ticker' AS type, strftime(make_timestamp_ns(w), '%Y-%m-%d') AS date, count(*) AS n FROM e GROUP BY ALL UNION ALL SELECT 'trade', strftime(make_timestamp_ns(ts_wall), '%Y-%m-%d'), count(*) FROM t GROUP BY ALL"
    " UNION ALL SELECT 'gap', strftime(make_timestamp_ns(gap_end_wall), '%Y-%m-%d'), count(*) FROM g GROUP BY ALL",
)
def stored_rows(spark, sf_dir):
    reader = _reader(spark, sf_dir)
    counts = [reader.table(name).groupBy(F.lit(name).alias("type"), F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n")) for name in ("ticker", "trade", "gap")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("stored_parts", f"WITH {_TRADES} SELECT DISTINCT strftime(make_timestamp_ns(ts_wall), '%Y-%m-%d') AS date, 'backfill_' || left(sha1(split_part(market_ticker, '-', 1)), 16) || '_00000' AS part FROM t WHERE source = 'backfill'")
def stored_parts(spark, sf_dir):
    return _reader(spark, sf_dir).table("trade", "backfill_").select(F.col("date").cast("string").alias("date"), "part").distinct()


@query("migrate_report", f"WITH {_TRADES} SELECT count(*) AS total_rows, count(*) FILTER (coalesce(ts_ns, 0) = 0) AS sentinel_rows FROM t")
def migrate_report(spark, sf_dir):
    return report(trades(spark, sf_dir).withColumn("ts_ns", F.coalesce("ts_ns", F.lit(0).cast("bigint"))))


@query("feed_filter", f"WITH {_TICKS} SELECT event_id, event_id % 3 = 0 AS control FROM e WHERE event_id % 3 = 0 OR starts_with(market_ticker, 'CL') OR starts_with(market_ticker, 'VIEW-1')")
def feed_filter(spark, sf_dir):
    named = F.to_json(F.struct(F.lit("trade").alias("type"), F.struct("market_ticker").alias("msg")))
    messages = ticks(spark, sf_dir).select(F.col("ts_ns").alias("event_id"), (F.col("ts_ns") % 3 == 0).alias("control"), F.when(F.col("ts_ns") % 3 == 0, '{"type":"ok"}').otherwise(named).alias("raw"))
    return S.wanted(messages, ["CL", "VIEW-1"]).drop("raw")


@query(
    "market_meta",
    "SELECT c_mktsegment || '-' || CAST(c_custkey AS VARCHAR) AS ticker, c_mktsegment AS series, nullif(CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END, '') AS title, CAST(7 AS BIGINT) AS discovered_ts_ns FROM customer",
)
def market_meta(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    names = ("event_ticker", "market_type", "status", "result", "open_time", "close_time", "expiration_time")
    markets = c.select(F.concat("c_mktsegment", F.lit("-"), F.col("c_custkey").cast("string")).alias("ticker"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("").alias("title"), *[F.lit("").alias(n) for n in names])
    return B.market_meta(markets, 7).select("ticker", "series", "title", "discovered_ts_ns")


@query("census_file", f"WITH {_CENSUS_SQL} SELECT series, est_tradeable, round(mean_vol, 4) AS mean_vol FROM c")
def census_file(spark, sf_dir):
    folder = _once(spark, sf_dir, "census", lambda root: _census(spark, sf_dir).agg(F.to_json(F.array_sort(F.collect_list(F.struct("series", "total", "est_tradeable", "mean_vol")))).alias("value")).write.text(root))
    return B.census(spark, folder).select("series", "est_tradeable", F.round("mean_vol", 4).alias("mean_vol"))


def _service(path: str, params: dict) -> tuple[int, dict, dict]:
    """A service whose market `N-<k>` has k trades, seven to a page; those whose k ends in 9 fail after their first page."""
    at = int(params.get("cursor") or 0)
    if path == "/markets":
        found = [k for k in range(25) if k % 2 == (params["status"] == "closed")]
        return 200, {}, {"markets": [{"ticker": f"N-{k}", "volume_fp": f"{k}.00"} for k in found[at : at + 4]], "cursor": str(at + 4) if at + 4 < len(found) else ""}
    k = int(params["ticker"].split("-")[1])
    if k % 10 == 9 and at:
        return 404, {}, {}
    rows = [{"trade_id": f"{k}-{i}", "created_time": "2024-01-01T00:00:00Z", "yes_price_dollars": "0.5", "no_price_dollars": "0.5", "count_fp": "1.00", "taker_side": "yes"} for i in range(at, min(at + 7, k))]
    return 200, {}, {"trades": rows, "cursor": str(at + 7) if at + 7 < k else ""}


def _pulled(spark: SparkSession, sf_dir: str) -> str:
    """A store that a history pull has filled from the service."""

    def make(root: str) -> None:
        puller = Puller(spark, f"{root}/out", StateStore(spark, f"{root}/state"), _service, say=lambda text: None, wave=10)
        puller.discover()
        puller.pull(B.to_pull(puller.state.table("markets")))

    return _once(spark, sf_dir, "pulled", make)


_PULLED_SQL = "n AS (SELECT CAST(n_nationkey AS BIGINT) AS k, n_nationkey % 10 = 9 AND n_nationkey > 7 AS broke FROM nation)"


@query(
    "pull_state",
    f"WITH {_PULLED_SQL} SELECT 'N-' || CAST(k AS VARCHAR) AS ticker, CASE WHEN broke THEN 'failed' ELSE 'complete' END AS status, CASE WHEN broke THEN 7 ELSE k END AS trades, CASE WHEN broke THEN 1 ELSE greatest(1, CAST(ceil(k / 7.0) AS BIGINT)) END AS pages, CASE WHEN broke THEN '7' END AS cursor FROM n",
)
def pull_state(spark, sf_dir):
    return StateStore(spark, f"{_pulled(spark, sf_dir)}/state").table("markets").select("ticker", "status", "trades", "pages", "cursor")


@query("pull_trades", f"WITH {_PULLED_SQL} SELECT 'N-' || CAST(k AS VARCHAR) AS market_ticker, CASE WHEN broke THEN 7 ELSE k END AS n, CAST(CASE WHEN broke THEN 7 ELSE k END * 100 AS BIGINT) AS count_fp FROM n WHERE k > 0")
def pull_trades(spark, sf_dir):
    rows = R.Reader(spark, f"{_pulled(spark, sf_dir)}/out").table("trade", "backfill_")
    return rows.groupBy("market_ticker").agg(F.count("*").alias("n"), F.sum("count_fp").alias("count_fp"))


@query("pull_discovery", "SELECT * FROM (VALUES ('settled', true, 4), ('closed', true, 3)) x(scope, done, pages)")
def pull_discovery(spark, sf_dir):
    return StateStore(spark, f"{_pulled(spark, sf_dir)}/state").table("discovery").select("scope", "done", F.col("pages").cast("int").alias("pages"))


def _feed(at: int):
    """A message a second for 25 seconds; after every fifth the connection is lost for half a second."""
    events = []
    for i in range(25):
        events.append((i, i * 10**9, f'{{"type":"m","i":{i}}}'))
        if i % 5 == 4:
            events += [(i, i * 10**9 + 1, LOST), (i, i * 10**9 + 500_000_000, MADE)]
    return iter(events[at : at + 4])  # four events a batch: outages cross batches


@query("feed_lines", "SELECT CAST(n_nationkey AS BIGINT) * 1000000000 AS ts_wall, false AS gap, CAST(NULL AS BIGINT) AS gap_start_wall FROM nation UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 1000000000 + 500000000, true, CAST(n_nationkey AS BIGINT) * 1000000000 + 1 FROM nation WHERE n_nationkey % 5 = 4")
def feed_lines(spark, sf_dir):
    def make(root: str) -> None:
        spark.dataSource.register(feed_source(_feed))
        stream = S.write_raw(spark.readStream.format("tick_feed").load(), f"{root}/raw", f"{root}/checkpoint", processingTime="0 seconds")
        stream.processAllAvailable()
        stream.stop()

    lines = raw_lines(spark, f"{_once(spark, sf_dir, 'feed', make)}/raw")
    found = lambda name: F.get_json_object("line", f"$.{name}")
    return lines.select(found("ts_wall").cast("bigint").alias("ts_wall"), found("marker").isNotNull().alias("gap"), found("gap_start_wall").cast("bigint").alias("gap_start_wall"))
