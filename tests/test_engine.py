import json
from datetime import UTC, datetime

import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.operators import backfill as B
from tidemark.operators import ingest as I
from tidemark.operators import migrate, retention
from tidemark.operators.reader import CoverageError, Reader, SchemaError
from tidemark.plans.datasets import DATASETS
from tidemark.sources.raw import completed, land, raw_files, raw_lines

WALL = 1704067200_000_000_000  # 2024-01-01


def trade(i, **changes):
    msg = {"trade_id": f"t{i}", "market_ticker": f"AB-{i}", "yes_price_dollars": "0.5", "no_price_dollars": "0.5", "count_fp": "2.00", "taker_side": "yes", "taker_outcome_side": "yes", "taker_book_side": "bid", "is_block_trade": False, "ts": 1, "ts_ms": 1000}
    return {"ts_ns": i, "ts_wall": WALL + i, "raw": json.dumps({"type": "trade", "sid": 1, "seq": i, "msg": msg | changes})}


def tick(i):
    four, two = "0.1234", "1.00"
    msg = {"market_ticker": "AB-1", "market_id": "m", "price_dollars": four, "yes_bid_dollars": four, "yes_ask_dollars": four, "dollar_volume": 1, "dollar_open_interest": 1, "ts": 1, "ts_ms": 1, "time": "x"}
    msg |= {k: two for k in ("yes_bid_size_fp", "yes_ask_size_fp", "last_trade_size_fp", "volume_fp", "open_interest_fp")}
    return {"ts_ns": i, "ts_wall": WALL + i, "raw": json.dumps({"type": "ticker", "sid": 1, "msg": msg})}


def gap(a, b):
    return {"ts_ns": 1, "ts_wall": b, "marker": "gap", "gap_start_ns": 1, "gap_start_wall": a, "gap_end_ns": 2, "gap_end_wall": b}


CASES = [
    (json.dumps(trade(1)), "trade"),
    (json.dumps(tick(1)), "ticker"),
    (json.dumps(gap(WALL, WALL + 5)), "gap"),
    (json.dumps({"ts_ns": 1, "ts_wall": 1, "raw": '{"type":"subscribed","id":1,"msg":{"channel":"c","sid":2},"more":1}'}), "subscribed"),
    ("{", "bad_outer_json"),
    ("[]", "bad_outer_json"),
    ('{"ts_ns":1}', "missing_field"),
    ('{"raw":5}', "bad_inner_json"),
    ('{"raw":"{"}', "bad_inner_json"),
    ('{"raw":"[]"}', "unhandled_type"),
    ('{"raw":"{\\"type\\":\\"x\\"}"}', "unhandled_type"),
    (json.dumps(trade(1, count_fp=2.0)), "schema_violation"),
    (json.dumps(trade(1, count_fp="2.001")), "schema_violation"),
    (json.dumps(trade(1, ts=True)), "schema_violation"),
    (json.dumps(trade(1, ts=5.0)), "schema_violation"),
    (json.dumps(trade(1, ts="5")), "schema_violation"),
    (json.dumps(trade(1, ts=2**63)), "schema_violation"),
    (json.dumps(trade(1, is_block_trade="no")), "schema_violation"),
    (json.dumps({"marker": "gap"}), "schema_violation"),
]


def test_classification(spark):
    rows = spark.createDataFrame([("f", i, line) for i, (line, _) in enumerate(CASES)], "path string, line_number long, line string")
    found = I.classify(rows).persist()
    assert [(r.type or r.reason) for r in found.orderBy("line_number").collect()] == [x for _, x in CASES]
    counts = I.reconcile(I.line_counts(rows), I.stored_counts(found)).first()
    assert counts.reconciled and counts.total_lines == len(CASES) and counts.rejects == 15
    assert I.rows_of(found, DATASETS["trade"]).schema["count_fp"].metadata == {"scale": "100"}


def write_raw(folder, day, hour, lines):
    (folder / day).mkdir(parents=True, exist_ok=True)
    c = zstandard.ZstdCompressor()
    half = len(lines) // 2
    text = ["".join(x + "\n" for x in part).encode() for part in (lines[:half], lines[half:])]
    (folder / day / f"{hour}.ndjson.zst").write_bytes(c.compress(text[0]) + c.compress(text[1]))  # two frames


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    raw = root / "raw"
    write_raw(raw, "2024-01-01", "00", [json.dumps(x) for x in [trade(1), trade(2), tick(3), tick(4), gap(WALL + 100, WALL + 200)]] + ["", "{bad"])
    write_raw(raw, "2024-01-01", "01", [json.dumps(trade(3600_000_000_000 + i)) for i in range(5)])
    return raw, root / "out", I.Compactor(spark, str(raw), str(root / "out"))


def test_lines_are_numbered(spark, store):
    raw, *_ = store
    lines = raw_lines(spark, [str(raw / "2024-01-01/00.ndjson.zst")])
    assert sorted(r.line_number for r in lines.collect()) == [1, 2, 3, 4, 5, 7]


@pytest.mark.parametrize("date, hour", [("'2024-01-01'", "lpad(string(at % 3), 2, '0')"), ("'2024-01-0' || string(at % 2 + 1)", "nullif(lpad(string(at % 3), 2, '0'), '')")], ids=["one date", "two dates"])
def test_landed_lines_are_in_order(spark, tmp_path, date, hour):
    at = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("at"))  # neither a split nor the splits are in order
    land(at.select(F.expr(date).alias("date"), F.expr(hour).alias("hour"), F.col("at").cast("string").alias("line"), "at"), str(tmp_path / "raw"))
    found = {}
    for r in raw_lines(spark, str(tmp_path / "raw")).orderBy("path", "line_number").collect():
        found.setdefault(r.path, []).append(int(r.line))
    assert sum(map(len, found.values())) == 5000 and len(found) > 1 and all(x == sorted(x) for x in found.values())


def test_compaction_caches_nothing(spark, store, tmp_path, monkeypatch):
    cached, write = [], I.write_parts

    def seen(rows, root, name):
        write(rows, root, name)
        cached.append(len(spark.sparkContext._jsc.getPersistentRDDs()))

    monkeypatch.setattr(I, "write_parts", seen)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    assert I.Compactor(spark, str(store[0]), str(tmp_path / "again")).run().reconciled
    assert cached == [before] * len(DATASETS) and not list((tmp_path / "again").glob("_classified-*"))


def test_compaction_twice_is_once(spark, store):
    raw, out, compactor = store
    result = compactor.run()
    assert result.reconciled and sorted(f["total_lines"] for f in result.files) == [5, 6]
    assert compactor.run().files == []
    assert spark.read.parquet(str(out / "type=trade")).count() == 7
    assert spark.read.json(str(out / "rejects")).first().reason == "bad_outer_json"
    write_raw(raw, "2024-01-01", "01", ["{bad", "{bad"])  # the file changes and loses its trades
    assert len(compactor.run().files) == 1
    assert spark.read.parquet(str(out / "type=trade")).count() == 2
    assert compactor.manifest().count() == 2


def test_reader(spark, store):
    _, out, compactor = store
    compactor.run()
    reader = Reader(spark, str(out))
    with pytest.raises(CoverageError):
        reader.trades("AB", WALL, WALL + 1000).frame()
    frame = reader.trades("AB", WALL, WALL + 1000).frame(allow_gaps=True)
    assert frame["trade_id"].tolist() == ["t1", "t2"] and str(frame["yes_price"][0]) == "0.5000"
    assert reader.trades("AB-1", WALL, WALL + 50).frame()["trade_id"].tolist() == ["t1"]
    assert reader.trades("AB", WALL, WALL + 50, source="backfill").frame().empty
    assert reader.list_tickers(WALL, WALL + 10).frame()["market_ticker"].tolist() == ["AB-1"]
    assert reader.price_series("AB-1", WALL, WALL + 10).frame()["ts_ns"].tolist() == [3, 4]
    assert reader.coverage(WALL + 200, WALL + 300).has_gaps and not reader.coverage(WALL + 201, WALL + 300).has_gaps
    assert [len(b) for b in reader.trades("", WALL, WALL + 50).iter_batches(1)] == [1, 1]
    assert "PushedFilters" in reader.trades("", WALL, WALL + 50).explain()
    said = reader.trades("", WALL, WALL + 50).explain(analyze=True)
    assert said.startswith("2 rows in ") and "isFinalPlan=true" in said
    with pytest.raises(ValueError):
        reader.trades("", WALL, WALL, source="other")
    with pytest.raises(ValueError):
        reader.trades("", WALL, WALL - 1)


def test_live_backfilled_and_streamed_trades_lie_together(spark, tmp_path):
    """All three writers, one dataset: read as one, pruned by date, one copy of each trade."""
    from tidemark.streaming import ingest as S

    out = str(tmp_path / "out")
    day = 86_400_000_000_000
    at = lambda i, w: trade(i) | {"ts_wall": w}
    write_raw(tmp_path / "raw", "2024-01-01", "00", [json.dumps(at(1, WALL + 1)), json.dumps(at(2, WALL + 2))])
    assert I.Compactor(spark, str(tmp_path / "raw"), out).run().reconciled
    (tmp_path / "more").mkdir()
    (tmp_path / "more/a.ndjson").write_text("\n".join(json.dumps(at(i, WALL + day + i)) for i in (3, 4)))
    S.ingest(spark, str(tmp_path / "more"), out, str(tmp_path / "check")).awaitTermination()
    page = [(f"t{i}", "2024-01-02T00:00:00.5Z" if i > 2 else "2024-01-01T00:00:00.5Z", f"AB-{i}", "0.5", "0.5", "1.00", "yes", None, None, None, 7) for i in (2, 3, 5)]
    names = "trade_id string, created_time string, ticker string, yes_price_dollars string, no_price_dollars string, count_fp string, taker_side string, taker_outcome_side string, taker_book_side string, is_block_trade boolean, page int"
    rows = spark.createDataFrame(page, names)
    B.write_pages(B.trade_rows(rows).withColumn("page", F.lit(7)), out)
    reader = Reader(spark, out)
    found = reader.trades("", WALL, WALL + 2 * day).dataframe()
    assert sorted((r.trade_id, r.source) for r in found.collect()) == [("t1", "live"), ("t2", "live"), ("t3", "live"), ("t4", "live"), ("t5", "backfill")]
    assert reader.trades("", WALL, WALL + 2 * day, raw=True).dataframe().count() == 7
    assert {r.part.split("_")[0] for r in reader.table("trade").collect()} == {"00", "stream", "backfill"}
    assert reader.table("trade", "backfill_").count() == 3
    plan = reader.trades("", WALL, WALL + 5).explain()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(ts_wall)" in plan
    assert reader.trades("", WALL, WALL + 5).dataframe().count() == 2


def test_files_of_other_writers(spark, tmp_path):
    """Hour files and pages that lie in the date's folder itself, with scales in Arrow metadata only."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    schema = pa.schema([pa.field("ts_wall", pa.int64()), pa.field("ts_ns", pa.int64()), pa.field("market_ticker", pa.string()), *[pa.field(c, pa.int64(), metadata={"scale": "10000" if "dollars" in c else "100"}) for c in ("price_dollars", "yes_bid_dollars", "yes_ask_dollars", "yes_bid_size_fp", "yes_ask_size_fp", "last_trade_size_fp", "volume_fp", "open_interest_fp")]])
    folder = tmp_path / "type=ticker/date=2024-01-01"
    folder.mkdir(parents=True)
    pq.write_table(pa.table([[WALL], [1], ["m"], *[[i] for i in range(8)]], schema=schema), folder / "00.parquet")
    reader = Reader(spark, str(tmp_path))
    assert str(reader.price_series("m", WALL, WALL).frame()["yes_bid"][0]) == "0.0001"
    assert [r.part for r in reader.table("ticker").collect()] == ["00"]


def test_lost_lines_are_not_reconciled(spark, tmp_path, monkeypatch):
    write_raw(tmp_path / "raw", "2024-01-01", "00", [json.dumps(trade(i)) for i in range(4)])
    compactor = I.Compactor(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    whole = I.write_parts
    monkeypatch.setattr(I, "write_parts", lambda rows, root, name: whole(rows.limit(3), root, name))
    result = compactor.run()
    assert not result.reconciled and result.files[0]["n_trade"] == 3 and compactor.manifest().count() == 0 and result.summary["mismatched"] == 1
    monkeypatch.setattr(I, "write_parts", whole)
    result = compactor.run()
    assert result.reconciled and result.summary["rows"] == 4 and result.summary["output_bytes"] > 0 and compactor.manifest().count() == 1


def test_plain_files_that_would_be_split(spark, tmp_path):
    (tmp_path / "2024-01-01").mkdir()
    (tmp_path / "2024-01-01/00.ndjson").write_text("x\n" * 1000)
    assert raw_lines(spark, str(tmp_path)).agg(F.max("line_number")).first()[0] == 1000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        with pytest.raises(ValueError):
            raw_lines(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_reader_without_data(spark, tmp_path):
    reader = Reader(spark, str(tmp_path))
    assert reader.trades("", WALL, WALL + 1).frame().empty
    assert list(reader.price_series("x", WALL, WALL + 1).iter_batches()) == []


def test_unscaled_columns_need_a_scale(spark, tmp_path):
    spark.createDataFrame([(WALL, 1, 1, "m")], "ts_wall long, ts_ns long, price_dollars long, market_ticker string").withColumn("date", F.lit("2024-01-01")).write.partitionBy("date").parquet(str(tmp_path / "type=ticker"))
    with pytest.raises(SchemaError):
        Reader(spark, str(tmp_path)).price_series("m", WALL, WALL)


def test_trades_keep_the_live_copy(spark):
    from tidemark.operators.reader import dedup_trades, in_time_order

    rows = spark.createDataFrame([("a", 5, 5, "live"), ("a", 3, None, "backfill"), ("b", 5, None, "backfill"), ("b", 4, None, "backfill"), ("c", 5, 1, "live")], "trade_id string, ts_wall long, ts_ns long, source string")
    kept = in_time_order(dedup_trades(rows)).collect()
    assert [(r.trade_id, r.ts_wall, r.source) for r in kept] == [("b", 4, "backfill"), ("c", 5, "live"), ("a", 5, "live")]
    assert dedup_trades(dedup_trades(rows)).count() == 3


def test_nulls_come_last_in_time_order(spark):
    from tidemark.operators.reader import in_time_order

    rows = spark.createDataFrame([(5, None), (5, 9), (4, None)], "ts_wall long, ts_ns long")
    assert [tuple(r) for r in in_time_order(rows).collect()] == [(4, None), (5, 9), (5, None)]


def test_discovery(spark, store):
    raw, *_ = store
    files = raw_files(spark, str(raw))
    assert [r.hour for r in files.collect()] == ["00", "01"]
    assert completed(files, datetime(2024, 1, 1, 1, 30, tzinfo=UTC)).count() == 1


def test_retention(spark, store):
    raw, out, compactor = store
    compactor.run()
    files, outputs = raw_files(spark, str(raw)), spark.createDataFrame([("trade", "2024-01-01", "00"), ("ticker", "2024-01-01", "00")], "type string, date string, part string")
    found = {r.hour: r for r in retention.assess(files, compactor.manifest(), outputs, datetime(2024, 1, 20, tzinfo=UTC)).collect()}
    assert found["00"].reasons == ["outputs missing"] and not found["00"].deletable  # the gap's output isn't named
    assert found["01"].deletable
    young = retention.assess(files, compactor.manifest(), outputs, datetime(2024, 1, 2, tzinfo=UTC))
    assert retention.delete(spark, young) == []
    assert len(retention.delete(spark, retention.assess(files, compactor.manifest(), outputs, datetime(2024, 1, 20, tzinfo=UTC)), dry_run=True)) == 1


def test_migration(spark, tmp_path):
    old = spark.createDataFrame([("a", 0, "2024-01-01"), ("b", 7, "2024-01-01")], "trade_id string, ts_ns long, date string")
    old.write.partitionBy("date").parquet(str(tmp_path / "old"))
    assert migrate.migrate(spark, str(tmp_path / "old"), str(tmp_path / "new")) == {"rows": 2, "sentinels": 1}
    new = spark.read.parquet(str(tmp_path / "new"))
    assert sorted(map(tuple, new.select("trade_id", "ts_ns", "source").collect())) == [("a", None, "backfill"), ("b", 7, "live")]
    assert migrate.with_source(new).exceptAll(new).count() == 0


def test_state(spark):
    state = B.seed(spark.createDataFrame([], B.MARKETS), spark.createDataFrame([("A-1", 500), ("A_2", None), ("B-1", 50)], "ticker string, volume_fp long"))
    state = B.record_page(state, "A-1", "c", 10, False, 1.0)
    assert [r.ticker for r in B.to_pull(state, series=["A"], min_volume=5).collect()] == ["A-1"]
    assert [r.ticker for r in B.to_pull(state, prefix="a").collect()] == ["A-1", "A_2"]
    state = B.set_failed(B.record_page(state, "A-1", None, 5, True, 2.0), "B-1", "x" * 600, 3.0)
    row = {r.ticker: r for r in state.collect()}
    assert (row["A-1"].status, row["A-1"].trades, row["A-1"].pages) == ("complete", 15, 2) and len(row["B-1"].reason) == 500
    assert {r.status: r.markets for r in B.status_summary(state).collect()} == {"not_started": 1, "in_progress": 0, "complete": 1, "failed": 1}
    assert B.reset_failed(state, "b").filter("status = 'failed'").count() == 0
    assert B.top_markets(state.na.fill(0), 0).count() == 0


def test_cost(spark):
    plans = spark.createDataFrame([("A", 3, 1500), ("B", 1, 10)], "series string, est_tradeable long, est_rows long")
    preview = B.cost_preview(plans, 10.0)
    total = preview.filter("series is null").first()
    assert (total.est_rows, total.est_bytes, total.est_requests) == (1510, 15100, 7)  # 3 + 2 and 1 + 1
    assert B.fits(preview, 2 * 10**9, 1.0) and not B.fits(preview, 10**9, 1.0)
    assert B.fallback_mean(spark.createDataFrame([], "mean_count double")).first()[0] == 1.0


def test_backfill_pages(spark, tmp_path):
    def transport(path, params):
        page = int(params.get("cursor", "0"))
        rows = [{"trade_id": f"{params['ticker']}-{page}-{i}", "created_time": "2024-01-01T00:00:00.5Z", "yes_price_dollars": "0.5", "no_price_dollars": "0.5", "count_fp": "1.00", "taker_side": "yes", "is_block_trade": None} for i in range(2)]
        return 200, {}, {"trades": rows, "cursor": str(page + 1) if page < 2 else ""}

    from tidemark.sources.rest import read_trades

    rows = B.trade_rows(read_trades(spark, transport, ["X-1", "Y-2"]))
    got = rows.collect()
    assert len(got) == 12 and got[0].ts_wall == WALL + 500_000_000 and got[0].ts_ns is None and got[0].source == "backfill"
    for _ in range(2):  # pulled again, a page replaces itself
        B.write_pages(rows.withColumn("page", F.lit(1)), str(tmp_path / "t"))
    stored = Reader(spark, str(tmp_path / "t")).table("trade")
    assert stored.count() == 12 and stored.filter("part like 'backfill_%'").count() == 12
    assert B.stored_bytes(spark.read.parquet(str(tmp_path / "t/type=trade"))).first().rows == 12


def test_client_retries_and_cursors():
    from tidemark.sources.rest import BackfillError, Client, TokenBucket, backoff_s

    answers = [(429, {"Retry-After": "2"}, {}), (500, {}, {}), (200, {}, {"x": 1})]
    waits = []
    assert Client(lambda p, q: answers.pop(0), sleep=waits.append).get("/x", {}) == {"x": 1} and waits[0] == 2.0
    with pytest.raises(BackfillError):
        Client(lambda p, q: (404, {}, {})).get("/x", {})
    with pytest.raises(BackfillError):
        list(Client(lambda p, q: (200, {}, {"cursor": "same", "k": []})).pages("/x", {}, "k"))
    assert Client(lambda p, q: (200, {}, {"markets": [{"ticker": t, "volume_fp": "1"} for t in q["tickers"].split(",") if t != "no"]})).volumes(["a", "no"]) == {"a": "1"}
    slept, now = [], [0.0]
    bucket = TokenBucket(2.0, 1.0, lambda: now[0], slept.append)
    bucket.acquire(), bucket.acquire()
    assert slept == [0.5] and backoff_s(20, None, lambda: 1.0) == 60.0
