"""History pulls against a service in memory."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.operators import backfill as B
from tidemark.operators.pull import Puller
from tidemark.operators.reader import Reader
from tidemark.operators.state import StateStore
from tidemark.sources.rest import BackfillError, Client, limits, read_pages, retry_after_s, trades_chain

SIZES = {"AA-1": 5, "AA-2": 0, "AB-1": 3, "BB-1": 7, "CC-1": 4, "CC-2": 2}
LEGS = {"CC-1": ["AA-1", "BB-1", "AA-1", "ZZ-9"], "CC-2": None}


def service(fail=(), stop_after=None):
    """Markets of two scopes and their trades, two to a page; markets in `fail` answer 404."""

    def transport(path, params):
        at = int(params.get("cursor") or 0)
        if path == "/account/limits":
            return 200, {}, {"read": {"bucket_capacity": 40, "refill_rate": 20}}
        if path == "/markets" and "tickers" in params:
            return 200, {}, {"markets": [market(t) for t in params["tickers"].split(",") if t in SIZES], "cursor": ""}
        if path == "/markets":
            found = [t for i, t in enumerate(SIZES) if (i % 2 == 0) == (params["status"] == "settled") and t.startswith(params.get("series_ticker", ""))]
            return 200, {}, {"markets": [market(t) for t in found[at : at + 2]], "cursor": str(at + 2) if at + 2 < len(found) else ""}
        ticker = params["ticker"]
        if ticker in fail or stop_after is not None and at >= stop_after:
            return 404, {}, {}
        rows = [{"trade_id": f"{ticker}-{i}", "created_time": f"2024-01-0{i + 1}T00:00:00Z", "yes_price_dollars": "0.5", "no_price_dollars": "0.5", "count_fp": "2.00", "taker_side": "yes", "is_block_trade": False} for i in range(at, min(at + 2, SIZES.get(ticker, 0)))]
        return 200, {}, {"trades": rows, "cursor": str(at + 2) if at + 2 < SIZES.get(ticker, 0) else ""}

    def market(t):
        legs = {"mve_selected_legs": [{"market_ticker": x} for x in LEGS[t]]} if LEGS.get(t) else {}
        return {"ticker": t, "event_ticker": "", "status": "settled", "title": "T", "volume_fp": f"{SIZES[t]}.00", **legs}

    return transport


@pytest.fixture
def puller(spark, tmp_path):
    return lambda **k: Puller(spark, str(tmp_path / "parquet"), StateStore(spark, str(tmp_path / "state")), service(**{x: k.pop(x) for x in ("fail", "stop_after") if x in k}), say=lambda text: said.append(text), **k)


said: list[str] = []


def states(p):
    return {r.ticker: (r.status, r.trades, r.pages, r.cursor) for r in p.state.table("markets").collect()}


def stored(p):
    return sorted(r.trade_id for r in Reader(p.spark, p.root).table("trade").collect())


def test_pull_to_the_end(spark, puller):
    p = puller(rate=1000.0, capacity=100.0, wave=4)
    assert p.discover() == 6 and p.discover() == 0
    assert spark.read.parquet(f"{p.root}/type=market_meta").count() == 6
    assert {r.scope: (r.done, r.pages) for r in p.state.table("discovery").collect()} == {"settled": (True, 2), "closed": (True, 2)}
    result = p.pull(B.to_pull(p.state.table("markets")))
    assert (result.markets, result.complete, result.failed, result.trades) == (6, 6, 0, 21) and result.requests == 13
    assert stored(p) == sorted(f"{t}-{i}" for t, n in SIZES.items() for i in range(n))
    assert states(p)["BB-1"] == ("complete", 7, 4, None) and states(p)["AA-2"] == ("complete", 0, 1, None)
    assert p.state.requests_s()[1] and p.pull(B.to_pull(p.state.table("markets"))).markets == 0
    found = Reader(spark, p.root).trades("AA", "2024-01-02", "2024-01-03").frame()
    assert found["trade_id"].tolist() == ["AA-1-1", "AA-1-2"] and set(found["source"]) == {"backfill"}


def test_pull_goes_on_where_it_stopped(puller):
    p = puller(stop_after=4)
    p.discover()
    result = p.pull(B.to_pull(p.state.table("markets"), prefix="BB"))
    assert (result.complete, result.failed, result.trades) == (0, 1, 4)
    assert states(p)["BB-1"] == ("failed", 4, 2, "4") and "404" in p.state.get("BB-1")["reason"]
    p = puller()
    assert p.state.reset_failed("BB") == 1 and p.state.reset_failed("BB") == 0
    result = p.pull(B.to_pull(p.state.table("markets"), prefix="BB"))
    assert (result.complete, result.trades, result.requests) == (1, 3, 2)  # pages 2 and 3 only
    assert states(p)["BB-1"] == ("complete", 7, 4, None) and stored(p) == [f"BB-1-{i}" for i in range(7)]


def test_pull_in_waves_of_few_pages(puller):
    p = puller(wave=2, wave_pages=1, fail=("AB-1",))
    p.discover()
    result = p.pull(B.to_pull(p.state.table("markets")))
    assert (result.complete, result.failed, result.trades, result.requests) == (5, 1, 18, 12)
    assert stored(p) == sorted(f"{t}-{i}" for t, n in SIZES.items() for i in range(n) if t != "AB-1")


def test_a_run_that_breaks_off_loses_nothing(puller, monkeypatch):
    p = puller()
    p.discover()
    monkeypatch.setattr(p.state, "merge", lambda changes: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        p.pull(B.to_pull(p.state.table("markets")))
    assert set(x[0] for x in states(p).values()) == {"not_started"} and len(stored(p)) == 21
    monkeypatch.undo()
    p.pull(B.to_pull(p.state.table("markets")))
    assert len(stored(p)) == 21  # pages replaced themselves


def test_census(puller, tmp_path):
    p = puller()
    census = tmp_path / "census.json"
    census.write_text(json.dumps([{"series": s, "total": 2, "est_tradeable": n, "mean_vol": 10.0} for s, n in (("AA", 3), ("BB", 2), ("CC", 9), ("DD", 0))]))
    said.clear()
    assert p.census(str(census), 2, [], 0.0, 1e9, "CC") is None and any("REFUSED" in x for x in said)
    assert p.census(str(census), 2, [], 0.0, 0.0, "CC", dry_run=True) is None and p.state.count_markets() == 0
    result = p.census(str(census), 2, [], 4.0, 0.0, "CC")
    assert set(states(p)) == {"AA-1", "AA-2", "BB-1"} and (result.markets, result.trades) == (2, 12)  # AA-2 has too little volume
    assert states(p)["AA-2"][0] == "not_started" and any("AA" in x and "complete=1" in x for x in said)


def test_combined_markets(puller):
    p = puller()
    said.clear()
    assert p.combined("CC", 5, 50, 0.0, dry_run=True) is None and any("CC-1" in x and "AA-1, BB-1, ZZ-9" in x for x in said)
    assert any("no legs" in x and "CC-2" in x for x in said)
    result = p.combined("CC", 5, 50, 0.0)
    assert (result.complete, result.trades) == (4, 16) and set(states(p)) == {"CC-1", "AA-1", "BB-1", "ZZ-9"}
    assert states(p)["ZZ-9"] == ("complete", 0, 1, None)  # a leg without a known volume is pulled all the same


def test_paced_shares_and_limits(spark):
    assert limits(Client(service())) == (10.0, 20.0)
    assert retry_after_s("2") == 2.0 and retry_after_s("x") is None and retry_after_s(None) is None and retry_after_s("nan") is None
    assert retry_after_s("Thu, 01 Jan 1970 00:01:40 GMT", lambda: 40.0) == 60.0
    pages = read_pages(spark, service(), [trades_chain("BB-1"), trades_chain("none")], shares=2, max_pages=2)
    assert pages.rdd.getNumPartitions() == 2
    rows = pages.filter(F.col("record").isNull()).orderBy("chain", "page").collect()
    assert [(r.chain, r.page, r.cursor) for r in rows] == [("BB-1", 0, "2"), ("BB-1", 1, "4"), ("none", 0, "")]


def test_discovery_fails_loudly(spark, tmp_path):
    p = Puller(spark, str(tmp_path / "p"), StateStore(spark, str(tmp_path / "s")), lambda path, params: (403, {}, {}), say=lambda x: None)
    with pytest.raises(BackfillError):
        p.discover()


def test_backfill_command(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "transport_of", lambda url: service())
    run = lambda *a: cli.main(["backfill", str(tmp_path), *a])
    with pytest.raises(SystemExit):
        run()
    assert run("--pull") == 1
    assert run("--discover", "--dry-run") == 0 and run("--discover") == 0 and run("--pull", "A", "--dry-run") == 0
    said = capsys.readouterr().out
    assert "would crawl settled (pending)" in said and "6 markets discovered" in said and "would pull 3 markets" in said and "10.0 requests/s" in said
    assert run("--pull", "A") == 0 and run("--retry-failed") == 0 and run("--status") == 0
    said = capsys.readouterr().out
    assert "3 of 3 markets complete" in said and "0 failed markets wait again" in said and "complete     markets=      6 trades=21" in said
