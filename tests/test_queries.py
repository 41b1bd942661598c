import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.operators import ingest as I
from tidemark.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted([tuple(str(v[i]) for i in order) for v in values])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    found = QUERIES[name](spark, DATA)
    wanted = sql.execute(ORACLES[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(columns, wanted.fetchall())


@pytest.mark.parametrize("name", ["numbered_lines", "stored_rejects"])
def test_line_numbers_of_events_in_many_splits(spark, tmp_path, name):
    spark.read.parquet(f"{DATA}/events.parquet").repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    found, wanted = QUERIES[name](spark, str(tmp_path)), con.execute(ORACLES[name])
    columns = [d[0] for d in wanted.description]
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(columns, wanted.fetchall())


def test_half_filled_store_is_not_read(spark, sql, tmp_path, monkeypatch):
    data, compact, done = tmp_path / "data", I.Compactor._compact, []
    data.symlink_to(DATA)

    def stopped(self, todo):
        if done:
            raise OSError("stopped")
        done.append(todo)
        return compact(self, todo)

    with monkeypatch.context() as m:
        m.setattr(I, "BATCH_FILES", 10)
        m.setattr(I.Compactor, "_compact", stopped)
        with pytest.raises(OSError, match="stopped"):
            QUERIES["stored_rejects"](spark, str(data))
    found, wanted = QUERIES["stored_rejects"](spark, str(data)), sql.execute(ORACLES["stored_rejects"])
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows([d[0] for d in wanted.description], wanted.fetchall())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_windows_reach_the_scan(spark, whole_plans):
    stored = plan(QUERIES["stored_trades"](spark, DATA))
    assert "PartitionFilters: [isnotnull(date" in stored and "GreaterThanOrEqual(ts_wall," in stored and "StringStartsWith(market_ticker,C)" in stored
    assert "part" in plan(QUERIES["stored_backfill"](spark, DATA)).split("PartitionFilters: [")[1].split("]")[0]
    for name in ("trades_dedup", "price_series", "list_tickers"):
        assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan(QUERIES[name](spark, DATA)), name


def test_no_query_sorts_all_rows_in_one_task(spark):
    for name in ("coverage_overlap", "message_sessions"):
        scans = plan(QUERIES[name](spark, DATA))
        # minutes are added up before anything is exchanged
        assert "partial_min" in scans.rsplit("Exchange hashpartitioning", 1)[-1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
