from datetime import UTC, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import clock, text
from tidemark.functions.scaled import parse_scaled, unscale


@pytest.mark.parametrize(
    ("value", "scaled"),
    [("0.6700", 6700), ("-3", -30000), ("1.", 10000), (" 2.00 ", 20000), ("-0.0030", -30), ("0", 0), ("", None), (".5", None), ("+1", None), ("1e3", None), ("0.12345", None), (None, None), ("9" * 30, None)],
)
def test_parse_scaled(spark, value, scaled):
    assert spark.createDataFrame([(value,)], "v string").select(parse_scaled(F.col("v"), 4)).first()[0] == scaled


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.integers(-(10**17), 10**17), min_size=1, max_size=50))
def test_scaling_there_and_back(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", parse_scaled(unscale(F.col("v"), 10_000).cast("string"), 4).alias("w"))
    assert all(r.v == r.w for r in df.collect())


def test_unscale_is_exact(spark):
    top = 2**63 - 1
    assert spark.createDataFrame([(top,)], "v long").select(unscale(F.col("v"), 10_000)).first()[0] == Decimal(top).scaleb(-4)


def test_times():
    assert clock.to_ns("1970-01-01T00:00:01") == 10**9
    assert clock.to_ns(datetime(1970, 1, 1, 0, 0, 1, tzinfo=UTC)) == 10**9
    assert clock.to_ns(5) == 5
    with pytest.raises(TypeError):
        clock.to_ns(True)


def test_hour_keys_never_round_up(spark):
    last = 1704067199999999999  # one ns before 2024-01-01
    row = spark.createDataFrame([(last,)], "t long").select(clock.ns_to_date(F.col("t")).cast("string"), clock.ns_to_hour(F.col("t"))).first()
    assert tuple(row) == ("2023-12-31", "23")


def test_floor_of_negative_times(spark):
    assert spark.createDataFrame([(-1,)], "t long").select(clock.floor_seconds(F.col("t"))).first()[0] == -1


def test_legs(spark):
    market = '{"mve_selected_legs":[{"market_ticker":"A"},{"market_ticker":"B"},{"market_ticker":"A"},{"market_ticker":5},{}]}'
    df = spark.createDataFrame([(market,), ('{"mve_selected_legs":[]}',), ("{}",)], "m string")
    assert [r[0] for r in df.select(text.legs_of(F.col("m"))).collect()] == [["A", "B"], None, None]


def test_formats():
    assert text.human_bytes(1536) == "1.5 KB"
    assert text.human_eta(3725) == "1h02m"
    assert text.human_eta(None) == "unknown"
