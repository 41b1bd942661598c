"""Epoch nanoseconds, UTC dates and partition keys."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
TimeArg = datetime | str | int


def to_ns(value: TimeArg) -> int:
    """An argument as epoch ns: a datetime or ISO text (naive: UTC), or an integer that is one already."""
    if isinstance(value, bool):
        raise TypeError("a boolean is no time")
    if isinstance(value, int):
        return value
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    moment = moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)
    return (moment - EPOCH) // timedelta(microseconds=1) * 1000


def utc_date(ns: int) -> str:
    return (EPOCH + timedelta(microseconds=ns // 1000)).strftime("%Y-%m-%d")


def ns_to_timestamp(ns: Column) -> Column:
    """Epoch ns as a timestamp (microseconds; keep the long beside it to order by)."""
    return F.timestamp_micros(_floor_div(ns, 1000))


def _floor_div(value: Column, by: int) -> Column:
    """Floor division of longs (the SQL `div` truncates)."""
    step = F.lit(by).cast("bigint")
    return F.call_function("div", value - F.pmod(value, step), step)


def timestamp_to_ns(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * 1000


def ns_to_date(ns: Column) -> Column:
    return F.to_date(ns_to_timestamp(ns))


def ns_to_hour(ns: Column) -> Column:
    """Two digits of the UTC hour, by integers alone: no instant rounds into the next hour."""
    return F.date_format(ns_to_timestamp(ns), "HH")


def floor_seconds(ns: Column) -> Column:
    return _floor_div(ns, 1_000_000_000)


def floor_millis(ns: Column) -> Column:
    return _floor_div(ns, 1_000_000)
