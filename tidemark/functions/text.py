"""Tickers, legs, and numbers for people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_of(ticker: Column) -> Column:
    """The part of a ticker before its first hyphen."""
    return F.split_part(ticker, F.lit("-"), F.lit(1))


def legs_of(market_json: Column) -> Column:
    """Distinct leg tickers of a combined market in their order; NULL where there are none."""
    legs = F.from_json(F.get_json_object(market_json, "$.mve_selected_legs"), "array<struct<market_ticker:variant>>")
    names = F.transform(legs, lambda x: F.when(F.schema_of_variant(x["market_ticker"]) == "STRING", F.try_variant_get(x["market_ticker"], "$", "string")))
    found = F.array_distinct(F.filter(names, lambda x: x.isNotNull() & (x != "")))
    return F.when(F.size(found) > 0, found)


def human_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if abs(n) < 1024:
            return f"{n:.1f} {unit}"
        n /= 1024
    return f"{n:.1f} TB"


def human_eta(seconds: float | None) -> str:
    """Hours, minutes, seconds; `unknown` where a rate gives none."""
    if seconds is None or seconds < 0 or seconds == float("inf"):
        return "unknown"
    minutes, s = divmod(int(seconds), 60)
    h, m = divmod(minutes, 60)
    return f"{h}h{m:02d}m" if h else f"{m}m{s:02d}s" if m else f"{s}s"
