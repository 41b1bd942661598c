"""The typed datasets: their fields, where each is found in a message, and how it is stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

#: Every writer stores `type=<dataset>/date=<date>/part=<part>`; a part (an hour file, a pulled page, a stream's batch) is replaced as a whole.
LAYOUT = ("date", "part")
# Fixed values of the stored format: scales, provenance, and the fields in their stored order.
USD_DECIMALS, QUANTITY_DECIMALS = 4, 2
LIVE, BACKFILL = "live", "backfill"
KINDS = {"int": LongType, "str": StringType, "bool": BooleanType, "usd": LongType, "qty": LongType}
DECIMALS = {"usd": USD_DECIMALS, "qty": QUANTITY_DECIMALS}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    #: `outer` (the envelope), `inner` (the message), `msg` (its payload) or `const`.
    place: str
    nullable: bool = False

    @property
    def stored(self) -> StructField:
        meta = {"scale": str(10 ** DECIMALS[self.kind])} if self.kind in DECIMALS else {}
        return StructField(self.name, KINDS[self.kind](), self.nullable, meta)


@dataclass(frozen=True)
class Dataset:
    name: str
    fields: tuple[Field, ...]

    @property
    def schema(self) -> StructType:
        return StructType([f.stored for f in self.fields])

    def scale(self, column: str) -> int | None:
        kind = next(f.kind for f in self.fields if f.name == column)
        return 10 ** DECIMALS[kind] if kind in DECIMALS else None


def _fields(text: str) -> tuple[Field, ...]:
    """`place: name kind, name kind; place: ...`; a `?` after the kind: may be NULL once stored."""
    out = []
    for group in text.split(";"):
        place, names = group.split(":")
        for item in names.split(","):
            name, kind = item.split()
            out.append(Field(name, kind.rstrip("?"), place.strip(), kind.endswith("?")))
    return tuple(out)


DATASETS: dict[str, Dataset] = {
    "ticker": Dataset(
        "ticker",
        _fields(
            "outer: ts_ns int, ts_wall int; inner: sid int; msg: market_ticker str, market_id str, price_dollars usd, yes_bid_dollars usd, yes_ask_dollars usd,"
            "yes_bid_size_fp qty, yes_ask_size_fp qty, last_trade_size_fp qty, volume_fp qty, open_interest_fp qty, dollar_volume int, dollar_open_interest int, ts int, ts_ms int, time str"
        ),
    ),
    "trade": Dataset(
        "trade",
        _fields(
            "outer: ts_ns int?, ts_wall int; inner: sid int, seq int; msg: trade_id str, market_ticker str, yes_price_dollars usd, no_price_dollars usd, count_fp qty,"
            "taker_side str, taker_outcome_side str, taker_book_side str, is_block_trade bool, ts int, ts_ms int; const: source str"
        ),
    ),
    "subscribed": Dataset("subscribed", _fields("outer: ts_ns int, ts_wall int; inner: id int; msg: channel str, sid int")),
    "gap": Dataset("gap", _fields("outer: ts_ns int, ts_wall int, gap_start_ns int, gap_start_wall int, gap_end_ns int, gap_end_wall int")),
}

#: Metadata of markets, which has no date partition.
MARKET_META = StructType(
    [StructField(n, LongType() if n == "discovered_ts_ns" else StringType(), n not in ("ticker", "series", "discovered_ts_ns"))
     for n in "ticker series event_ticker market_type status result title open_time close_time expiration_time discovered_ts_ns".split()]
)
