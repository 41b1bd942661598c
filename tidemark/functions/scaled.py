"""Fixed-point numbers: strings to scaled integers and back, without floating point."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"


def parse_scaled(value: Column, decimals: int) -> Column:
    """A decimal string as an integer scaled by 10^decimals; NULL for anything else.

    Accepts an optional minus, digits, and at most `decimals` digits after a point (`1.` too); white space
    around is ignored. Rejects empty text, `.5`, `+1`, `1e3`, more digits than the scale, and what overflows a long.
    """
    text = F.btrim(value, F.lit(SPACES))
    exact = text.try_cast(f"decimal({19 + decimals},{decimals})") * F.lit(10**decimals)
    return F.when(text.rlike(rf"^-?[0-9]+(\.[0-9]{{0,{decimals}}})?\z"), exact.try_cast("bigint"))


def unscale(value: Column, scale: int) -> Column:
    """A scaled long as an exact decimal; multiplies, as dividing decimals widens the type."""
    digits = len(str(scale)) - 1
    if scale != 10**digits:
        raise ValueError(f"scale {scale} is no power of ten")
    return (value.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(19,{digits})")


def none_if_empty(value: Column) -> Column:
    """Text, or NULL where there is none."""
    return F.nullif(value.cast("string"), F.lit(""))


def volume_or_zero(value: Column) -> Column:
    """A volume of two decimals; 0 where it is missing or malformed."""
    return F.coalesce(parse_scaled(value.cast("string"), 2), F.lit(0).cast("bigint"))
