"""Numeric column helpers: guarded division, half-up rounding, coercion, number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, default: float) -> Column:
    """``numerator / denominator`` where the denominator is positive, else ``default``."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(float(default)))


def half_up(value: Column, digits: int = 6) -> Column:
    """Round half up by scaling; plain double arithmetic, so any SQL engine can repeat it."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ticks(price: Column, tick_scale: int) -> Column:
    """Price as a whole number of ticks of size ``10 ** -tick_scale``."""
    return F.rint(price * F.lit(float(10**tick_scale))).cast("bigint")


def coerce_double(value: Column, default: float | None = None) -> Column:
    """Text or number to double; unparsable, null and NaN become ``default``."""
    number = value.try_cast("double")
    number = F.when(F.isnan(number), F.lit(None)).otherwise(number)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def number_text(value: Column, digits: int = 6) -> Column:
    """Shortest plain decimal text with at most ``digits`` decimals and at least one."""
    exact = half_up(value, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(exact, r"(\.[0-9]+?)0+$", "$1")


def fixed_text(value: Column, digits: int, grouped: bool = False) -> Column:
    """Text with a fixed number of decimals, optionally with thousands separators."""
    pattern = ("#,##0" if grouped else "0") + "." + "0" * digits
    return F.call_function("format_number", value, F.lit(pattern))
