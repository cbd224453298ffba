"""Symbol spelling: canonical ``BASE/QUOTE``, exchange stream names, model keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quote currencies recognised at the end of a symbol without a slash.
QUOTES = ("USDT", "USD", "USDC", "BTC", "ETH", "BNB")

_BLANKS = " \t\n\r\f\v"


def normalize_symbol(symbol: Column) -> Column:
    """``btc-usdt`` / ``BTCUSDT`` -> ``BTC/USDT``; null and blank become the empty string."""
    text = F.regexp_replace(F.trim(F.upper(symbol), F.lit(_BLANKS)), "-", "/")
    split = F.regexp_replace(text, f"^(.+)({'|'.join(QUOTES)})$", "$1/$2")
    done = F.contains(text, F.lit("/")) | (F.length(text) <= 3)
    return F.coalesce(F.when(done, text).otherwise(split), F.lit(""))


def stream_symbol(symbol: Column) -> Column:
    """``BTC/USDT`` or ``BTC-USDT`` -> ``btcusdt``, the exchange's stream name."""
    return F.lower(F.regexp_replace(symbol, "[-/]", ""))


def base_currency(symbol: Column, default: str = "BTC") -> Column:
    """Text before the slash, or ``default`` for symbols without one."""
    return F.when(F.contains(symbol, F.lit("/")), F.split_part(symbol, F.lit("/"), F.lit(1))).otherwise(
        F.lit(default)
    )


def model_key(path: Column) -> Column:
    """Model key from a file path: its stem, with ``_`` read as the pair separator.

    Names that start with ``_default_`` all map to the shared fallback key.
    """
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    paired = normalize_symbol(F.regexp_replace(stem, "_", "/"))
    return F.when(F.startswith(F.lower(stem), F.lit("_default_")), F.lit("_default_")).otherwise(paired)
