"""From raw messages to typed trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.numbers import coerce_double
from tradewatch.functions.symbols import normalize_symbol
from tradewatch.schemas import ENVELOPE, TRADE

TRADE_COLUMNS = [
    "symbol", "timestamp", "price", "quantity", "trade_id", "is_buyer_maker", "injected", "event_time",
]


def _decoded(raw: DataFrame, value: str) -> DataFrame:
    return raw.withColumn("_record", F.from_json(F.col(value).cast("string"), TRADE))


def _usable(record: Column) -> Column:
    return record.isNotNull() & record["symbol"].isNotNull() & record["timestamp"].isNotNull()


def parse_trades(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decode JSON trade messages (Kafka ``value`` bytes or text); malformed ones are skipped.

    Works unchanged on a stream. Missing flags become false.
    """
    record = F.from_json(F.col(value).cast("string"), TRADE)
    # Filtering inside the generator decodes each message once; a plain filter on the decoded column
    # would be pushed below the projection and decode it a second time.
    return raw.select(F.inline(F.filter(F.array(record), _usable))).select(
        "symbol",
        F.timestamp_millis("timestamp").alias("timestamp"),
        "price",
        "quantity",
        "trade_id",
        F.coalesce("is_buyer_maker", F.lit(False)).alias("is_buyer_maker"),
        F.coalesce("injected", F.lit(False)).alias("injected"),
        F.timestamp_millis("timestamp").alias("event_time"),
    )


def rejected_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """The messages :func:`parse_trades` skips, as a side output."""
    return _decoded(raw, value).where(~_usable(F.col("_record"))).drop("_record")


def message_counts(raw: DataFrame, value: str = "value") -> DataFrame:
    """Accepted and rejected message counts, in one pass."""
    return _decoded(raw, value).agg(
        F.count_if(_usable(F.col("_record"))).alias("accepted"),
        F.count_if(~_usable(F.col("_record"))).alias("rejected"),
        F.count(F.lit(1)).alias("total"),
    )


def parse_envelopes(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decode the exchange's combined-stream envelope into trades.

    Messages without ``stream`` or ``data`` are skipped; missing fields become zero or false.
    """
    envelope = F.from_json(F.col(value).cast("string"), ENVELOPE)
    whole = F.filter(F.array(envelope), lambda e: (e["stream"] != "") & e["data"].isNotNull())
    data = F.col("data")
    millis = F.coalesce(data["T"].try_cast("bigint"), F.lit(0))
    return raw.select(F.inline(whole)).select(
        normalize_symbol(data["s"]).alias("symbol"),
        F.timestamp_millis(millis).alias("timestamp"),
        coerce_double(data["p"], 0.0).alias("price"),
        coerce_double(data["q"], 0.0).alias("quantity"),
        F.coalesce(data["t"].try_cast("bigint"), F.lit(0)).alias("trade_id"),
        F.coalesce(data["m"].try_cast("boolean"), F.lit(False)).alias("is_buyer_maker"),
        F.lit(False).alias("injected"),
        F.timestamp_millis(millis).alias("event_time"),
    )


def supported_only(trades: DataFrame, symbols: list[str]) -> DataFrame:
    """Keep allow-listed symbols. The list is configuration, so it becomes a pushed ``IN`` filter."""
    return trades.where(F.col("symbol").isin(list(symbols)))
