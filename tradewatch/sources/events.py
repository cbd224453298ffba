"""Trade adapters over general tables, for runs without a trade feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The symbol each event type stands for.
EVENT_SYMBOLS = {
    "click": "BTC/USDT",
    "view": "ETH/USDT",
    "purchase": "BNB/USDT",
    "signup": "SOL/USDT",
    "error": "XRP/USDT",
}


def trades_from_events(events: DataFrame) -> DataFrame:
    """Read an event log as trades: value is the price, ``props.k`` the quantity."""
    symbol = F.coalesce(*[
        F.when(F.col("event_type") == kind, F.lit(name)) for kind, name in EVENT_SYMBOLS.items()
    ])
    return events.select(
        F.col("event_id").alias("trade_id"),
        symbol.alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        (F.pmod(F.col("user_id"), F.lit(2)) == 1).alias("is_buyer_maker"),
        F.lit(False).alias("injected"),
    )


def load_event_trades(spark: SparkSession, folder: str) -> DataFrame:
    return trades_from_events(spark.read.parquet(f"{folder}/events.parquet"))


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Read order lines as trades: unit price over time, one symbol per flag pair."""
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trade_id"),
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.pmod(F.col("l_suppkey"), F.lit(2)) == 1).alias("is_buyer_maker"),
        F.lit(False).alias("injected"),
    )
