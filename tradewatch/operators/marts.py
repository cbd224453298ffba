"""Read models over trades and anomalies: candles, KPIs, boards, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.config import DEFAULT_SYMBOLS
from tradewatch.functions.numbers import fixed_text
from tradewatch.functions.symbols import base_currency, normalize_symbol
from tradewatch.functions.timestamps import micros_in, order_key, order_key_in_bucket
from tradewatch.operators.blocks import join_null_safe


def _position() -> Column:
    return order_key(F.col("event_time"), F.col("trade_id"))


def candles(trades: DataFrame, interval: str, max_trade_id: int | None = None) -> DataFrame:
    """OHLCV per symbol and interval; intervals without trades have no row."""
    bucket = micros_in(interval)
    position = _position() if bucket is None else order_key_in_bucket(
        F.col("event_time"), F.col("trade_id"), bucket, max_trade_id
    )
    bars = (
        trades.withColumn("_position", F.when(F.col("price").isNotNull(), position))
        .groupBy("symbol", F.window("event_time", interval).alias("w"))
        .agg(
            F.min_by("price", "_position").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_position").alias("close"),
            F.sum("quantity").alias("volume"),
        )
    )
    return bars.where(F.col("open").isNotNull()).select(
        "symbol", F.col("w.start").alias("bucket"), "open", "high", "low", "close", "volume",
        (F.col("close") >= F.col("open")).alias("is_up"),
    )


def candles_with_anomalies(trades: DataFrame, anomalies: DataFrame, interval: str) -> DataFrame:
    """Candles with the number of anomalies inside each; both sides are aggregated before joining."""
    marks = anomalies.groupBy("symbol", F.window("event_time", interval).alias("w")).agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        F.max(F.abs("z_score")).alias("max_abs_z"),
    ).select("symbol", F.col("w.start").alias("bucket"), "anomaly_count", "max_abs_z")
    return join_null_safe(candles(trades, interval), marks, ["symbol", "bucket"], "left", small=False).withColumns({
        "anomaly_count": F.coalesce("anomaly_count", F.lit(0)),
    })


def market_kpis(trades: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Current price, change against the first, high, low, volume and anomaly count per symbol."""
    per_symbol = trades.withColumn("_position", _position()).groupBy("symbol").agg(
        F.max_by("price", "_position").alias("current_price"),
        F.min_by("price", "_position").alias("first_price"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("quantity").alias("volume"),
    )
    counts = anomalies.groupBy("symbol").agg(F.count(F.lit(1)).alias("anomaly_count"))
    first = F.col("first_price")
    return join_null_safe(per_symbol, counts, ["symbol"], "left", small=False).select(
        "symbol", "current_price",
        F.when(first != 0, (F.col("current_price") - first) / first * 100).alias("change_pct"),
        "high", "low", "volume",
        base_currency(F.col("symbol")).alias("base_currency"),
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
    )


def symbol_rates(trades: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Trades, anomalies and rate per symbol, and a TOTAL row."""
    seen = trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))
    flagged = anomalies.groupBy("symbol").agg(F.count(F.lit(1)).alias("anomalies"))
    totals = join_null_safe(seen, flagged, ["symbol"], "left", small=False).rollup("symbol").agg(
        F.sum("trades").alias("trades"),
        F.sum(F.coalesce("anomalies", F.lit(0))).alias("anomalies"),
        F.grouping("symbol").alias("_total"),
    )
    return totals.select(
        F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("symbol")).alias("symbol"),
        "trades", "anomalies",
        (F.col("anomalies") / F.col("trades") * 100).alias("rate_pct"),
    )


def data_coverage(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
        F.count(F.lit(1)).alias("trades"),
    )


def anomaly_types(anomalies: DataFrame) -> DataFrame:
    return anomalies.select("anomaly_type").distinct().orderBy("anomaly_type")


def data_freshness(trades: DataFrame, as_of) -> DataFrame:
    """Latest event time and its age at ``as_of``."""
    now = F.lit(as_of).cast("timestamp")
    return trades.agg(F.max("event_time").alias("latest_time")).select(
        "latest_time",
        ((F.unix_micros(now) - F.unix_micros("latest_time")) / F.lit(1e6)).alias("age_sec"),
    )


def since(df: DataFrame, as_of, minutes: int, time: str = "event_time") -> DataFrame:
    """Rows of the last ``minutes`` before ``as_of``; a plain range predicate, so it is pushed down."""
    now = F.lit(as_of).cast("timestamp")
    return df.where((F.col(time) >= now - F.make_dt_interval(mins=F.lit(minutes))) & (F.col(time) <= now))


def lookback_counts(trades: DataFrame, as_of, choices) -> DataFrame:
    """Trade counts for several look-backs in one pass over the longest."""
    now = F.lit(as_of).cast("timestamp")
    recent = since(trades, as_of, max(choices))
    matching = F.filter(
        F.array(*[F.lit(m) for m in choices]),
        lambda m: F.col("event_time") >= now - F.make_dt_interval(mins=m),
    )
    return recent.select("symbol", F.explode(matching).alias("minutes")).groupBy("minutes", "symbol").agg(
        F.count(F.lit(1)).alias("trades")
    )


def recent_rows(
    df: DataFrame, as_of, minutes: int, symbol: str | None = None, types: list[str] | None = None,
    newest_first: bool = True, limit: int | None = None,
) -> DataFrame:
    """Recent trades or anomalies in time order, optionally of one symbol, some types, or the top n.

    The symbol may be spelled in any way; the table holds normalised symbols, so the filter is pushed to its scan.
    """
    rows = since(df, as_of, minutes)
    if symbol is not None:
        rows = rows.where(F.col("symbol") == normalize_symbol(F.lit(symbol)))
    if types is not None:
        rows = rows.where(F.col("anomaly_type").isin(list(types)))
    order = [F.col("event_time"), F.col("trade_id")]
    rows = rows.orderBy(*[c.desc() for c in order] if newest_first else order)
    return rows if limit is None else rows.limit(limit)


def recent_anomaly_board(anomalies: DataFrame, limit: int = 20) -> DataFrame:
    """The newest anomalies, formatted for display."""
    newest = anomalies.orderBy(F.col("event_time").desc(), F.col("trade_id").desc(), "anomaly_type").limit(limit)
    return newest.select(
        "trade_id",
        F.date_format("event_time", "HH:mm:ss").alias("time"),
        F.col("anomaly_type").alias("type"),
        F.concat(F.lit("$"), fixed_text(F.col("price"), 2, grouped=True)).alias("price"),
        fixed_text(F.col("z_score"), 2).alias("z_score"),
    )


def latest_trade(trades: DataFrame) -> DataFrame:
    """The newest trade of each symbol, by partial aggregation (no sort, no per-symbol window)."""
    keyed = trades.withColumn("_position", _position())
    return keyed.groupBy("symbol").agg(
        *[F.max_by(c, "_position").alias(c) for c in ("trade_id", "event_time", "price", "quantity")]
    )


def symbol_universe(
    trades: DataFrame, anomalies: DataFrame, defaults: tuple[str, ...] = DEFAULT_SYMBOLS
) -> DataFrame:
    """All symbols seen in either table in their normal spelling, sorted; ``defaults`` when neither holds any."""
    seen = trades.select("symbol").distinct().union(anomalies.select("symbol").distinct())
    found = seen.select(normalize_symbol(F.col("symbol")).alias("symbol")).where("symbol <> ''").distinct()
    # A row of defaults stands by; it shows only where nothing was found.
    known = found.agg(F.count(F.lit(1)).alias("n"))
    spare = known.where("n = 0").select(F.explode(F.array(*[F.lit(s) for s in defaults])).alias("symbol")) if defaults else None
    return (found if spare is None else found.union(spare)).orderBy("symbol")


def anomaly_trade_join(anomalies: DataFrame, trades: DataFrame) -> DataFrame:
    """Anomalies with the quantity and side of the trade they refer to."""
    facts = trades.select("trade_id", "quantity", "is_buyer_maker")
    return anomalies.select("trade_id", "symbol", "anomaly_type", "price", "z_score").join(facts, "trade_id")


def orphan_anomalies(anomalies: DataFrame, trades: DataFrame) -> DataFrame:
    """Anomalies whose trade is missing."""
    return anomalies.join(trades.select("trade_id"), "trade_id", "left_anti")


def zscore_bands(features: DataFrame, limit: float = 3.5) -> DataFrame:
    """z over time with its alert bands."""
    return features.select(
        "symbol", "trade_id", "event_time", "z_score",
        F.lit(limit).alias("upper_band"), F.lit(-limit).alias("lower_band"),
        (F.abs("z_score") > limit).alias("is_breach"),
    )
