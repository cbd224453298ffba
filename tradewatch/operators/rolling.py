"""Rolling model: per-trade features over the last trades of the same symbol."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.config import RetrainPolicy, RollingConfig
from tradewatch.functions.numbers import ratio, ticks
from tradewatch.functions.timestamps import calendar_columns, with_event_time
from tradewatch.operators.blocks import join_null_safe, split_keys, with_halo
from tradewatch.operators.runs import in_order, rebatched, slices
from tradewatch.operators.sliding import shifted, sliding_m2, sliding_sum

ORDER = ("event_time", "trade_id")

_DEFAULTS = {
    "is_buyer_maker": 0, "z_score": 0.0, "rolling_mean": 0.0, "rolling_std": 0.0,
    "price_change_pct": 0.0, "time_gap_sec": 0.0, "volume_ratio": 1.0, "buy_pressure": 0.5,
    "vwap_deviation": 0.0, "price_velocity": 0.0, "volume_spike": 1.0, "hour": 0, "day_of_week": 0,
    "trading_session": "unknown", "is_weekend": 0, "injected": 0,
}


def _seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def _timed(trades: DataFrame) -> DataFrame:
    """Trades that have a place in the order."""
    return with_event_time(trades).where(F.col("event_time").isNotNull())


def _blocked(trades: DataFrame, halo_rows: int, block_rows: int) -> tuple[DataFrame, list[str]]:
    """Trades grouped into bounded blocks of consecutive rows, and the grouping columns."""
    split = split_keys(trades, ["symbol"], *ORDER, block_rows=block_rows)
    return with_halo(split, halo_rows), split.group_columns


def _deltas(spec) -> dict[str, Column]:
    """Change, change percent and time gap against the previous trade, from lagged columns."""
    previous, before = F.lag("price", 1).over(spec), F.lag("event_time", 1).over(spec)
    change = F.col("price") - previous
    return {
        "price_change": F.coalesce(change, F.lit(0.0)),
        "price_change_pct": F.when(previous > 0, change / previous * 100).otherwise(0.0),
        "time_gap_sec": F.coalesce(F.greatest(_seconds(F.col("event_time"), before), F.lit(0.0)), F.lit(0.0)),
    }


def trade_deltas(trades: DataFrame, block_rows: int = 1_000_000) -> DataFrame:
    """Price change and time gap of each trade with a time against the previous one of its symbol."""
    blocked, groups = _blocked(_timed(trades), 1, block_rows)
    spec = W.partitionBy(*groups).orderBy(*ORDER)
    return blocked.withColumns(_deltas(spec)).where(~F.col("_halo")).drop("_halo", *groups[1:])


def rolling_features(
    trades: DataFrame, config: RollingConfig = RollingConfig(), method: str = "blocked", history: DataFrame | None = None
) -> DataFrame:
    """All rolling features of each trade.

    ``method="blocked"`` evaluates the frames of one bounded block per task in vectorised form;
    ``method="frame"`` spells the definition out with built-in row frames, whose cost per row grows
    with the frame width. Both agree; the second is the cross-check.

    Symbols with more than ``config.block_rows`` trades are cut into blocks that carry the
    preceding ``window - 1`` trades, so the largest task is set by ``block_rows``, not by the
    busiest symbol. One shuffle by (symbol, block) either way. Trades of ``history`` stand in the
    frames of those after them but get no row of their own.
    """
    prepared = rolling_input(trades)
    if history is not None:
        seeds = rolling_input(history).withColumn("_seed", F.lit(True))
        prepared = prepared.withColumn("_seed", F.lit(False)).unionByName(seeds)
    blocked, groups = _blocked(prepared, config.window - 1, config.block_rows)
    if history is not None:
        blocked = blocked.withColumn("_halo", F.col("_halo") | F.col("_seed")).drop("_seed")
    if method == "blocked":
        measured = _block_measures(blocked, groups, config)
    elif method == "frame":
        measured = _frame_measures(blocked, groups, config)
    else:
        raise ValueError(f"unknown method {method!r}")
    return features_from_measures(measured, config)


def rolling_input(trades: DataFrame) -> DataFrame:
    """The columns the rolling model needs. A trade without a time has no place in the order."""
    source = _timed(trades)
    injected = F.col("injected") if "injected" in source.columns else F.lit(False)
    return source.select(
        "symbol", "trade_id", "event_time",
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("quantity").cast("double"), F.lit(0.0)).alias("quantity"),
        F.coalesce(F.col("is_buyer_maker").cast("int"), F.lit(0)).alias("is_buyer_maker"),
        F.coalesce(injected.cast("int"), F.lit(0)).alias("injected"),
    )


_CARRIED = "symbol string, trade_id bigint, event_time timestamp, price double, quantity double, is_buyer_maker int, injected int"
_MEASURES = (
    "n_before bigint, prev_price double, prev_us bigint, old_price double, old_us bigint, sum_price double, "
    "m2_price double, sum_qty double, vwap_value double, vwap_qty double, spike_qty double, pressure_qty double, "
    "buy_qty double"
)


MEASURED_DDL = f"{_CARRIED}, {_MEASURES}"


def _unit(config: RollingConfig) -> float:
    return 1.0 if config.tick_scale is None else float(10**config.tick_scale)


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def measure_rows(micros, price, quantity, is_buyer_maker, config: RollingConfig) -> dict[str, tuple]:
    """Frame sums and lags of one ordered run of trades: name -> (values, mask of missing ones)."""
    unit, back = _unit(config), config.velocity_window - 1
    bought = np.where(is_buyer_maker == 0, quantity, 0.0)
    counted = np.rint(price * unit) if unit != 1.0 else price
    return {
        "n_before": (np.arange(len(price)), None),
        "prev_price": shifted(price, 1), "prev_us": shifted(micros, 1),
        "old_price": shifted(price, back), "old_us": shifted(micros, back),
        "sum_price": (sliding_sum(counted, config.window), None),
        "m2_price": (sliding_m2(price, config.window), None),
        "sum_qty": (sliding_sum(quantity, config.window), None),
        "vwap_value": (sliding_sum(counted * quantity, config.vwap_window), None),
        "vwap_qty": (sliding_sum(quantity, config.vwap_window), None),
        "spike_qty": (sliding_sum(quantity, config.spike_window), None),
        "pressure_qty": (sliding_sum(quantity, config.pressure_window), None),
        "buy_qty": (sliding_sum(bought, config.pressure_window), None),
    }


class RunningMeasures:
    """``measure_rows`` over an ordered run that comes in pieces; the last ``window - 1`` trades are carried."""

    def __init__(self, config: RollingConfig, *carried: np.ndarray):
        self.config, self.carried, self.seen = config, carried, len(carried[0]) if carried else 0

    def extend(self, *piece: np.ndarray) -> dict[str, tuple]:
        """Measures of the next trades: micros, price, quantity, is_buyer_maker."""
        joined = [np.concatenate(pair) for pair in zip(self.carried, piece)] if self.carried else piece
        own, known = len(piece[0]), len(joined[0]) - len(piece[0])
        measures = measure_rows(*joined, self.config)
        out = {name: (values[known:], None if missing is None else missing[known:]) for name, (values, missing) in measures.items()}
        out["n_before"] = (np.arange(self.seen, self.seen + own), None)
        self.seen += own
        self.carried = tuple(values[max(0, len(values) - self.config.window + 1):].copy() for values in joined)
        return out


def _block_measures(df: DataFrame, groups: list[str], config: RollingConfig) -> DataFrame:
    """Frame sums of each block and its halo in one ordered pass; a task holds a batch and ``window - 1`` trades."""
    carried, least = _names(_CARRIED), 4 * config.window

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = RunningMeasures(config)
        for table, runs in slices(rebatched(batches, least), groups):
            columns = [
                table["event_time"].cast(pa.int64()).to_numpy(),
                *[table[c].to_numpy() for c in ("price", "quantity", "is_buyer_maker")],
            ]
            parts = []
            for start, end, begins in runs:
                if begins:
                    running = RunningMeasures(config)
                parts.append(running.extend(*[c[start:end] for c in columns]))
            out = table.select(carried)
            for name, (_, missing) in parts[0].items():
                values = np.concatenate([p[name][0] for p in parts])
                gone = None if missing is None else np.concatenate([p[name][1] for p in parts])
                out = out.append_column(name, pa.array(values, mask=gone))
            yield from out.filter(pc.invert(table["_halo"])).combine_chunks().to_batches()

    rows = df.select(*dict.fromkeys([*groups, *carried, "_halo"]))
    return in_order(rows, groups, list(ORDER)).mapInArrow(measure, MEASURED_DDL)


def _frame_measures(df: DataFrame, groups: list[str], config: RollingConfig) -> DataFrame:
    """The same measures with row frames."""
    spec = W.partitionBy(*groups).orderBy(*ORDER)
    back = config.velocity_window - 1

    def last(k: int):
        return spec.rowsBetween(-(k - 1), 0)

    price, quantity, micros = F.col("price"), F.col("quantity"), F.unix_micros("event_time")
    counted = price if config.tick_scale is None else ticks(price, config.tick_scale)
    bought = F.when(F.col("is_buyer_maker") == 0, quantity).otherwise(0.0)
    n = F.least(F.col("n_before") + 1, F.lit(config.window))
    w, v, s, b = config.window, config.vwap_window, config.spike_window, config.pressure_window
    measured = df.withColumns({
        "n_before": (F.row_number().over(spec) - 1).cast("bigint"),
        "prev_price": F.lag(price, 1).over(spec),
        "prev_us": F.lag(micros, 1).over(spec),
        "old_price": F.lag(price, back).over(spec),
        "old_us": F.lag(micros, back).over(spec),
        "sum_price": F.sum(counted).over(last(w)),
        "m2_price": F.var_pop(price).over(last(w)),
        "sum_qty": F.sum(quantity).over(last(w)),
        "vwap_value": F.sum(counted * quantity).over(last(v)),
        "vwap_qty": F.sum(quantity).over(last(v)),
        "spike_qty": F.sum(quantity).over(last(s)),
        "pressure_qty": F.sum(quantity).over(last(b)),
        "buy_qty": F.sum(bought).over(last(b)),
    })
    return measured.withColumn("m2_price", F.col("m2_price") * n).where(~F.col("_halo")).drop("_halo", *groups[1:])


def features_from_measures(df: DataFrame, config: RollingConfig) -> DataFrame:
    """Features from the measures, with the defaults that apply before there is enough history."""
    price, quantity = F.col("price"), F.col("quantity")
    rows = F.col("n_before") + 1
    n = F.least(rows, F.lit(config.window))
    ready = n >= config.min_history
    previous = F.col("prev_price")
    now_us = F.unix_micros("event_time")

    def once_ready(value: Column, default) -> Column:
        return F.when(ready, value).otherwise(default)

    def mean_quantity(total: str, k: int) -> Column:
        return F.col(total) / F.least(rows, F.lit(k))

    elapsed = (now_us - F.col("old_us")) / F.lit(1e6)
    staged = df.withColumns({
        "history_length": n.cast("bigint"),
        "price_change": F.coalesce(price - previous, F.lit(0.0)),
        "price_change_pct": F.when(previous > 0, (price - previous) / previous * 100).otherwise(0.0),
        "time_gap_sec": F.coalesce(F.greatest((now_us - F.col("prev_us")) / F.lit(1e6), F.lit(0.0)), F.lit(0.0)),
        "rolling_mean": once_ready(F.col("sum_price") / (n * F.lit(_unit(config))), price),
        "rolling_std": once_ready(F.sqrt(F.col("m2_price") / (n - 1)), 0.0),
        "volume_ratio": once_ready(ratio(quantity, mean_quantity("sum_qty", config.window), 1.0), 1.0),
        "volume_spike": once_ready(ratio(quantity, mean_quantity("spike_qty", config.spike_window), 1.0), 1.0),
        "buy_pressure": once_ready(ratio(F.col("buy_qty"), F.col("pressure_qty"), 0.5), 0.5),
        "price_velocity": once_ready(ratio(price - F.col("old_price"), elapsed, 0.0), 0.0),
        **calendar_columns(F.col("event_time")),
    })
    traded = (n >= config.vwap_window) & (F.col("vwap_qty") > 0)
    staged = staged.withColumns({
        "z_score": ratio(price - F.col("rolling_mean"), F.col("rolling_std"), 0.0),
        # Without enough trades, or without volume, the rolling mean stands in for the VWAP.
        "vwap": F.when(ready & traded, F.col("vwap_value") / (F.col("vwap_qty") * F.lit(_unit(config))))
        .otherwise(F.col("rolling_mean")),
    })
    deviation = F.when(ready & traded & (F.col("vwap") != 0), (price - F.col("vwap")) / F.col("vwap") * 100)
    return staged.withColumn("vwap_deviation", F.coalesce(deviation, F.lit(0.0))).drop(
        *_names(_MEASURES)
    )


def rolling_trades_table(features: DataFrame) -> DataFrame:
    """The rolling trade table: fixed columns, defaults for whatever is missing."""
    have = set(features.columns)

    def column(name: str) -> Column:
        return F.coalesce(name, F.lit(_DEFAULTS[name])) if name in have else F.lit(_DEFAULTS[name])

    vwap = F.coalesce("vwap", "price") if "vwap" in have else F.col("price")
    return features.select(
        F.col("trade_id").alias("id"), "symbol", F.col("event_time").alias("timestamp"), "price", "quantity",
        column("is_buyer_maker").cast("int").alias("is_buyer_maker"),
        *[column(c).alias(c) for c in (
            "z_score", "rolling_mean", "rolling_std", "price_change_pct", "time_gap_sec",
            "volume_ratio", "buy_pressure",
        )],
        vwap.alias("vwap"),
        *[column(c).alias(c) for c in (
            "vwap_deviation", "price_velocity", "volume_spike", "hour", "day_of_week",
            "trading_session", "is_weekend",
        )],
        column("injected").cast("int").alias("injected"),
    )


def rolling_anomalies_table(labelled: DataFrame) -> DataFrame:
    """The rolling anomaly table; labels of injected trades carry a suffix."""
    suffix = F.when(F.col("injected").cast("int") == 1, "_injected").otherwise("")
    return labelled.select(
        "trade_id", "symbol", F.col("event_time").alias("timestamp"),
        F.concat("anomaly_type", suffix).alias("anomaly_type"),
        "price",
        *[F.coalesce(c, F.lit(_DEFAULTS[c])).alias(c) for c in (
            "z_score", "price_change_pct", "volume_spike", "vwap_deviation",
        )],
    )


def newest_per_key(
    df: DataFrame, keys: list[str], n: int, order: tuple[str, ...] = ORDER, spread: int = 512
) -> DataFrame:
    """The newest ``n`` rows of each key, whole rows.

    Input tasks form ``spread`` shares. Rows are ranked first inside a share of a key and then over
    the survivors, and Spark applies the rank limit before each shuffle: an input task sends at most
    ``n`` rows per key, and these are reduced by many tasks before one sees the last ``spread * n``.
    The result does not depend on which share a row falls into.
    """
    newest = [F.col(c).desc() for c in order]
    share = F.pmod(F.spark_partition_id(), F.lit(spread))
    first = W.partitionBy(*keys, "_share").orderBy(*newest)
    final = W.partitionBy(*keys).orderBy(*newest)
    return (
        df.withColumn("_share", share)
        .withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(final)).where(F.col("_rank") <= n)
        .drop("_share", "_rank")
    )


def warm_start_history(trades: DataFrame, as_of, minutes: int = 60, rows: int = 1000) -> DataFrame:
    """Recent history to seed a stream with: newest ``rows`` trades per symbol of the last minutes."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
    recent = trades.where((F.col("event_time") >= since) & (F.col("event_time") <= F.lit(as_of).cast("timestamp")))
    return newest_per_key(recent, ["symbol"], rows).select(
        "symbol", "trade_id", "event_time", "price", "quantity", "is_buyer_maker"
    )


def retrain_points(trades: DataFrame, policy: RetrainPolicy = RetrainPolicy(), block_rows: int = 1_000_000) -> DataFrame:
    """The trades at which a symbol's model is due for training.

    The first fit happens once ``first`` trades with enough history have been seen, later ones at
    every ``every``-th trade of the symbol.
    """
    numbered = trade_numbers(trades, block_rows)
    first_fit = policy.min_history - 1 + policy.first
    number = F.col("trade_number")
    due = (number == first_fit) | ((number > first_fit) & (number % policy.every == 0))
    return numbered.where(due).select(
        "symbol", "trade_id", "event_time", "trade_number",
        F.when(number == first_fit, "first").otherwise("periodic").alias("reason"),
    )


def trade_numbers(trades: DataFrame, block_rows: int = 1_000_000) -> DataFrame:
    """Position of each trade with a time in its symbol's history: block-wise numbers plus block offsets."""
    split = split_keys(_timed(trades), ["symbol"], *ORDER, block_rows=block_rows)
    groups = split.group_columns
    numbered = split.rows.withColumn(
        "trade_number", F.row_number().over(W.partitionBy(*groups).orderBy(*ORDER)).cast("bigint")
    )
    if not split.cell_columns:
        return numbered
    before = W.partitionBy("symbol").orderBy("t_lo", "i_lo").rowsBetween(W.unboundedPreceding, -1)
    offsets = split.cells.select(*groups, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return (
        join_null_safe(numbered, offsets, groups, "left", small=False)
        .withColumn("trade_number", F.col("trade_number") + F.coalesce("_before", F.lit(0)))
        .drop("_before", "_tail", *split.cell_columns)
    )
