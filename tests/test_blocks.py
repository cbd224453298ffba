"""Bounded blocks must not change any result, whatever the skew."""

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.config import RetrainPolicy, RollingConfig
from tradewatch.operators import rolling
from tradewatch.operators.blocks import split_keys, with_halo
from tradewatch.operators.sliding import shifted, sliding_m2, sliding_sum

NUMBERS = [
    "history_length", "rolling_mean", "rolling_std", "z_score", "volume_ratio", "volume_spike", "vwap",
    "vwap_deviation", "price_velocity", "buy_pressure", "price_change", "price_change_pct", "time_gap_sec",
]


def skewed(trades, shape):
    if shape == "spread":
        return trades
    if shape == "one_symbol":
        return trades.withColumn("symbol", F.lit("BTC/USDT"))
    hot = F.lit("2024-01-08 00:00:00").cast("timestamp")
    return trades.withColumns({
        # The busier of the two symbols is a missing one.
        "symbol": F.when(F.col("trade_id") % 3 == 0, "ETH/USDT"),
        # A third of all rows share one instant.
        "event_time": F.when(F.col("trade_id").between(2000, 5333), hot).otherwise(F.col("event_time")),
    })


def collected(df):
    return df.select("trade_id", *NUMBERS).toPandas().sort_values("trade_id", ignore_index=True)


@pytest.mark.parametrize("k", [1, 2, 7, 50, 400])
def test_sliding_matches_brute_force(k):
    rng = np.random.default_rng(k)
    x = rng.normal(100, 3, 333)
    x[50] = 1e9  # an absurd price must not disturb frames that no longer hold it
    frames = [x[max(0, i - k + 1): i + 1] for i in range(len(x))]
    np.testing.assert_allclose(sliding_sum(x, k), [f.sum() for f in frames], rtol=1e-12)
    np.testing.assert_allclose(sliding_m2(x, k), [((f - f.mean()) ** 2).sum() for f in frames], rtol=1e-8, atol=1e-8)


def test_sliding_edges():
    assert len(sliding_sum(np.array([]), 5)) == 0
    assert len(sliding_m2(np.array([]), 5)) == 0
    values, missing = shifted(np.array([1, 2, 3]), 5)
    assert missing.all() and (values == 0).all()


@pytest.mark.parametrize("shape", ["spread", "one_symbol", "hot_instant"])
def test_blocked_equals_frames(medium_trades, shape):
    trades = skewed(medium_trades, shape)
    plain = collected(rolling.rolling_features(trades, RollingConfig(), method="frame"))
    blocked = collected(rolling.rolling_features(trades, RollingConfig(block_rows=2000)))
    assert len(plain) == len(blocked) == 10_000
    for name in NUMBERS:
        np.testing.assert_allclose(
            blocked[name].astype(float), plain[name].astype(float), rtol=1e-9, atol=1e-9, err_msg=name
        )


@pytest.mark.parametrize("shape", ["one_symbol", "hot_instant"])
def test_blocks_are_bounded_and_halo_is_complete(medium_trades, shape):
    trades, limit, halo = skewed(medium_trades, shape), 700, 99
    split = split_keys(trades, ["symbol"], block_rows=limit)
    assert split.cell_columns
    sizes = split.rows.groupBy(*split.group_columns).count()
    assert sizes.agg(F.max("count")).first()[0] <= limit
    assert sizes.agg(F.sum("count")).first()[0] == 10_000

    placed = with_halo(split, halo)
    assert placed.where(~F.col("_halo")).count() == 10_000
    order = W.partitionBy("symbol").orderBy("event_time", "trade_id")
    numbered = trades.select("trade_id", F.row_number().over(order).alias("n"))
    per_block = placed.join(numbered, "trade_id").groupBy(*split.group_columns).agg(
        F.min("n").alias("first"), F.max("n").alias("last"), F.count("*").alias("rows"),
        F.min(F.when(~F.col("_halo"), F.col("n"))).alias("own_first"),
    )
    for row in per_block.collect():
        assert row["last"] - row["first"] + 1 == row["rows"], "a block and its halo are contiguous"
        assert row["first"] <= max(1, row["own_first"] - halo)


def test_small_keys_are_left_alone(small_trades):
    split = split_keys(small_trades, ["symbol"], block_rows=100_000)
    assert split.cell_columns == [] and split.rows is small_trades


def test_trade_deltas_blocked(medium_trades):
    trades = skewed(medium_trades, "hot_instant")
    a = rolling.trade_deltas(trades).select("trade_id", "price_change", "time_gap_sec")
    b = rolling.trade_deltas(trades, block_rows=500).select("trade_id", "price_change", "time_gap_sec")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_trade_numbers_blocked(medium_trades):
    trades = skewed(medium_trades, "hot_instant")
    a = rolling.trade_numbers(trades).select("trade_id", "trade_number")
    b = rolling.trade_numbers(trades, block_rows=500).select("trade_id", "trade_number")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_trades_without_a_time_have_no_place(medium_trades):
    gone = F.col("trade_id") % 7 == 0
    holed = medium_trades.withColumn("event_time", F.when(~gone, F.col("event_time")))
    for block_rows in (1_000_000, 500):
        for operator in (rolling.trade_deltas, rolling.trade_numbers):
            a, b = operator(holed, block_rows), operator(medium_trades.where(~gone))
            names = ["trade_id", *[c for c in ("price_change", "time_gap_sec", "trade_number") if c in a.columns]]
            assert a.select(names).exceptAll(b.select(names)).isEmpty() and b.select(names).exceptAll(a.select(names)).isEmpty()


def test_retrain_points(medium_trades):
    one = medium_trades.withColumn("symbol", F.lit("A"))
    rows = rolling.retrain_points(one, RetrainPolicy(first=100, every=3000)).orderBy("trade_number").collect()
    assert [(r["trade_number"], r["reason"]) for r in rows] == [
        (149, "first"), (3000, "periodic"), (6000, "periodic"), (9000, "periodic"),
    ]


def test_zero_prices_and_quantities(spark):
    rows = [("A", i, float(i), 0.0, 0.0, False) for i in range(120)]
    df = spark.createDataFrame(rows, "symbol string, trade_id bigint, s double, price double, quantity double, is_buyer_maker boolean")
    df = df.withColumn("event_time", F.timestamp_seconds(F.col("s")))
    last = rolling.rolling_features(df).where("trade_id = 119").first()
    assert (last["z_score"], last["volume_ratio"], last["volume_spike"]) == (0.0, 1.0, 1.0)
    assert (last["buy_pressure"], last["vwap"], last["vwap_deviation"]) == (0.5, 0.0, 0.0)
    assert last["price_change_pct"] == 0.0 and last["time_gap_sec"] == 1.0


def test_empty_input(small_trades):
    assert rolling.rolling_features(small_trades.where("false")).count() == 0
    assert rolling.trade_deltas(small_trades.where("false")).count() == 0


def test_newest_per_key_keeps_ties_whole(spark):
    df = spark.range(1000).select(
        F.lit("A").alias("symbol"), F.col("id").alias("trade_id"), F.timestamp_seconds(F.lit(5)).alias("event_time")
    )
    kept = rolling.newest_per_key(df, ["symbol"], 10)
    assert sorted(r["trade_id"] for r in kept.collect()) == list(range(990, 1000))
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
