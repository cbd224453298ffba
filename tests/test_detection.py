"""Windowed model, rules, fusion and labels on small in-line frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewatch.config import RollingConfig, Thresholds, WindowConfig
from tradewatch.operators import detection, windowed

TRADE = "symbol string, trade_id bigint, s double, price double, quantity double"


def trades(spark, rows):
    return spark.createDataFrame(rows, TRADE).withColumn("event_time", F.timestamp_micros((F.col("s") * 1e6).cast("bigint")))


TUMBLING = WindowConfig("60 seconds", "60 seconds")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_window_of_one_trade(spark):
    row = one(windowed.window_features(trades(spark, [("A", 1, 10.0, 5.0, 2.0)]), TUMBLING))
    assert (row["first_price"], row["last_price"], row["std_price"], row["z_score"]) == (5.0, 5.0, None, 0.0)
    assert (row["price_change_pct"], row["time_range_sec"], row["time_gap_sec"]) == (0.0, 0, 0.0)
    assert row["window_start"] == datetime(1970, 1, 1) and row["hour"] == "1970-01-01-00"


def test_zero_first_price_and_null_prices(spark):
    rows = [("A", 1, 1.0, None, 1.0), ("A", 2, 2.0, 0.0, 3.0), ("A", 3, 3.5, 8.0, None)]
    row = one(windowed.window_features(trades(spark, rows), TUMBLING))
    assert (row["first_price"], row["last_price"], row["price_change_pct"]) == (0.0, 8.0, 0.0)
    assert (row["trade_count"], row["window_volume"], row["avg_quantity"]) == (3, 4.0, 2.0)
    assert row["avg_price"] == 4.0 and row["time_range_sec"] == 2


def test_ties_follow_trade_id(spark):
    rows = [("A", 3, 5.0, 30.0, 1.0), ("A", 1, 5.0, 10.0, 1.0), ("A", 2, 5.0, 20.0, 1.0)]
    for config in (TUMBLING, WindowConfig("60 seconds", "60 seconds", max_trade_id=100)):
        row = one(windowed.window_features(trades(spark, rows), config))
        assert (row["first_price"], row["last_price"]) == (10.0, 30.0)


@pytest.mark.parametrize("config", [
    WindowConfig("1 day", "8 hours"), WindowConfig("1 day", "8 hours", max_trade_id=2**20), WindowConfig("60 seconds", "20 seconds"),
    WindowConfig("6 hours", "6 hours", tick_scale=2),
])
def test_panes_equal_whole_windows(small_trades, config, monkeypatch):
    paned = windowed.window_features(small_trades, config).toPandas()
    monkeypatch.setattr(windowed, "_MOST_PANES", 0)
    whole = windowed.window_features(small_trades, config).toPandas()
    order = ["symbol", "window_start"]
    paned, whole = (df.sort_values(order, ignore_index=True)[whole.columns] for df in (paned, whole))
    for name in whole.columns:
        if whole[name].dtype.kind == "f":
            assert ((paned[name] - whole[name]).abs().fillna(0) < 1e-9).all(), name
            assert (paned[name].isna() == whole[name].isna()).all(), name
        else:
            assert (paned[name] == whole[name]).all(), name


def test_uneven_windows_use_whole_windows(small_trades):
    assert windowed.window_features(small_trades, WindowConfig("50 seconds", "20 seconds")).count() > 0


def test_aggregation_stays_hashed(small_trades):
    plan = windowed.window_features(small_trades)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_threshold_defaults_field_by_field(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "symbol string")
    overrides = {"A": Thresholds(z=9.0), "B": Thresholds(volume=8.0, price_change=7.0)}
    rows = {r["symbol"]: tuple(r)[1:] for r in detection.with_thresholds(df, overrides, Thresholds(1.0, 2.0, 3.0)).collect()}
    assert rows == {"A": (9.0, 2.0, 3.0), "B": (1.0, 8.0, 7.0), None: (1.0, 2.0, 3.0)}


def test_threshold_sql_functions(spark):
    detection.register_threshold_functions(spark)
    spark.createDataFrame([("ETH/USDT",), ("??",)], "symbol string").createOrReplaceTempView("some_symbols")
    rows = spark.sql(
        "SELECT symbol, get_z_threshold(symbol) z, get_volume_threshold(symbol) v, get_price_change_threshold(symbol) p "
        "FROM some_symbols"
    ).collect()
    assert {tuple(r) for r in rows} == {("ETH/USDT", 3.8, 3.5, 4.0), ("??", 3.5, 3.0, 5.0)}


DETECT = "is_z_anomaly boolean, is_volume_anomaly boolean, is_price_change_anomaly boolean, is_if_anomaly boolean"


@pytest.mark.parametrize("flags,kind,score,quality", [
    ((True, True, True, True), "filtered", 4.0 / 2.0 * 0.7, "high"),
    ((True, True, True, False), "z", 4.0, "medium"),
    ((False, True, True, True), "if", 0.7, "medium"),
    ((False, True, True, False), "pct", 6.0, "low"),
    ((False, True, False, False), "volume", 3.0, "low"),
    ((False, False, False, False), "none", 0.0, "none"),
])
def test_fusion_priority(spark, flags, kind, score, quality):
    df = spark.createDataFrame([flags], DETECT).withColumns({
        "z_score": F.lit(-4.0), "z_threshold": F.lit(2.0), "if_anomaly_score": F.lit(0.7),
        "price_change_pct": F.lit(-6.0), "volume_spike": F.lit(3.0),
    })
    row = detection.fuse(df).first()
    assert (row["anomaly_type"], row["detection_quality"]) == (kind, quality)
    assert row["anomaly_score"] == pytest.approx(score) and row["is_anomaly"] == (kind != "none")


def test_rules_are_strict_and_null_safe(spark):
    df = spark.createDataFrame(
        [(2.0, 2.0, -2.0), (-2.1, 2.1, 2.1), (None, None, None)],
        "z_score double, volume_spike double, price_change_pct double",
    ).withColumns({c: F.lit(2.0) for c in ("z_threshold", "volume_threshold", "price_change_threshold")})
    rows = detection.rule_flags(df).select("is_z_anomaly", "is_volume_anomaly", "is_price_change_anomaly").collect()
    assert [tuple(r) for r in rows] == [(False,) * 3, (True,) * 3, (False,) * 3]


def test_rolling_labels(spark):
    rows = [(60, 4.0, True), (60, 4.0, False), (60, 1.0, True), (60, 1.0, False), (10, 9.0, True)]
    df = spark.createDataFrame(rows, "history_length bigint, z_score double, is_if_anomaly boolean").withColumn("symbol", F.lit("A"))
    assert sorted(r["anomaly_type"] for r in detection.rolling_labels(df).collect()) == [
        "filtered_isoforest", "isoforest", "z_score", "z_score",
    ]
    assert sorted(r[0] for r in detection.rolling_labels(df.drop("is_if_anomaly")).select("anomaly_type").collect()) == ["z_score"] * 2
    limits = spark.createDataFrame([("A", 0.5)], "symbol string, z_threshold double")
    assert detection.rolling_labels(df.drop("is_if_anomaly"), RollingConfig(), limits).count() == 4


def test_invalid_configs():
    with pytest.raises(ValueError):
        RollingConfig(block_rows=10)
    with pytest.raises(ValueError):
        RollingConfig(vwap_window=5000)
