"""Alert identity and text, percentiles, lag, evaluation."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.config import AlertConfig, InjectionConfig
from tradewatch.operators import alerts, evaluation, marts, metrics

PAYLOAD = (
    "symbol string, timestamp string, price double, z_score double, price_change_pct double, volume_spike double, "
    "anomaly_type string, anomaly_score double, source string"
)


def test_alert_key_is_the_documented_hash(spark):
    rows = [
        ("BTC/USDT", "2025-08-10T18:22:30", 67123.5, 4.1, -2.3, 3.7, "z", 4.1, "streaming"),
        (None, None, None, None, None, None, "z", None, None),
    ]
    keyed = alerts.with_alert_key(spark.createDataFrame(rows, PAYLOAD)).collect()
    want = ["BTC/USDT|2025-08-10T18:22:30|z|4.1", "||z|0.0"]
    assert [r["alert_key"] for r in keyed] == [hashlib.sha1(w.encode()).hexdigest() for w in want]


def test_alert_message_leaves_out_missing_parts(spark):
    rows = [
        ("BTC/USDT", "2025-08-10T18:22:30", 67123.5, 4.1, -2.3, 3.7, "z", 4.1, "streaming"),
        ("A", "t", None, None, None, None, "z", 1.0, "s"),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, PAYLOAD).select(alerts.alert_message()).collect()]
    assert got == [
        "ANOMALY: BTC/USDT | type=z score=4.1 | time=2025-08-10T18:22:30 | price=67123.5 | z=4.1 | pct=-2.3"
        " | vol_spike=3.7 | source=streaming",
        "ANOMALY: A | type=z score=1.0 | time=t | source=s",
    ]


def test_rich_message(spark):
    df = spark.createDataFrame(
        [("z_score", "BTC/USDT", 67123.456, 4.125, 0.0, 2.5, -1.255), ("other_kind", "A", 1.0, 0.0, 3.0, 1.0, 0.0)],
        "anomaly_type string, symbol string, price double, z_score double, price_change_pct double, "
        "volume_spike double, vwap_deviation double",
    ).withColumn("event_time", F.lit("2025-08-10 18:22:30").cast("timestamp"))
    first, second = (r[0] for r in df.select(alerts.rich_alert_message()).collect())
    assert first == (
        "📊 **ANOMALY DETECTED**\n\n**Type:** Z Score\n**Symbol:** BTC/USDT\n**Time:** 2025-08-10T18:22:30\n"
        f"**Price:** $67,123.46\n**Z-Score:** {4.125:.2f}\n**Volume Spike:** 2.5x normal\n**VWAP Deviation:** {-1.255:.2f}%\n"
    )
    assert second.startswith("🚨") and "**Price Change:** 3.00%" in second and "Volume Spike" not in second
    assert alerts.alert_fields(df.withColumn("trade_id", F.lit(1))).first()["type"] == "Z Score"


def test_payloads_respect_the_high_water_mark(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-01 00:00:00", float("nan")), ("A", "2024-01-01 00:04:00", 1.0), ("A", "2024-01-01 00:05:30", 2.0)],
        "symbol string, t string, price double",
    ).select("symbol", F.col("t").cast("timestamp").alias("timestamp"), "price")
    now = "2024-01-01 00:06:00"
    assert alerts.alert_payloads(df, now).count() == 2
    assert alerts.alert_payloads(df, now, last_sent="2024-01-01 00:05:00").count() == 1
    rows = alerts.alert_payloads(df, now, config=AlertConfig(lookback_minutes=60)).orderBy("timestamp").collect()
    assert rows[0]["price"] is None and rows[0]["source"] == "dispatcher"
    assert rows[0]["timestamp"] == "2024-01-01T00:00:00"


def test_deduplicate_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.floor(F.col("id") / 1000)).alias("alert_key"), "id")
    once = alerts.deduplicate(df, ["id"])
    assert [r["id"] for r in once.collect()] == [0]
    assert "WindowGroupLimit" in once._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0] * 1000 + [7.0], list(range(101)), [-3.5, -1.0, 0.0, 0.0, 2.25, 1e9], [0.1] * 3 + [0.1000001] * 4,
])
def test_exact_percentiles(spark, values):
    rows = [(g, float(v)) for g in ("a", None) for v in values] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: r for r in metrics.exact_percentiles(df, "v", wanted, ["g"]).collect()}
    assert set(got) == {"a", None}
    for name, p in wanted.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, p)), name
        assert got[None][name] == pytest.approx(np.quantile(values, p)), name
    whole = metrics.exact_percentiles(df, "v", wanted).first()
    assert whole["p50"] == pytest.approx(np.quantile(values * 2, 0.5))


def test_latency_never_negative_and_empty_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 1.25)], "a double, b double").select(
        F.timestamp_millis((F.col("a") * 1000).cast("bigint")).alias("event_time"),
        F.timestamp_millis((F.col("b") * 1000).cast("bigint")).alias("detected_at"),
    )
    row = metrics.latency_percentiles(df).first()
    assert (row["e2e_p50_ms"], row["e2e_max_ms"]) == (125.0, 250.0)
    assert tuple(metrics.latency_percentiles(df.where("false")).first()) == (0.0, 0.0, 0.0, 0.0)


def test_lag(spark):
    df = spark.createDataFrame(
        [(1, 0, 10, 4), (1, 1, 10, -1), (2, 0, 20, 25), (2, 1, 8, None)], "sample int, partition int, high bigint, committed bigint"
    )
    assert tuple(metrics.lag_stats(df).first()) == (0, 6.0, 10)
    assert tuple(metrics.lag_stats(df.where("false")).first()) == (0, 0.0, 0)


def test_top_symbols_json(spark):
    top = spark.createDataFrame(
        [("A", 10, 1, 10.0, 5.0), ("B", 20, 0, 0.0, 6.0)],
        "symbol string, trades bigint, anomalies bigint, detect_rate_pct double, e2e_p95_ms double",
    )
    assert [e["symbol"] for e in json.loads(metrics.top_symbols_json(top).first()[0])] == ["B", "A"]


def test_confusion_and_report(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "truth int, predicted int")
    m = evaluation.confusion_matrix(df).first()
    assert (m["tp"], m["fn"], m["fp"], m["tn"]) == (3, 1, 2, 4)
    assert (m["precision"], m["recall"]) == (0.6, 0.75) and m["f1"] == pytest.approx(2 / 3)
    report = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert report["Normal"]["support"] == 6 and report["Anomaly"]["support"] == 4
    none = evaluation.confusion_matrix(df.where("truth = 0 AND predicted = 0")).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_injection_is_repeatable_and_near_its_rate(medium_trades):
    config = InjectionConfig(rate=0.05)
    a = evaluation.inject_spikes(medium_trades, config)
    b = evaluation.inject_spikes(medium_trades.repartition(7), config)
    assert a.exceptAll(b).isEmpty()
    share = a.where("injected").count() / 10_000
    assert 0.03 < share < 0.07
    assert a.where("injected").select("injection_kind").distinct().count() == 4
    assert evaluation.inject_percent(medium_trades, InjectionConfig(rate=0.0)).where("injected").count() == 0


def test_rates_of_symbols_without_anomalies(small_trades):
    rows = {r["symbol"]: r for r in marts.symbol_rates(small_trades, small_trades.where("false")).collect()}
    assert rows["TOTAL"]["trades"] == 1000 and rows["TOTAL"]["rate_pct"] == 0.0 and len(rows) == 6


def test_missing_symbols_are_counted(small_trades):
    holed = small_trades.withColumn("symbol", F.when(F.col("symbol") != "BTC/USDT", F.col("symbol")))
    found = holed.withColumn("z_score", F.lit(-4.0))
    rates = {r["symbol"]: r for r in marts.symbol_rates(holed, found).collect()}
    assert rates[None]["anomalies"] == rates[None]["trades"] > 0 and rates["TOTAL"]["anomalies"] == 1000
    assert all(r["anomaly_count"] > 0 for r in marts.market_kpis(holed, found).collect())
    assert all(r["anomaly_count"] > 0 for r in marts.candles_with_anomalies(holed, found, "1 hour").collect())


def test_recent_rows_take_any_spelling(small_trades):
    as_of = small_trades.agg(F.max("event_time")).first()[0]
    counts = {marts.recent_rows(small_trades, as_of, 10**6, symbol=s).count() for s in ("BTC/USDT", "btc-usdt", "BTCUSDT")}
    assert len(counts) == 1 and 0 not in counts


def test_candles_skip_empty_buckets(spark):
    df = spark.createDataFrame([("A", 1, 0.0, 5.0), ("A", 2, 10.0, 3.0), ("A", 3, 200.0, 4.0), ("A", 4, 300.0, None)],
                               "symbol string, trade_id bigint, s double, price double")
    df = df.select("*", F.lit(1.0).alias("quantity"), F.timestamp_seconds("s").alias("event_time"))
    rows = marts.candles(df, "1 minute").orderBy("bucket").collect()
    assert [(r["open"], r["high"], r["low"], r["close"], r["volume"], r["is_up"]) for r in rows] == [
        (5.0, 5.0, 3.0, 3.0, 2.0, False), (4.0, 4.0, 4.0, 4.0, 1.0, True),
    ]


def test_symbol_universe_spells_symbols_one_way_and_has_a_default(spark):
    from tradewatch.config import DEFAULT_SYMBOLS
    from tradewatch.operators.marts import symbol_universe

    trades = spark.createDataFrame([("btcusdt",), ("BTC-USDT",), (None,), (" ",)], "symbol string")
    found = spark.createDataFrame([("ETH/USDT",)], "symbol string")
    assert [r[0] for r in symbol_universe(trades, found).collect()] == ["BTC/USDT", "ETH/USDT"]
    none = trades.where("symbol is null")
    assert [r[0] for r in symbol_universe(none, found.limit(0)).collect()] == sorted(DEFAULT_SYMBOLS)
    assert symbol_universe(none, none, ()).count() == 0
