"""Streams give the batch result; restarts lose and repeat nothing; late rows are dropped."""

import os
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.config import ForestConfig, RetrainPolicy, RollingConfig, WindowConfig
from tradewatch.operators import windowed
from tradewatch.operators.cooldown import thin
from tradewatch.operators.detection import detect_windows, stub_model_flags
from tradewatch.operators.rolling import rolling_features, warm_start_history
from tradewatch.sinks import tables
from tradewatch.sinks.tables import append_stream, checkpoint_path
from tradewatch.sources.models import load_models
from tradewatch.streaming import fanout, monitor, retrain, stateful, windows

WINDOWS = WindowConfig("1 day", "8 hours")
ONCE = {"availableNow": True}


def add_file(df, folder, wait=True):
    """One more file in ``folder``; files are picked up in order of modification time."""
    df.coalesce(1).write.mode("append").parquet(folder)
    if wait:
        time.sleep(1.1)


def slices(trades, parts=3):
    low, high = trades.agg(F.min("trade_id"), F.max("trade_id")).first()
    step = (high - low + 1) / parts
    return [
        trades.where((F.col("trade_id") >= low + i * step) & (F.col("trade_id") < low + (i + 1) * step))
        for i in range(parts)
    ]


def run(df, path, name="t"):
    query = append_stream(
        df, f"{path}/table", checkpoint_path(path, name), f"{name}_{uuid.uuid4().hex[:6]}", ONCE
    ).start()
    query.awaitTermination()
    return query


def stream_of(spark, trades, folder):
    os.makedirs(f"{folder}/in", exist_ok=True)
    return windows.file_stream(spark, f"{folder}/in", trades.schema, files_per_trigger=1)


def same(a, b, key, tolerance=1e-9):
    a, b = (df.toPandas().sort_values(key, ignore_index=True) for df in (a, b))
    assert len(a) == len(b)
    for name in a.columns:
        if a[name].dtype.kind == "f":
            np.testing.assert_allclose(a[name], b[name], rtol=tolerance, atol=tolerance, err_msg=name)
        else:
            assert (a[name] == b[name]).all(), name


def test_window_stream_over_files_equals_closed_windows_of_batch(spark, small_trades, folder):
    for part in slices(small_trades):
        add_file(part, f"{folder}/in")
    streamed = windows.stream_window_features(stream_of(spark, small_trades, folder), WINDOWS)
    run(streamed, folder)
    batch = windowed.window_features(small_trades, WINDOWS)
    closed = windows.closed_windows(batch, small_trades, WINDOWS)
    assert 0 < closed.count() < batch.count()
    columns = ["symbol", "window_start", "first_price", "last_price", "avg_price", "z_score", "trade_count", "hour"]
    same(spark.read.parquet(f"{folder}/table").select(columns), closed.select(columns), ["symbol", "window_start"])


def test_restart_continues_and_late_rows_are_dropped(spark, small_trades, folder):
    first, second, third = slices(small_trades)
    late = first.limit(5).withColumn("trade_id", F.col("trade_id") + 100_000)
    streamed = windows.stream_window_features(stream_of(spark, small_trades, folder), WINDOWS)
    add_file(first, f"{folder}/in")
    run(streamed, folder)
    early = spark.read.parquet(f"{folder}/table").count()
    add_file(second, f"{folder}/in")
    run(streamed, folder)
    add_file(late, f"{folder}/in")
    query = run(streamed, folder)
    dropped = sum(monitor.progress_row(p)["late_rows"] for p in query.recentProgress)
    # Late rows are partially aggregated before they meet the state: at least one per symbol window.
    assert dropped >= 1
    add_file(third, f"{folder}/in")
    run(streamed, folder)
    closed = windows.closed_windows(windowed.window_features(small_trades, WINDOWS), small_trades, WINDOWS)
    columns = ["symbol", "window_start", "trade_count", "last_price"]
    table = spark.read.parquet(f"{folder}/table")
    assert early < table.count()
    same(table.select(columns), closed.select(columns), ["symbol", "window_start"])


def test_rolling_stream_over_files_and_restart_equals_batch(spark, small_trades, folder):
    config = RollingConfig(window=60, min_history=20, vwap_window=40, spike_window=30)
    streamed = stateful.stream_rolling_features(stream_of(spark, small_trades, folder), config)
    parts = slices(small_trades, 4)
    for part in parts[:3]:
        add_file(part, f"{folder}/in")
    run(streamed, folder)
    add_file(parts[3], f"{folder}/in")
    run(streamed, folder)
    columns = [
        "trade_id", "symbol", "history_length", "rolling_mean", "rolling_std", "z_score", "vwap", "price_velocity",
        "volume_spike", "volume_ratio", "buy_pressure", "price_change_pct", "time_gap_sec", "trading_session",
    ]
    same(
        spark.read.parquet(f"{folder}/table").select(columns), rolling_features(small_trades, config).select(columns), ["trade_id"]
    )


def test_rolling_stream_with_warm_start_equals_batch_tail(spark, small_trades, folder):
    config = RollingConfig(window=60, min_history=20, vwap_window=40, spike_window=30)
    past, recent = slices(small_trades, 2)
    add_file(recent, f"{folder}/in")
    last = past.agg(F.max("event_time")).first()[0]
    seed = warm_start_history(past, last, minutes=60 * 24 * 40, rows=config.window)
    run(stateful.stream_rolling_features(stream_of(spark, small_trades, folder), config, seed), folder)
    columns = ["trade_id", "history_length", "rolling_mean", "z_score", "vwap", "buy_pressure", "time_gap_sec"]
    batch = rolling_features(small_trades, config).join(recent.select("trade_id"), "trade_id", "left_semi")
    same(spark.read.parquet(f"{folder}/table").select(columns), batch.select(columns), ["trade_id"])


def test_rolling_stream_takes_old_trades_as_they_arrive(spark, folder):
    ddl = "symbol string, trade_id bigint, s double, price double, quantity double, is_buyer_maker boolean"

    def frame(rows):
        return spark.createDataFrame([("A", i, float(s), p, 1.0, False) for i, s, p in rows], ddl).select(
            "*", F.timestamp_seconds("s").alias("event_time")
        )

    first, second = frame([(1, 100, 10.0), (2, 110, 11.0)]), frame([(3, 50, 22.0)])
    add_file(first, f"{folder}/in")
    add_file(second, f"{folder}/in")
    run(stateful.stream_rolling_features(stream_of(spark, first, folder)), folder)
    row = spark.read.parquet(f"{folder}/table").where("trade_id = 3").first()
    assert row["price_change"] == 11.0 and row["time_gap_sec"] == 0.0 and row["history_length"] == 3


def test_cooldown_stream_equals_batch(spark, small_trades, folder):
    found = small_trades.select(
        "trade_id", "symbol", "event_time", F.when(F.col("price") > 40, "price").otherwise("other").alias("anomaly_type")
    )
    for part in slices(found):
        add_file(part, f"{folder}/in")
    run(stateful.stream_cooldown(stream_of(spark, found, folder), 86_400), folder)
    same(spark.read.parquet(f"{folder}/table"), thin(found, ["symbol", "anomaly_type"], 86_400), ["trade_id"])


def test_fanout_writes_both_tables_and_replays_in_place(spark, small_trades, folder):
    for part in slices(small_trades):
        add_file(part, f"{folder}/in")
    detected = detect_windows(
        windows.stream_window_features(stream_of(spark, small_trades, folder), WINDOWS), model=stub_model_flags
    )
    fanout.fanout_stream(detected, folder, checkpoint_path(folder, "f"), ONCE).start().awaitTermination()
    trades = spark.read.parquet(f"{folder}/trades")
    anomalies = spark.read.parquet(f"{folder}/anomalies")
    closed = windows.closed_windows(windowed.window_features(small_trades, WINDOWS), small_trades, WINDOWS)
    assert trades.count() == closed.count()
    assert 0 < anomalies.count() < trades.count()

    batch = detect_windows(windowed.window_features(small_trades, WINDOWS), model=stub_model_flags)
    write = fanout.write_both(f"{folder}/again")
    write(batch, 7)
    write(batch, 7)
    assert spark.read.parquet(f"{folder}/again/trades").count() == batch.count()


def test_outbox_sends_each_alert_once_across_restarts(spark, small_trades, folder):
    found = windowed.anomalies_output(
        detect_windows(windowed.window_features(small_trades, WINDOWS), model=stub_model_flags)
    )
    add_file(found, f"{folder}/in")
    stream = windows.file_stream(spark, f"{folder}/in", found.schema)
    for _ in range(2):
        fanout.outbox_stream(stream, folder, checkpoint_path(folder, "o"), ONCE).start().awaitTermination()
    outbox = spark.read.parquet(f"{folder}/outbox")
    distinct = found.select("symbol", "timestamp", "anomaly_type", F.round("anomaly_score", 3)).distinct().count()
    assert outbox.count() == outbox.select("alert_key").distinct().count() == distinct
    assert outbox.first()["message"].startswith("ANOMALY: ")


def test_outbox_refuses_no_alert_for_its_age(spark, small_trades, folder):
    found = windowed.anomalies_output(
        detect_windows(windowed.window_features(small_trades, WINDOWS), model=stub_model_flags)
    ).cache()
    times = sorted(r[0] for r in found.select("timestamp").collect())
    middle = times[len(times) // 2]
    newer, older = found.where(F.col("timestamp") >= F.lit(middle)), found.where(F.col("timestamp") < F.lit(middle))
    for part in (newer, older.union(newer), older):
        add_file(part, f"{folder}/in")
    stream = windows.file_stream(spark, f"{folder}/in", found.schema, files_per_trigger=1)
    fanout.outbox_stream(stream, folder, checkpoint_path(folder, "o"), ONCE).start().awaitTermination()
    outbox = spark.read.parquet(f"{folder}/outbox")
    distinct = found.select("symbol", "timestamp", "anomaly_type", F.round("anomaly_score", 3)).distinct().count()
    assert outbox.count() == outbox.select("alert_key").distinct().count() == distinct
    assert outbox.select("batch_id").distinct().count() == 2 and not older.isEmpty()


def test_progress_log(spark, small_trades, folder):
    listener = monitor.ProgressLog(spark, f"{folder}/metrics")
    spark.streams.addListener(listener)
    try:
        add_file(small_trades, f"{folder}/in")
        run(windows.file_stream(spark, f"{folder}/in", small_trades.schema), folder, "copy")
        deadline = time.time() + 20
        while time.time() < deadline:
            if os.path.isdir(f"{folder}/metrics/progress"):
                table = monitor.progress_table(spark, f"{folder}/metrics")
                if table.agg(F.sum("input_rows")).first()[0] == 1000:
                    break
            time.sleep(0.5)
        row = table.where("input_rows = 1000").first()
        assert row["query"].startswith("copy_") and row["processed_rows_per_sec"] > 0
    finally:
        spark.streams.removeListener(listener)


def test_lag_from_progress():
    class Source:
        endOffset = '{"trades": {"0": 40, "1": -1}}'
        latestOffset = '{"trades": {"0": 100, "1": 30}}'

    class Progress:
        sources = [Source]

    assert monitor.consumer_lag(Progress) == [("trades-0", 60), ("trades-1", 30)]


def test_single_file_option(spark, small_trades, folder):
    add_file(small_trades.repartition(4), f"{folder}/in", wait=False)
    stream = windows.file_stream(spark, f"{folder}/in", small_trades.schema)
    writer = append_stream(stream, f"{folder}/table", checkpoint_path(folder, "one"), "one_file", ONCE, single_file=True)
    writer.start().awaitTermination()
    assert len(spark.read.parquet(f"{folder}/table").inputFiles()) == 1


@pytest.mark.parametrize("name", ["trades", "anomalies"])
def test_checkpoints_are_stable(name):
    assert checkpoint_path("/a", name) == checkpoint_path("/a/", name)


def test_models_are_trained_and_used_on_the_way(spark, medium_trades, folder):
    for part in slices(medium_trades, 3):
        add_file(part, f"{folder}/in")
    rolling = RollingConfig(tick_scale=2)
    config = ForestConfig(n_trees=20, max_samples=64, contamination=0.02)
    policy = RetrainPolicy(first=100, every=1500)
    features = stateful.stream_rolling_features(stream_of(spark, medium_trades, folder), rolling)
    retrain.retraining_stream(
        features, folder, checkpoint_path(folder, "r"), config, policy, rolling, ONCE
    ).start().awaitTermination()
    # About 2,000 usable trades per symbol arrive in three batches: trained after the first and the third.
    versions = sorted(r[0] for r in spark.read.parquet(f"{folder}/models/meta").select("version").distinct().collect())
    assert [int(v) for v in versions] == [0, 2]
    found = spark.read.parquet(f"{folder}/detections").groupBy("batch_id", "anomaly_type").count().collect()
    by_model = {r["batch_id"] for r in found if "isoforest" in r["anomaly_type"]}
    assert by_model == {1, 2}
    nodes, meta = load_models(spark, f"{folder}/models", ["BTC/USDT"])
    assert [r["symbol"] for r in meta.collect()] == ["BTC/USDT"] and nodes.select("symbol").distinct().count() == 1


def test_metrics_files(spark, folder):
    row = spark.createDataFrame([(1, 2.0)], "total_trades bigint, rate double")
    tables.write_metrics(row, folder)
    tables.write_metrics(row, folder)
    assert spark.read.json(f"{folder}/latest").count() == 1
    assert spark.read.option("header", True).csv(f"{folder}/history").count() == 2
    assert "detection_time" in tables.with_detection_time(row).columns
