"""Ordered passes hold a batch, not a group, and give the same results."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewatch.config import RollingConfig
from tradewatch.operators import cooldown, rolling
from tradewatch.operators.cooldown import passing
from tradewatch.operators.rolling import RunningMeasures, measure_rows
from tradewatch.plans import registry
from tradewatch.streaming import stateful
from tradewatch.streaming.windows import file_stream


@pytest.fixture()
def short_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_rolling_task_holds_batches_and_a_window(spark, medium_trades, short_batches, monkeypatch):
    """One symbol of 10,000 trades in one block: no call sees more than a few batches of it."""
    config = RollingConfig(window=100)

    def limited(micros, *rest):
        assert len(micros) <= 4 * 100 + 300 + 99, len(micros)
        return measure_rows(micros, *rest)

    one = medium_trades.withColumn("symbol", F.lit(None).cast("string"))
    whole = rolling.rolling_features(one, config, method="frame").toPandas().sort_values("trade_id", ignore_index=True)
    monkeypatch.setattr(rolling, "measure_rows", limited)
    passed = rolling.rolling_features(one, config).toPandas().sort_values("trade_id", ignore_index=True)
    assert len(passed) == len(whole) == 10_000
    for name in ("history_length", "rolling_mean", "rolling_std", "vwap", "price_velocity", "buy_pressure", "time_gap_sec"):
        np.testing.assert_allclose(passed[name].astype(float), whole[name].astype(float), rtol=1e-9, atol=1e-9, err_msg=name)


@pytest.mark.parametrize("piece", [1, 7, 60, 1000])
def test_pieces_measure_as_the_whole(piece):
    rng, config = np.random.default_rng(piece), RollingConfig(
        window=40, vwap_window=30, velocity_window=20, spike_window=10, pressure_window=5, tick_scale=2
    )
    n = 333
    rows = (np.arange(n) * 7, rng.normal(100, 3, n).round(2), rng.integers(1, 90, n).astype(float), rng.integers(0, 2, n))
    running, parts = RunningMeasures(config), []
    for at in range(0, n, piece):
        parts.append(running.extend(*[c[at:at + piece] for c in rows]))
        assert len(running.carried[0]) <= config.window - 1
    for name, (values, missing) in measure_rows(*rows, config).items():
        got = np.concatenate([p[name][0] for p in parts])
        if missing is not None:
            assert (np.concatenate([p[name][1] for p in parts]) == missing).all(), name
            got, values = got[~missing], values[~missing]
        np.testing.assert_allclose(got, values, rtol=1e-9, atol=1e-9, err_msg=name)


@pytest.mark.parametrize("block_rows", [1_000_000, 700])
def test_a_cooldown_task_holds_batches(spark, medium_trades, short_batches, monkeypatch, block_rows):
    """One key of 10,000 events: whole or in cells, no fold sees more than a batch, and the same events pass."""
    one = medium_trades.withColumn("symbol", F.lit("A")).select("symbol", "trade_id", "event_time").where("event_time is not null")

    def limited(times, *rest):
        assert len(times) <= 300, len(times)
        return passing(times, *rest)

    times = np.sort(one.select(F.unix_micros("event_time").alias("us")).distinct().toPandas()["us"].to_numpy())
    expected = times[passing(times, 3600 * 1_000_000)]
    monkeypatch.setattr(cooldown, "passing", limited)
    found = cooldown.thin(one, ["symbol"], 3600, block_rows=block_rows).select(F.unix_micros("event_time").alias("us")).toPandas()
    assert np.sort(found["us"].to_numpy()).tolist() == expected.tolist()


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_a_rolling_stream_hands_its_batch_on_in_pieces(monkeypatch):
    """A symbol's batch that comes in parts, out of order and with a missing id, is measured in pieces, as in order."""
    config, n = RollingConfig(window=50, vwap_window=40, min_history=5, spike_window=20), 500
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({
        "symbol": "A", "trade_id": np.arange(n).astype(float), "event_time": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) // 2, "s"),
        "price": rng.normal(100, 3, n), "quantity": rng.uniform(1, 9, n), "is_buyer_maker": rng.integers(0, 2, n), "injected": 0,
    })
    rows.loc[7, "trade_id"] = np.nan  # the later of its instant either way
    mixed = rows.iloc[rng.permutation(n)].reset_index(drop=True)
    monkeypatch.setattr(stateful, "PIECE_ROWS", 64)
    processor = stateful.RollingHistory(config)
    processor.history = _Value()
    got = []
    for low, high in ((0, 300), (300, 500)):  # two batches, the second later than the first
        batch = mixed[mixed["event_time"].isin(rows["event_time"][low:high])]
        parts = list(processor.handleInputRows(("A",), iter([batch[:70], batch[70:]]), None))
        assert max(map(len, parts)) <= 64
        got += parts
    got = pd.concat(got, ignore_index=True)
    micros = rows["event_time"].to_numpy().astype("datetime64[us]").astype(np.int64)
    whole = measure_rows(micros, rows["price"].to_numpy(), rows["quantity"].to_numpy(), rows["is_buyer_maker"].to_numpy(), config)
    assert got["price"].tolist() == rows["price"].tolist() and got["trade_id"].isna().tolist() == rows["trade_id"].isna().tolist()
    np.testing.assert_allclose(got["sum_price"], whole["sum_price"][0], rtol=1e-12)
    np.testing.assert_allclose(got["m2_price"], whole["m2_price"][0], rtol=1e-9, atol=1e-9)
    assert len(processor.history.get()[0]) == 49 * stateful._PACKED.itemsize


def test_a_cooldown_has_no_table_per_cell(medium_trades):
    plan = cooldown.thin(medium_trades, ["symbol"], 3600, block_rows=50)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" not in plan and "MapInArrow" in plan


def test_large_parts_of_a_stream_are_several_files_of_one_trigger(spark, medium_trades, monkeypatch, folder):
    """Each trigger still takes exactly one part, in order, and a part is read by several tasks."""
    monkeypatch.setattr(registry, "PART_FILE_ROWS", 700)
    slices, seen, taken = registry.time_slices(medium_trades), {}, []

    def note(batch, batch_id):
        row = batch.agg(F.count("*").alias("n"), F.min("event_time").alias("low")).first()
        seen[batch_id] = (row["n"], row["low"])

    def opened(spark, path, schema, files_per_trigger):
        taken.append((files_per_trigger, len(spark.read.parquet(path).inputFiles())))
        return file_stream(spark, path, schema, files_per_trigger=files_per_trigger)

    monkeypatch.setattr(registry, "file_stream", opened)
    stream = registry.sliced_stream(spark, slices)
    stream.writeStream.foreachBatch(note).option("checkpointLocation", folder).trigger(availableNow=True).start().awaitTermination()
    expected = [part.agg(F.count("*"), F.min("event_time")).first() for part in slices]
    assert taken == [(3, 12)] and len(seen) == 4
    assert [seen[i] for i in range(4)] == [tuple(row) for row in expected]
