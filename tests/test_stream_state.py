"""State between batches: keys of sent alerts, packed history, and snapshots of the batch-wise rolling stream."""

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradewatch.config import RollingConfig
from tradewatch.operators.rolling import rolling_features
from tradewatch.streaming import rolling_batches, stateful

ROLLING = RollingConfig(tick_scale=2, window=120, block_rows=240)


class FakeMap:
    def __init__(self):
        self.held = {}

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]

    def iterator(self):
        return iter(list(self.held.items()))


class FakeValue:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class FakeHandle:
    def getMapState(self, *_):
        return FakeMap()

    def getValueState(self, *_):
        return FakeValue()


def test_alert_keys_live_for_their_time():
    now = [1000.0]
    state = stateful.SentAlerts(24, ["alert_key", "price"], lambda: now[0])
    state.init(FakeHandle())

    def sent(*rows):
        frame = pd.DataFrame(rows, columns=["alert_key", "price"])
        (out,) = state.handleInputRows((0,), iter([frame]), None)
        return list(out.itertuples(index=False, name=None))

    assert sent(("a", 2.0), ("a", 1.0), ("b", 3.0)) == [("a", 1.0), ("b", 3.0)]
    now[0] += 3600 * 23
    assert sent(("a", 0.0), ("c", 1.0)) == [("c", 1.0)]
    now[0] += 3600 * 1.5  # a and b are over 24 hours old, c is not
    assert sent(("c", 1.0)) == [] and set(state.sent.held) == {("c",)}
    assert sent(("a", 5.0)) == [("a", 5.0)]


def test_a_task_sends_one_row_per_alert():
    schema = pa.schema([("alert_key", pa.string()), ("price", pa.float64())])
    batches = [pa.RecordBatch.from_pylist(rows, schema=schema) for rows in (
        [{"alert_key": "a", "price": 2.0}, {"alert_key": "b", "price": 1.0}], [{"alert_key": "a", "price": None}],
    )]
    (out,) = stateful._first_of_task(iter(batches), "alert_key")
    assert out.to_pylist() == [{"alert_key": "a", "price": None}, {"alert_key": "b", "price": 1.0}]
    assert list(stateful._first_of_task(iter([]), "alert_key")) == []


def test_keys_must_be_remembered(spark):
    with pytest.raises(ValueError):
        stateful.stream_first_alerts(spark.createDataFrame([("a",)], "alert_key string"), 0)


@pytest.mark.parametrize("one_symbol", [False, True])
def test_batches_hand_over_their_history(spark, small_trades, folder, one_symbol):
    """Three batches, the second written twice, equal one pass; a symbol with all trades is cut into blocks."""
    trades = small_trades.withColumn("symbol", F.lit("A")) if one_symbol else small_trades
    write = rolling_batches.measure_batches(folder, ROLLING)
    parts = [trades.where(F.col("trade_id").between(a, b)) for a, b in ((0, 400), (401, 450), (451, 10_000))]
    for batch_id, part in [(0, parts[0]), (1, parts[1]), (1, parts[1]), (2, parts[2])]:
        write(part, batch_id)
    want = rolling_features(trades, ROLLING)
    numbers = [c for c, kind in want.dtypes if kind == "double"]
    shown = [*[c for c in want.columns if c not in numbers], *[F.round(c, 6).alias(c) for c in numbers]]
    got = spark.read.parquet(f"{folder}/features").select(*shown)
    assert got.count() == trades.count()
    assert got.exceptAll(want.select(*shown)).isEmpty()


def test_history_gets_no_rows_of_its_own(small_trades):
    old, new = small_trades.where("trade_id <= 500"), small_trades.where("trade_id > 500")
    got = rolling_features(new, ROLLING, history=old)
    want = rolling_features(small_trades, ROLLING).where("trade_id > 500")
    pick = ["trade_id", F.round("rolling_mean", 6), F.round("z_score", 6), "history_length"]
    assert got.count() == new.count() and got.select(pick).exceptAll(want.select(pick)).isEmpty()
    assert rolling_features(new, ROLLING, history=old.limit(0)).count() == new.count()
