"""Per-key state on streams: rolling history of a symbol, alert cooldown, and the keys of alerts already sent."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tradewatch.config import RollingConfig
from tradewatch.operators.cooldown import passing, thinnable
from tradewatch.operators.rolling import (
    MEASURED_DDL, RunningMeasures, features_from_measures, rolling_input,
)

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HISTORY = ["event_time", "trade_id", "price", "quantity", "is_buyer_maker"]
_PACKED = np.dtype([("us", "<i8"), ("trade_id", "<i8"), ("price", "<f8"), ("quantity", "<f8"), ("is_buyer_maker", "<i4")])
#: A trade of the batch at hand, as it is held until its batch is in order: 41 bytes.
_FRESH = np.dtype([*_PACKED.descr, ("injected", "<i4"), ("no_id", "?")])
#: Trades that are measured and handed on at once.
PIECE_ROWS = 20_000
#: Alert keys are spread over so many state groups.
ALERT_BUCKETS = 64
_SWEEP_MS = 3_600_000


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB state store; set before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype(np.int64)


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(["event_time", "trade_id"], kind="stable", ignore_index=True)


def _as_history(rows: pd.DataFrame) -> np.ndarray:
    """Trades as one array of fixed-width records."""
    out = np.empty(len(rows), _PACKED)
    out["us"] = _micros(rows["event_time"])
    for name in _HISTORY[1:]:
        out[name] = rows[name].fillna(0).to_numpy()
    return out


def _as_fresh(rows: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(rows), _FRESH)
    out["us"], out["no_id"] = _micros(rows["event_time"]), rows["trade_id"].isna()
    out["trade_id"] = rows["trade_id"].fillna(0).to_numpy()
    for name in ("price", "quantity", "is_buyer_maker", "injected"):
        out[name] = rows[name].to_numpy()
    return out


def _measurable(records: np.ndarray) -> list[np.ndarray]:
    """The columns that ``measure_rows`` takes."""
    price, quantity = (np.where(np.isnan(records[c]), 0.0, records[c]) for c in ("price", "quantity"))
    return [records["us"].copy(), price, quantity, records["is_buyer_maker"].astype(np.int64)]


class RollingHistory(StatefulProcessor):
    """Keeps the last ``window - 1`` trades of a symbol and measures each new trade against them.

    The history is one binary value of fixed-width records, read and written whole. Trades of one batch are taken in
    event order; a trade older than those already seen in earlier batches is taken as it arrives. A symbol is one group
    of one task here, which holds the batch's trades of the symbol as records of 41 bytes and their order, and measures
    them piece by piece; ``rolling_batches`` is the form for symbols that outgrow it.
    """

    def __init__(self, config: RollingConfig):
        self.config = config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getValueState("history", "records binary")

    def _kept(self) -> np.ndarray:
        return np.frombuffer(bytes(self.history.get()[0]), _PACKED) if self.history.exists() else np.empty(0, _PACKED)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Seed the history of a symbol; the seed may arrive in several pieces."""
        seed = np.concatenate([self._kept(), _as_history(_in_order(initialState))])
        self._keep(seed[np.lexsort((seed["trade_id"], seed["us"]))])

    def _keep(self, records: np.ndarray) -> None:
        self.history.update((records[max(0, len(records) - self.config.window + 1) :].tobytes(),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = bytearray()
        for part in rows:
            arrived += _as_fresh(part).tobytes()
        fresh, kept = np.frombuffer(arrived, _FRESH), self._kept()
        order = np.lexsort((fresh["trade_id"], fresh["no_id"], fresh["us"]))
        running = RunningMeasures(self.config, *_measurable(kept))
        for start in range(0, len(order), PIECE_ROWS):
            yield self._measured(key[0], fresh[order[start:start + PIECE_ROWS]], running)
        newest = fresh[order[max(0, len(order) - self.config.window + 1):]]
        self._keep(np.concatenate([kept, newest[list(_PACKED.names)].astype(_PACKED)]))

    def _measured(self, symbol: str | None, trades: np.ndarray, running: RunningMeasures) -> pd.DataFrame:
        out = {"symbol": pd.Series([symbol] * len(trades), dtype=object)}
        out["event_time"] = pd.Series(trades["us"].astype("datetime64[us]").astype("datetime64[ns]"))
        out["trade_id"] = pd.Series(trades["trade_id"]).astype("Int64").mask(pd.Series(trades["no_id"]))
        for name in ("price", "quantity", "is_buyer_maker", "injected"):
            out[name] = pd.Series(trades[name])
        for name, (values, missing) in running.extend(*_measurable(trades)).items():
            column = pd.Series(values)
            if missing is not None:
                kind = "Int64" if column.dtype.kind == "i" else "Float64"
                column = column.astype(kind).mask(pd.Series(missing))
            out[name] = column
        names = [field.split()[0] for field in MEASURED_DDL.split(", ")]
        return pd.DataFrame(out)[names]

    def close(self) -> None:
        pass


class SentAlerts(StatefulProcessor):
    """Lets the first alert of each key pass; a key is forgotten ``hours`` after it was sent, by the processing clock.

    Keys carry the time of sending. An expired key counts as unknown at once and is removed by a sweep of its bucket,
    which runs when the bucket gets rows and its last sweep is an hour old. (State with a built-in time to live makes
    a query run empty batches for ever, so one that ends when its input is read would never end.)
    """

    def __init__(self, hours: float, order: list[str], clock: Callable[[], float] = time.time):
        self.ttl, self.order, self.clock = int(hours * 3_600_000), order, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sent = handle.getMapState("sent", "alert_key string", "ms bigint")
        self.swept = handle.getValueState("swept", "ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = int(self.clock() * 1000)
        if not self.swept.exists() or now - self.swept.get()[0] >= _SWEEP_MS:
            old = [k for k, (ms,) in self.sent.iterator() if now - ms >= self.ttl]
            for k in old:
                self.sent.removeKey(k)
            self.swept.update((now,))
        fresh = pd.concat(list(rows), ignore_index=True).sort_values(self.order, na_position="first", kind="stable")
        fresh = fresh.drop_duplicates("alert_key")
        fresh = fresh[[not self._known((k,), now) for k in fresh["alert_key"]]]
        for k in fresh["alert_key"]:
            self.sent.updateValue((k,), (now,))
        yield fresh

    def _known(self, key: tuple, now: int) -> bool:
        return self.sent.containsKey(key) and now - self.sent.getValue(key)[0] < self.ttl

    def close(self) -> None:
        pass


class Cooldown(StatefulProcessor):
    """Lets an event of a key pass when none has passed for ``seconds``, by event time."""

    def __init__(self, seconds: int):
        self.gap = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = _in_order(pd.concat(list(rows), ignore_index=True))
        times = _micros(fresh["event_time"])
        picked = passing(times, self.gap, self.last.get()[0] + self.gap) if self.last.exists() else passing(times, self.gap)
        if len(picked):
            self.last.update((int(times[picked[-1]]),))
        yield fresh.iloc[picked]

    def close(self) -> None:
        pass


def stream_rolling_features(
    trades: DataFrame, config: RollingConfig = RollingConfig(), history: DataFrame | None = None
) -> DataFrame:
    """Rolling features of a trade stream; same columns and values as the batch form.

    ``history`` (a batch frame, see ``warm_start_history``) seeds the state of a query's first run.
    """
    use_rocksdb(trades.sparkSession)
    seed = rolling_input(history).groupBy("symbol") if history is not None else None
    measured = rolling_input(trades).groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=RollingHistory(config), outputStructType=MEASURED_DDL, outputMode="Append", timeMode="None",
        initialState=seed,
    )
    return features_from_measures(measured, config)


def stream_cooldown(detections: DataFrame, seconds: int = 60) -> DataFrame:
    """Detections of a stream that pass the cooldown of their (symbol, type); see ``thin`` for null times and 0 seconds."""
    detections = thinnable(detections, seconds)
    if seconds == 0:
        return detections
    use_rocksdb(detections.sparkSession)
    return detections.groupBy("symbol", "anomaly_type").transformWithStateInPandas(
        statefulProcessor=Cooldown(seconds), outputStructType=detections.schema, outputMode="Append", timeMode="None",
    )


def _first_of_task(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Per key the least row of a task's batch, so that copies of one alert don't travel. Holds a row per key."""
    least: dict = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for row in batch.to_pylist():
            order = tuple((v is not None, v) for v in row.values())
            if row[key] not in least or order < least[row[key]][0]:
                least[row[key]] = (order, row)
    if schema is not None:
        yield pa.RecordBatch.from_pylist([row for _, row in least.values()], schema=schema)


def stream_first_alerts(keyed: DataFrame, hours: float = 24.0, clock: Callable[[], float] = time.time) -> DataFrame:
    """Alerts of a stream whose key has not been sent in the last ``hours``; of several in one batch the least row.

    Keys live in the state store and are purged, spread over buckets; neither the outbox nor any other table is
    read. No alert is refused for the age of its event.
    """
    if hours <= 0:
        raise ValueError("keys must be remembered for some time")
    use_rocksdb(keyed.sparkSession)
    names, schema = keyed.columns, keyed.schema
    slim = keyed.mapInArrow(lambda batches: _first_of_task(batches, "alert_key"), schema)
    bucket = F.pmod(F.xxhash64("alert_key"), F.lit(ALERT_BUCKETS)).alias("bucket")
    first = slim.select("*", bucket).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=SentAlerts(hours, names, clock), outputStructType=slim.select("*", bucket).schema, outputMode="Append",
        timeMode="None",
    )
    return first.select(names)
