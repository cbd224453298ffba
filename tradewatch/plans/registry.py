"""Every operator as a named query over the test tables, for side-by-side checks in SQL.

Each entry reads the whole ``events`` table through the trade adapter. ``canonical`` puts results
into a comparable form: doubles to six decimals, times without zone, integers as bigint.
"""

from __future__ import annotations

import time
import uuid
import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.config import (
    AlertConfig, ForestConfig, InjectionConfig, RetrainPolicy, RollingConfig, Thresholds, WindowConfig,
)
from tradewatch.functions.numbers import coerce_double, half_up
from tradewatch.functions.symbols import normalize_symbol, stream_symbol
from tradewatch.functions.timestamps import calendar_columns, decode_epoch
from tradewatch.operators import alerts, detection, evaluation, forest, marts, metrics, rolling, search, windowed
from tradewatch.operators.asof import as_of_join
from tradewatch.operators.cooldown import thin
from tradewatch.plans.flows import windowed_detections
from tradewatch.sources import decode, kafka, scan
from tradewatch.session import materialise, shared_folder
from tradewatch.sinks.tables import append_stream, checkpoint_path, write_table
from tradewatch.sources.events import load_event_trades, trades_from_events
from tradewatch.streaming import fanout, monitor, retrain, rolling_batches, stateful, windows
from tradewatch.streaming.windows import file_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the test runs: wide windows and low limits, so that every branch has rows.
WINDOWS = WindowConfig(duration="1 day", slide="8 hours", tick_scale=2)
LIMITS = {
    "BTC/USDT": Thresholds(z=2.2),
    "ETH/USDT": Thresholds(volume=1.97),
    "SOL/USDT": Thresholds(z=2.5, price_change=2000.0),
}
DEFAULT_LIMITS = Thresholds(z=2.0, volume=1.95, price_change=1500.0)
ROLLING = RollingConfig(tick_scale=2)
SPLIT_ROLLING = RollingConfig(tick_scale=2, window=120, block_rows=240)
REFITS = RetrainPolicy(first=100, every=700)
INJECTED = RollingConfig(tick_scale=4)  # injection multiplies prices by two-decimal factors
AS_OF = "2024-01-30 12:00:00"
WEEK = 10080
COOLDOWN_SECONDS = 21600
STUB_Z, STUB_PCT = 3.0, 20000.0


def canonical(df: DataFrame) -> DataFrame:
    """Comparable column forms."""
    def form(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = half_up(column)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[form(field) for field in df.schema])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return canonical(fn(spark, folder))

    QUERIES[fn.__name__] = run
    return fn


# ---- shared inputs ---------------------------------------------------------------------------

trades = load_event_trades


def window_features_of(spark: SparkSession, folder: str) -> DataFrame:
    return windowed.window_features(trades(spark, folder), WINDOWS)


def detections_of(spark: SparkSession, folder: str, model=None) -> DataFrame:
    return windowed_detections(
        trades(spark, folder), WINDOWS, LIMITS, DEFAULT_LIMITS, model or stub_model
    )


def stub_model(df: DataFrame) -> DataFrame:
    return detection.stub_model_flags(df, 2.1, 1800.0)


def rolling_stub(df: DataFrame) -> DataFrame:
    return detection.stub_model_flags(df, STUB_Z, STUB_PCT)


def rolling_of(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.rolling_features(trades(spark, folder), ROLLING)


def labels_of(spark: SparkSession, folder: str) -> DataFrame:
    return detection.rolling_labels(rolling_stub(rolling_of(spark, folder)), ROLLING)


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Kafka values made from the trades; some are cut short, empty or lack fields."""
    source = trades(spark, folder).withColumn("timestamp", F.unix_millis("event_time"))
    full = F.to_json(F.struct("symbol", "timestamp", "price", "quantity", "trade_id", "is_buyer_maker"))
    flagless = F.to_json(F.struct("symbol", "timestamp", "price", "quantity", "trade_id"))
    nameless = F.to_json(F.struct("timestamp", "price", "quantity", "trade_id"))
    kind = F.col("trade_id") % 10
    value = (
        F.when(kind == 3, F.substring(full, 1, 20)).when(kind == 5, "")
        .when(kind == 7, nameless).when(kind == 9, flagless).otherwise(full)
    )
    return source.select(F.encode(value, "utf-8").alias("value"))


def raw_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    source = trades(spark, folder)
    data = F.struct(
        F.replace("symbol", F.lit("/"), F.lit("")).alias("s"),
        F.unix_millis("event_time").alias("T"),
        F.format_string("%.2f", "price").alias("p"),
        F.format_string("%.1f", "quantity").alias("q"),
        F.col("trade_id").alias("t"),
        F.col("is_buyer_maker").alias("m"),
    )
    stream = F.concat(stream_symbol(F.col("symbol")), F.lit("@trade")).alias("stream")
    whole = F.to_json(F.struct(stream, data.alias("data")))
    bare = F.to_json(F.struct(stream))
    return source.select(F.when(F.col("trade_id") % 11 == 4, bare).otherwise(whole).alias("value"))


def spelled(df: DataFrame) -> DataFrame:
    """Trades with their symbols in several spellings."""
    s, kind = F.col("symbol"), F.col("trade_id") % 5
    joined = F.replace(s, F.lit("/"), F.lit(""))
    text = (
        F.when(kind == 0, joined).when(kind == 1, F.lower(F.replace(s, F.lit("/"), F.lit("-"))))
        .when(kind == 2, F.concat(F.lit("  "), s, F.lit(" "))).when(kind == 3, F.substring(s, 1, 3))
    )
    return df.withColumn("spelling", text)


# ---- sources and decoding --------------------------------------------------------------------

@query
def parse_trades_json(spark, folder):
    return decode.parse_trades(raw_messages(spark, folder))


@query
def malformed_counts(spark, folder):
    return decode.message_counts(raw_messages(spark, folder))


@query
def parse_exchange_envelope(spark, folder):
    return decode.parse_envelopes(raw_envelopes(spark, folder))


@query
def scan_parquet(spark, folder):
    return scan.scan_parquet(spark, folder, pattern="events.parquet").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.max("event_id").alias("last_id")
    )


@query
def scan_since(spark, folder):
    return scan.scan_since(spark, folder, "2024-01-20 00:00:00", time="ts", pattern="events.parquet").select(
        "event_id", "ts", "value"
    )


@query
def supported_symbols_only(spark, folder):
    return decode.supported_only(trades(spark, folder), ["BTC/USDT", "ETH/USDT", "SOL/USDT", "ADA/USDT"]).groupBy(
        "symbol"
    ).agg(F.count(F.lit(1)).alias("trades"))


@query
def trades_to_kafka_records(spark, folder):
    """Records written to Kafka form and read back through the decoder, with their key."""
    records = kafka.kafka_records(trades(spark, folder))
    return decode.parse_trades(records).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("quantity").alias("quantity"), F.max("trade_id").alias("last_id")
    )


@query
def epoch_autodetect(spark, folder):
    """The same instants sent by four feeds in four units, told apart by magnitude."""
    micros = F.unix_micros("event_time")
    seconds = F.floor(micros / 1_000_000)
    feeds = F.array(*[
        F.struct(F.lit(name).alias("feed"), (seconds * factor).alias("epoch"))
        for name, factor in (("a", 1), ("b", 1000), ("c", 1_000_000), ("d", 1_000_000_000))
    ])
    sent = trades(spark, folder).select("trade_id", F.inline(feeds))
    return decode_epoch(sent, "epoch", "decoded", by="feed").select("trade_id", "feed", "epoch_unit", "decoded")


@query
def normalize_symbols(spark, folder):
    return spelled(trades(spark, folder)).select(
        "trade_id", "spelling", normalize_symbol(F.col("spelling")).alias("normalized")
    )


QUERIES["normalize_symbol"] = QUERIES.pop("normalize_symbols")


@query
def stream_symbols(spark, folder):
    return spelled(trades(spark, folder)).select("trade_id", stream_symbol(F.trim("spelling")).alias("stream"))


QUERIES["stream_symbol"] = QUERIES.pop("stream_symbols")


@query
def coerce_numeric(spark, folder):
    raw = F.when(F.col("trade_id") % 4 == 1, F.concat(F.col("quantity").cast("bigint").cast("string"), F.lit("x"))).when(
        F.col("trade_id") % 4 == 2, ""
    ).otherwise(F.col("quantity").cast("bigint").cast("string"))
    return trades(spark, folder).select(
        "trade_id", coerce_double(raw).alias("parsed"), coerce_double(raw, 0.0).alias("filled")
    )


@query
def calendar_features(spark, folder):
    return trades(spark, folder).select("trade_id", *[
        c.alias(n) for n, c in calendar_columns(F.col("event_time")).items()
    ])


# ---- windowed model --------------------------------------------------------------------------

@query
def window_features(spark, folder):
    return window_features_of(spark, folder)


@query
def trades_output(spark, folder):
    return windowed.trades_output(window_features_of(spark, folder))


@query
def threshold_join(spark, folder):
    return detection.with_thresholds(window_features_of(spark, folder), LIMITS, DEFAULT_LIMITS).select(
        "symbol", "window_start", "z_threshold", "volume_threshold", "price_change_threshold"
    )


@query
def rule_flags(spark, folder):
    flagged = detection.rule_flags(
        detection.with_thresholds(window_features_of(spark, folder), LIMITS, DEFAULT_LIMITS)
    )
    return flagged.select("symbol", "window_start", "is_z_anomaly", "is_volume_anomaly", "is_price_change_anomaly")


@query
def model_flags_stub(spark, folder):
    return stub_model(window_features_of(spark, folder)).select(
        "symbol", "window_start", "is_if_anomaly", "if_anomaly_score"
    )


@query
def detections(spark, folder):
    return detections_of(spark, folder).select(
        "symbol", "window_start", "is_filtered_anomaly", "filtered_confidence", "is_anomaly",
        "anomaly_type", "anomaly_score", "detection_quality",
    )


@query
def anomalies_output(spark, folder):
    return windowed.anomalies_output(detections_of(spark, folder))


@query
def console_projection(spark, folder):
    return windowed.console_projection(detections_of(spark, folder))


@query
def anomalies_since_top(spark, folder):
    return scan.anomalies_since(windowed.anomalies_output(detections_of(spark, folder)), "2024-01-10 00:00:00", 200)


# ---- rolling model ---------------------------------------------------------------------------

@query
def trade_deltas(spark, folder):
    return rolling.trade_deltas(trades(spark, folder)).select(
        "trade_id", "price_change", "price_change_pct", "time_gap_sec"
    )


@query
def rolling_features(spark, folder):
    return rolling_of(spark, folder).select(
        "trade_id", "symbol", "history_length", "rolling_mean", "rolling_std", "z_score",
        "volume_ratio", "volume_spike",
    )


@query
def rolling_features_blocks(spark, folder):
    """Every symbol cut into blocks of 240 trades, each with the 119 before it."""
    return rolling.rolling_features(trades(spark, folder), SPLIT_ROLLING).select(
        "trade_id", "symbol", "history_length", "rolling_mean", "rolling_std", "z_score", "vwap", "price_velocity",
        "buy_pressure", "volume_spike", "price_change_pct", "time_gap_sec",
    )


@query
def rolling_vwap(spark, folder):
    return rolling_of(spark, folder).select("trade_id", "vwap", "vwap_deviation")


@query
def rolling_velocity(spark, folder):
    return rolling_of(spark, folder).select("trade_id", "price_velocity")


@query
def rolling_buy_pressure(spark, folder):
    return rolling_of(spark, folder).select("trade_id", "buy_pressure")


@query
def rolling_trades_table(spark, folder):
    return rolling.rolling_trades_table(rolling_of(spark, folder))


@query
def rolling_detections(spark, folder):
    return labels_of(spark, folder).select("trade_id", "symbol", "event_time", "anomaly_type", "z_score")


@query
def rolling_anomalies_table(spark, folder):
    injected = evaluation.inject_spikes(trades(spark, folder), InjectionConfig(rate=0.05))
    features = rolling.rolling_features(injected, INJECTED)
    return rolling.rolling_anomalies_table(detection.rolling_labels(rolling_stub(features), ROLLING))


def training_tail_of(spark, folder):
    table = rolling.rolling_trades_table(rolling_of(spark, folder))
    return scan.training_tail(table, 10_000, trades(spark, folder).select(F.col("event_time").alias("timestamp")))


@query
def training_tail(spark, folder):
    return training_tail_of(spark, folder)


@query
def training_tail_short(spark, folder):
    """A tail shorter than the table."""
    table = rolling.rolling_trades_table(rolling_of(spark, folder))
    return scan.training_tail(table, 300, trades(spark, folder).select(F.col("event_time").alias("timestamp")))


@query
def anomalies_since_first(spark, folder):
    """The oldest 40 anomalies of those that qualify."""
    return scan.anomalies_since(windowed.anomalies_output(detections_of(spark, folder)), "2024-01-10 00:00:00", 40)


@query
def warm_start_history(spark, folder):
    return rolling.warm_start_history(trades(spark, folder), AS_OF, minutes=WEEK, rows=100)


@query
def retrain_points(spark, folder):
    return rolling.retrain_points(trades(spark, folder), RetrainPolicy(first=100, every=500))


@query
def cooldown_thinning(spark, folder):
    return thin(labels_of(spark, folder), ["symbol", "anomaly_type"], COOLDOWN_SECONDS).select(
        "trade_id", "symbol", "event_time", "anomaly_type"
    )


@query
def cooldown_blocks(spark, folder):
    """All trades thinned per symbol, in cells of 50 whose step functions are composed."""
    return thin(trades(spark, folder), ["symbol"], COOLDOWN_SECONDS, block_rows=50).select("trade_id", "symbol", "event_time")


# ---- alerts ----------------------------------------------------------------------------------

def windowed_payloads(spark, folder):
    found = windowed.anomalies_output(detections_of(spark, folder))
    return alerts.alert_payloads(
        found, AS_OF, last_sent="2024-01-05 00:00:00", config=AlertConfig(lookback_minutes=4 * WEEK)
    )


@query
def alert_payloads(spark, folder):
    return windowed_payloads(spark, folder)


@query
def alert_keys(spark, folder):
    return alerts.with_alert_key(windowed_payloads(spark, folder)).select(
        "symbol", "timestamp", "anomaly_type", "alert_key"
    )


@query
def alert_dedup(spark, folder):
    """Every payload is dispatched twice, as after a restart; one of each remains."""
    payloads = windowed_payloads(spark, folder)
    keyed = alerts.with_alert_key(payloads.unionByName(payloads))
    return alerts.deduplicate(keyed, ["price", "z_score", "price_change_pct", "volume_spike"]).select(
        "alert_key", "symbol", "timestamp", "anomaly_type"
    )


@query
def alert_messages(spark, folder):
    return windowed_payloads(spark, folder).select("symbol", "timestamp", alerts.alert_message().alias("message"))


@query
def alert_messages_rich(spark, folder):
    return labels_of(spark, folder).select("trade_id", "anomaly_type", alerts.rich_alert_message().alias("message"))


@query
def alert_method_filter(spark, folder):
    return alerts.enabled_only(labels_of(spark, folder)).select("trade_id", "anomaly_type")


@query
def alert_outbox(spark, folder):
    return alerts.alert_outbox(labels_of(spark, folder), AlertConfig(cooldown_seconds=COOLDOWN_SECONDS))


# ---- read models -----------------------------------------------------------------------------

@query
def ohlcv_1h(spark, folder):
    return marts.candles(trades(spark, folder), "1 hour").drop("is_up")


@query
def ohlcv_1d(spark, folder):
    return marts.candles(trades(spark, folder), "1 day")


@query
def candles_with_anomalies(spark, folder):
    return marts.candles_with_anomalies(trades(spark, folder), labels_of(spark, folder), "1 day")


@query
def market_kpis(spark, folder):
    return marts.market_kpis(trades(spark, folder), labels_of(spark, folder))


@query
def symbol_rates(spark, folder):
    return marts.symbol_rates(trades(spark, folder), labels_of(spark, folder))


@query
def data_coverage(spark, folder):
    return marts.data_coverage(trades(spark, folder))


@query
def data_freshness(spark, folder):
    return marts.data_freshness(trades(spark, folder), "2024-02-01 00:00:00")


@query
def anomaly_types(spark, folder):
    return marts.anomaly_types(labels_of(spark, folder))


@query
def lookback_counts(spark, folder):
    return marts.lookback_counts(trades(spark, folder), AS_OF, (10, 15, 60, 240, 1440, 10080))


@query
def recent_trades(spark, folder):
    return marts.recent_rows(trades(spark, folder), AS_OF, WEEK, symbol="BTC/USDT").select(
        "trade_id", "symbol", "event_time", "price", "quantity"
    )


@query
def recent_anomalies(spark, folder):
    return marts.recent_rows(
        labels_of(spark, folder), AS_OF, 2 * WEEK, types=["z_score", "filtered_isoforest"], newest_first=False
    ).select("trade_id", "symbol", "event_time", "anomaly_type", "z_score")


@query
def recent_anomaly_board(spark, folder):
    return marts.recent_anomaly_board(labels_of(spark, folder))


@query
def latest_trade(spark, folder):
    return marts.latest_trade(trades(spark, folder))


@query
def symbol_universe(spark, folder):
    return marts.symbol_universe(trades(spark, folder), labels_of(spark, folder))


@query
def anomaly_trade_join(spark, folder):
    return marts.anomaly_trade_join(labels_of(spark, folder), trades(spark, folder))


@query
def orphan_anomalies(spark, folder):
    """Anomalies whose trade is missing from a trade table that lost every seventh trade."""
    kept = trades(spark, folder).where("trade_id % 7 != 0")
    return marts.orphan_anomalies(labels_of(spark, folder), kept).select("trade_id", "anomaly_type")


@query
def zscore_bands(spark, folder):
    return marts.zscore_bands(rolling_of(spark, folder))


# ---- metrics ---------------------------------------------------------------------------------

def decided(spark, folder):
    """Trades with a decision time; a few decisions carry a clock that runs behind."""
    delay = F.pmod(F.col("trade_id") * 37, F.lit(1000)) - 20
    return trades(spark, folder).withColumn(
        "detected_at", F.timestamp_millis(F.unix_millis("event_time") + delay)
    )


def offsets(spark, folder):
    """Offset samples per partition; the third partition has no committed offset yet."""
    source = trades(spark, folder)
    return source.groupBy(
        F.date_trunc("day", F.col("event_time")).alias("sample"), F.pmod("trade_id", F.lit(3)).alias("partition")
    ).agg(F.max("trade_id").alias("high"), F.min("trade_id").alias("_low")).withColumn(
        "committed", F.when(F.col("partition") == 2, -1).otherwise(F.col("_low"))
    )


def metric_events(spark, folder):
    kind = F.col("trade_id") % 5
    return trades(spark, folder).select(
        "event_time",
        F.when(F.col("trade_id") % 50 == 0, "refit").when(kind == 1, "process").when(kind == 2, "detect")
        .when(F.col("trade_id") % 50 == 3, "alert").otherwise("write").alias("kind"),
        F.pmod("trade_id", F.lit(16)).cast("double").alias("ms"),
        (F.col("trade_id") % 100 + 200).alias("bytes"),
    )


@query
def latency_percentiles(spark, folder):
    return metrics.latency_percentiles(decided(spark, folder), ["symbol"])


@query
def top_symbols(spark, folder):
    return metrics.top_symbols(trades(spark, folder), labels_of(spark, folder), decided(spark, folder))


@query
def lag_stats(spark, folder):
    return metrics.lag_stats(offsets(spark, folder))


@query
def metric_intervals(spark, folder):
    return metrics.metric_intervals(metric_events(spark, folder), "6 hours")


@query
def run_summary(spark, folder):
    totals = marts.symbol_rates(trades(spark, folder), labels_of(spark, folder)).where("symbol = 'TOTAL'").select(
        F.col("trades").alias("total_trades"), F.col("anomalies").alias("total_anomalies")
    )
    return metrics.run_summary(
        totals,
        metrics.latency_percentiles(decided(spark, folder)),
        metrics.lag_stats(offsets(spark, folder)),
        metrics.metric_intervals(metric_events(spark, folder), "6 hours"),
        metrics.timing_summary(metric_events(spark, folder)),
        metadata={"run_id": "check", "env_mode": "batch", "partitions": 3},
    )


@query
def record_bytes(spark, folder):
    table = rolling.rolling_trades_table(rolling_of(spark, folder)).drop("id")
    return table.select("symbol", metrics.record_bytes(table).alias("bytes")).groupBy("symbol").agg(
        F.sum("bytes").alias("bytes_written"), F.max("bytes").alias("largest_record")
    )


# ---- evaluation ------------------------------------------------------------------------------

@query
def inject_pct(spark, folder):
    return evaluation.inject_percent(trades(spark, folder), InjectionConfig(rate=0.1)).select(
        "trade_id", "price", "injected"
    )


@query
def inject_spikes(spark, folder):
    return evaluation.inject_spikes(trades(spark, folder), InjectionConfig(rate=0.05)).select(
        "trade_id", "price", "injection_kind", "injected"
    )


@query
def injection_counts(spark, folder):
    return evaluation.injection_counts(
        evaluation.inject_spikes(trades(spark, folder), InjectionConfig(rate=0.05))
    )


@query
def proxy_label_rate(spark, folder):
    return evaluation.proxy_label_rate(rolling_of(spark, folder))


def scored_against_proxy(spark, folder):
    labelled = evaluation.proxy_labels(rolling_stub(rolling_of(spark, folder)))
    return labelled.select((F.col("label") == 1).alias("truth"), F.col("is_if_anomaly").alias("predicted"))


@query
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(scored_against_proxy(spark, folder))


@query
def classification_report(spark, folder):
    return evaluation.classification_report(scored_against_proxy(spark, folder))


@query
def injection_eval(spark, folder):
    """Detection against injected truth: inject, compute features, detect, compare."""
    big = InjectionConfig(rate=0.05, kinds=((6.0, "up"), (0.2, "down"), (9.0, "far_up"), (0.1, "far_down")))
    injected = evaluation.inject_spikes(trades(spark, folder), big)
    features = rolling.rolling_features(injected, INJECTED).where(F.col("history_length") >= ROLLING.min_history)
    scored = features.select(
        (F.col("injected") == 1).alias("truth"), (F.abs("z_score") > ROLLING.z_threshold).alias("predicted")
    )
    return evaluation.confusion_matrix(scored)


@query
def clustered_table(spark, folder):
    """Trades written by date and symbol and read back."""
    path = f"{shared_folder(spark)}/clustered-{uuid.uuid4().hex}"
    write_table(trades(spark, folder), path, "event_time", rows_per_file=1000)
    back = spark.read.parquet(path)
    return back.where("symbol <> 'XRP/USDT'").select(
        "trade_id", "symbol", F.col("date").cast("string").alias("date"), "event_time", "price", "quantity", "is_buyer_maker"
    )


@query
def latest_files(spark, folder):
    """The trades of the last two of five files, found without opening the others."""
    path = f"{shared_folder(spark)}/latest-{uuid.uuid4().hex}"
    for i, part in enumerate(time_slices(trades(spark, folder), 5)):
        part.write.parquet(f"{path}/part-{i}")
    spread = scan.list_files(spark, path, pattern="part-*").select("file").where(F.col("file").rlike("/part-[34]/")).count()
    return scan.scan_latest_files(spark, path, files=spread, pattern="part-*").select("trade_id", "symbol", "price")


# ---- streams ---------------------------------------------------------------------------------

def _run(spark: SparkSession, start) -> str:
    """Run a stream over everything available; ``start`` gets a fresh folder below the shared one."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    start(folder).awaitTermination()
    return folder


ONCE = {"availableNow": True}


def trade_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return trades_from_events(file_stream(spark, folder, schema, "events.parquet"))


def stream_to_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    folder = _run(spark, lambda path: append_stream(
        df, f"{path}/table", checkpoint_path(path, name), f"{name}-{uuid.uuid4().hex[:6]}", ONCE
    ).start())
    return spark.read.schema(df.schema).parquet(f"{folder}/table")


def detection_stream(spark: SparkSession, folder: str) -> DataFrame:
    features = windows.stream_window_features(trade_stream(spark, folder), WINDOWS)
    return detection.detect_windows(features, LIMITS, DEFAULT_LIMITS, stub_model)


@query
def stream_window_features(spark, folder):
    return stream_to_table(spark, windows.stream_window_features(trade_stream(spark, folder), WINDOWS), "features")


@query
def stream_trades_sink(spark, folder):
    return stream_to_table(spark, windowed.trades_output(detection_stream(spark, folder)), "trades")


@query
def stream_anomalies_sink(spark, folder):
    return stream_to_table(spark, windowed.anomalies_output(detection_stream(spark, folder)), "anomalies")


@query
def stream_fanout(spark, folder):
    """Both tables written by one query, read back together."""
    path = _run(spark, lambda path: fanout.fanout_stream(
        detection_stream(spark, folder), path, checkpoint_path(path, "fanout"), ONCE
    ).start())
    columns = ["symbol", "window_start", "price", "z_score"]
    trades_table = spark.read.parquet(f"{path}/trades").select(F.lit("trades").alias("table"), *columns)
    anomalies_table = spark.read.parquet(f"{path}/anomalies").select(F.lit("anomalies").alias("table"), *columns)
    return trades_table.unionByName(anomalies_table)


@query
def stream_rolling_features(spark, folder):
    features = stateful.stream_rolling_features(trade_stream(spark, folder), ROLLING)
    return stream_to_table(spark, features, "rolling").select(
        "trade_id", "symbol", "history_length", "rolling_mean", "rolling_std", "z_score", "vwap", "price_velocity",
        "volume_spike", "buy_pressure", "price_change_pct", "time_gap_sec",
    )


@query
def stream_cooldown(spark, folder):
    """Large and expensive trades as detections, thinned by the stateful cooldown."""
    kind = F.when(F.col("price") > 60, "price").when(F.col("quantity") > 90, "volume")
    found = trade_stream(spark, folder).select("trade_id", "symbol", "event_time", kind.alias("anomaly_type")).where(
        F.col("anomaly_type").isNotNull()
    )
    return stream_to_table(spark, stateful.stream_cooldown(found, COOLDOWN_SECONDS), "cooldown")


@query
def stream_outbox(spark, folder):
    """Anomalies table of one stream read by the alert stream; every row reaches the outbox once."""
    found = windowed.anomalies_output(detection_stream(spark, folder))
    source = _run(spark, lambda path: append_stream(
        found, f"{path}/table", checkpoint_path(path, "source"), f"source-{uuid.uuid4().hex[:6]}", ONCE
    ).start())
    anomalies = file_stream(spark, f"{source}/table", found.schema)
    path = _run(spark, lambda path: fanout.outbox_stream(anomalies, path, checkpoint_path(path, "outbox"), ONCE).start())
    return spark.read.parquet(f"{path}/outbox").select("alert_key", "symbol", "timestamp", "anomaly_type", "source")


#: A part of a stream lies in files of at least so many rows, all parts in the same number.
PART_FILE_ROWS = 100_000


def sliced_stream(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """A stream of one part a trigger, in this order.

    Every part is the same number of files, as many as the smallest part fills, so that a large part is neither written
    nor read by one task.
    """
    folder = f"{shared_folder(spark)}/slices-{uuid.uuid4().hex}"
    files = max(1, min(part.count() for part in parts) // PART_FILE_ROWS)
    for part in parts:
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(folder)
    if files > 1 and len(spark.read.parquet(folder).inputFiles()) != files * len(parts):
        raise ValueError(f"a part of the stream does not fill its {files} files")
    return file_stream(spark, folder, parts[0].schema, files_per_trigger=files)


def time_slices(df: DataFrame, n: int = 4, time: str = "event_time") -> list[DataFrame]:
    """``df`` in ``n`` parts of equal time."""
    low, high = df.agg(F.unix_micros(F.min(time)), F.unix_micros(F.max(time))).first()
    step = (high - low) // n + 1
    place = F.floor((F.unix_micros(time) - low) / step)
    return [df.where(place == i) for i in range(n)]


@query
def stream_rolling_files(spark, folder):
    """Rolling features over four files, one a trigger: the history is read back from the state each time."""
    stream = sliced_stream(spark, time_slices(trades(spark, folder)))
    return stream_to_table(spark, stateful.stream_rolling_features(stream, ROLLING), "rolling").select(
        "trade_id", "symbol", "history_length", "rolling_mean", "rolling_std", "z_score", "vwap", "price_velocity",
        "volume_spike", "buy_pressure", "price_change_pct", "time_gap_sec",
    )


@query
def stream_rolling_lanes(spark, folder):
    """The same over micro-batches cut into blocks, with snapshots between them."""
    stream = sliced_stream(spark, time_slices(trades(spark, folder)))
    path = _run(spark, lambda path: rolling_batches.rolling_batch_stream(
        stream, path, checkpoint_path(path, "lanes"), SPLIT_ROLLING, ONCE
    ).start())
    return spark.read.parquet(f"{path}/features").select(
        "trade_id", "symbol", "history_length", "rolling_mean", "rolling_std", "z_score", "vwap", "price_velocity",
        "buy_pressure", "volume_spike", "price_change_pct", "time_gap_sec",
    )


@query
def stream_cooldown_files(spark, folder):
    """The cooldown of ``stream_cooldown`` over four files, one a trigger."""
    kind = F.when(F.col("price") > 60, "price").when(F.col("quantity") > 90, "volume")
    found = trades(spark, folder).select("trade_id", "symbol", "event_time", kind.alias("anomaly_type")).where(
        F.col("anomaly_type").isNotNull()
    )
    stream = sliced_stream(spark, time_slices(found))
    return stream_to_table(spark, stateful.stream_cooldown(stream, COOLDOWN_SECONDS), "cooldown")


@query
def stream_outbox_files(spark, folder):
    """Anomalies in four files that overlap, the last one older than those before it: one alert per key."""
    found = materialise(windowed.anomalies_output(detections_of(spark, folder)))
    first, second, third, fourth = time_slices(found, 4, "timestamp")
    stream = sliced_stream(spark, [second, second.union(third), third.union(fourth), first.union(second)])
    path = _run(spark, lambda path: fanout.outbox_stream(stream, path, checkpoint_path(path, "outbox"), ONCE).start())
    return spark.read.parquet(f"{path}/outbox").select("alert_key", "symbol", "timestamp", "anomaly_type", "source")


@query
def stream_observed(spark, folder):
    """Metrics that a stream of four files observes on the way, collected by the listener."""
    stream = monitor.observed(sliced_stream(spark, time_slices(trades(spark, folder))), rows=F.count(F.lit(1)), quantity=F.sum("quantity"))
    path = f"{shared_folder(spark)}/metrics-{uuid.uuid4().hex}"
    listener = monitor.ProgressLog(spark, path)
    spark.streams.addListener(listener)
    try:
        stream_to_table(spark, stream, "observed")
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline:  # events reach the listener a little later
            try:
                if monitor.observed_table(spark, path).agg(F.max("batch_id")).first()[0] == 3:
                    break
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    return monitor.observed_table(spark, path).select("batch_id", "name", "value")


@query
def stream_refits(spark, folder):
    """Which symbols a stream of four files fits again in which batch."""
    slices = time_slices(materialise(rolling_of(spark, folder)))
    config = ForestConfig(n_trees=10, max_samples=64)
    path = _run(spark, lambda path: retrain.retraining_stream(
        sliced_stream(spark, slices), path, checkpoint_path(path, "refits"), config, REFITS, ROLLING, ONCE
    ).start())
    return spark.read.parquet(f"{path}/models/meta").select("symbol", F.col("version").cast("bigint").alias("batch"))


@query
def model_versions_asof(spark, folder):
    """The training point whose model each trade would have met."""
    points = rolling.retrain_points(trades(spark, folder), REFITS).select(
        "symbol", F.col("event_time").alias("valid_from"), F.col("trade_number").alias("version")
    )
    return as_of_join(trades(spark, folder), points).select("trade_id", "symbol", "version")


# ---- models ----------------------------------------------------------------------------------

FOREST = ForestConfig(contamination=0.02)


@query
def model_fallback(spark, folder):
    """Which model each spelling of a symbol gets, with three models on file."""
    names = spelled(trades(spark, folder)).select(F.col("spelling").alias("symbol"))
    keys = spark.createDataFrame([("BTC/USDT",), ("ETHUSDT",), (forest.DEFAULT_KEY,)], "symbol string")
    return forest.resolve_models(names, keys).groupBy("symbol", "model_key").agg(F.count(F.lit(1)).alias("trades"))


@query
def iforest_train(spark, folder):
    recent = forest.training_trades(trades(spark, folder), ROLLING.window, FOREST)
    nodes, meta = forest.train(rolling.rolling_features(recent, ROLLING), FOREST)
    sizes = nodes.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("nodes"), F.max("depth").alias("deepest"), F.count_if(F.col("feature") < 0).alias("leaves")
    )
    return meta.join(sizes, "symbol")


@query
def iforest_score(spark, folder):
    features = rolling_of(spark, folder)
    recent = forest.training_trades(trades(spark, folder), ROLLING.window, FOREST)
    nodes, meta = forest.train(rolling.rolling_features(recent, ROLLING), FOREST)
    return forest.score(features, nodes, meta, FOREST).select(
        "trade_id", "symbol", "z_score", "is_if_anomaly", "if_anomaly_score"
    )


@query
def iforest_flags(spark, folder):
    """Windowed detections with a forest trained on the windows themselves."""
    features = window_features_of(spark, folder)
    config = ForestConfig(contamination=0.05, min_rows=50)
    keyed = features.withColumn("trade_id", F.unix_seconds("window_start")).withColumn("event_time", F.col("window_start"))
    nodes, meta = forest.train(keyed, config)
    model = forest.forest_model(nodes, meta, config)
    return detection.detect_windows(features, LIMITS, DEFAULT_LIMITS, model).select(
        "symbol", "window_start", "is_if_anomaly", "if_anomaly_score", "is_filtered_anomaly", "anomaly_type",
        "anomaly_score", "detection_quality",
    )


def labelled_tail(spark, folder):
    tail = training_tail_of(spark, folder).withColumnRenamed("id", "trade_id")
    return materialise(evaluation.proxy_labels(tail))


def stored_trials(spark, folder):
    """The trials of a search over these tables; the session's first caller runs it and stores them."""
    name = f"{spark.sparkContext.applicationId}-{zlib.crc32(folder.encode()):08x}"
    path = f"{shared_folder(spark)}/trials/{name}"
    try:
        return spark.read.schema(search.TRIALS_DDL).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    search.search(labelled_tail(spark, folder)).write.mode("overwrite").parquet(path)
    return spark.read.schema(search.TRIALS_DDL).parquet(path)


@query
def iforest_tune(spark, folder):
    return stored_trials(spark, folder)


@query
def tune_importance(spark, folder):
    return search.parameter_importance(stored_trials(spark, folder))


@query
def tuned_model_quality(spark, folder):
    """The best set of the search fitted again, and its flags on the tail."""
    tail, trials = labelled_tail(spark, folder), stored_trials(spark, folder)
    nodes, meta = search.fit_best(tail, trials)
    best = search.best_trial(trials).select("trial", F.col("f1").alias("search_f1"))
    return search.model_quality(forest.score(tail, nodes, meta), 3.5).join(F.broadcast(best))
