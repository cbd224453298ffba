"""Assembly of the two models: which operator feeds which."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tradewatch.config import (
    DEFAULT_THRESHOLDS, SYMBOL_THRESHOLDS, AlertConfig, RollingConfig, Thresholds, WindowConfig,
)
from tradewatch.operators.cooldown import thin
from tradewatch.operators.detection import detect_windows, no_model_flags, rolling_labels
from tradewatch.operators.rolling import rolling_features
from tradewatch.operators.windowed import window_features


def windowed_detections(
    trades: DataFrame,
    config: WindowConfig = WindowConfig(),
    overrides: Mapping[str, Thresholds] | DataFrame = SYMBOL_THRESHOLDS,
    default: Thresholds = DEFAULT_THRESHOLDS,
    model=no_model_flags,
) -> DataFrame:
    """Trades to typed, scored windows; batch or stream."""
    return detect_windows(window_features(trades, config), overrides, default, model)


def rolling_detections(trades: DataFrame, config: RollingConfig = RollingConfig(), model=None) -> DataFrame:
    """Trades to one row per detection label (batch)."""
    features = rolling_features(trades, config)
    return rolling_labels(model(features) if model else features, config)


def rolling_alerts(
    trades: DataFrame, config: RollingConfig = RollingConfig(), alerts: AlertConfig = AlertConfig(), model=None
) -> DataFrame:
    """Rolling detections after the cooldown of their (symbol, type)."""
    return thin(rolling_detections(trades, config, model), ["symbol", "anomaly_type"], alerts.cooldown_seconds)
