"""Streaming form of the windowed model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewatch.config import WindowConfig
from tradewatch.operators.windowed import window_features


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, in modification order."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def watermarked(trades: DataFrame, config: WindowConfig = WindowConfig()) -> DataFrame:
    return trades.withWatermark("event_time", config.watermark)


def stream_window_features(trades: DataFrame, config: WindowConfig = WindowConfig()) -> DataFrame:
    """Window features of a stream. In append mode a window appears once, after the watermark has
    passed its end; later rows for it are dropped and counted in ``numRowsDroppedByWatermark``."""
    return window_features(watermarked(trades, config), config)


def closed_windows(features: DataFrame, trades: DataFrame, config: WindowConfig = WindowConfig()) -> DataFrame:
    """The rows of a batch result that a finished stream would have emitted."""
    delay = F.expr(f"INTERVAL {config.watermark}")
    limit = trades.select(F.max("event_time") - delay).scalar()
    return features.where(F.col("window_end") <= limit)
