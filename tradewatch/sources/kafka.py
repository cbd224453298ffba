"""Kafka source and sink options. Brokers and secrets come from the caller only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.schemas import TRADE
from tradewatch.sources.decode import parse_trades


def source_options(
    brokers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    group_id: str | None = None,
    security: Mapping[str, str] | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of the Kafka reader; ``security`` entries are passed on as ``kafka.<name>``.

    Records that expired before they were read stop the query unless ``fail_on_data_loss`` is off.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id is not None:
        options["kafka.group.id"] = group_id
    return options | _prefixed(security)


def sink_options(
    brokers: str, topic: str, compression: str = "gzip", acks: str = "1", linger_ms: int = 50,
    batch_size: int = 32768, security: Mapping[str, str] | None = None,
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.compression.type": compression,
        "kafka.acks": acks,
        "kafka.linger.ms": str(linger_ms),
        "kafka.batch.size": str(batch_size),
    } | _prefixed(security)


def _prefixed(security: Mapping[str, str] | None) -> dict[str, str]:
    return {f"kafka.{name}": value for name, value in (security or {}).items()}


def read_trade_stream(spark: SparkSession, options: Mapping[str, str], watermark: str = "30 seconds") -> DataFrame:
    """Trades from Kafka as a watermarked stream."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return parse_trades(raw).withWatermark("event_time", watermark)


def kafka_records(trades: DataFrame, keyed: bool = True) -> DataFrame:
    """Trades as Kafka records: JSON value, symbol as key unless ``keyed`` is off."""
    message = trades.withColumn("timestamp", F.unix_millis("event_time"))
    value = F.to_json(F.struct(*TRADE.fieldNames())).alias("value")
    return message.select(F.col("symbol").alias("key"), value) if keyed else message.select(value)
