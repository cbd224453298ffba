"""One streaming query, several outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradewatch.operators import alerts
from tradewatch.operators.windowed import anomalies_output, trades_output
from tradewatch.streaming.stateful import stream_first_alerts


def batch_folder(path: str, table: str, batch_id: int) -> str:
    return f"{path}/{table}/batch_id={batch_id}"


def write_both(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer for the trades and anomalies tables.

    Every batch owns one folder per table and overwrites it, so a batch that is replayed after a failure
    replaces its own output.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            trades_output(batch).write.mode("overwrite").parquet(batch_folder(path, "trades", batch_id))
            anomalies_output(batch).write.mode("overwrite").parquet(batch_folder(path, "anomalies", batch_id))
        finally:
            batch.unpersist()

    return write


def fanout_stream(detected: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> DataStreamWriter:
    """Write detections to both tables from one query: one read of the source, one state store."""
    return (
        detected.writeStream.queryName("detections").outputMode("append").foreachBatch(write_both(path))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "20 seconds"}))
    )


def outbox_stream(
    anomalies: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, remember_hours: float = 24.0
) -> DataStreamWriter:
    """Append new alerts of an anomaly stream to the outbox table.

    The checkpoint is the high-water mark: each anomaly row is considered once, across restarts, however old it is. The
    keys of sent alerts are state of the query and purged after ``remember_hours``.
    """
    first = stream_first_alerts(alerts.with_alert_key(alerts.payload_columns(anomalies)), remember_hours)

    def write(batch: DataFrame, batch_id: int) -> None:
        ready = batch.withColumns({"message": alerts.alert_message(), "sent_date": F.to_date("timestamp")})
        ready.write.mode("overwrite").partitionBy("sent_date").parquet(batch_folder(path, "outbox", batch_id))

    return (
        first.writeStream.queryName("alerts").outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "20 seconds"}))
    )
