"""Progress of running queries, and metrics observed inside them, as metric rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_DDL = (
    "query string, batch_id bigint, timestamp string, input_rows bigint, input_rows_per_sec double, "
    "processed_rows_per_sec double, late_rows bigint, state_rows bigint"
)


def progress_row(progress) -> dict:
    """The figures of one micro-batch."""
    operators = list(progress.stateOperators)
    return {
        "query": progress.name,
        "batch_id": progress.batchId,
        "timestamp": progress.timestamp,
        "input_rows": progress.numInputRows,
        "input_rows_per_sec": progress.inputRowsPerSecond,
        "processed_rows_per_sec": progress.processedRowsPerSecond,
        "late_rows": sum(o.numRowsDroppedByWatermark for o in operators),
        "state_rows": sum(o.numRowsTotal for o in operators),
    }


OBSERVED_DDL = "query string, batch_id bigint, metrics string, name string, value double"


def observed(df: DataFrame, metrics: str = "flow", **aggregates: Column) -> DataFrame:
    """``df`` with aggregates that its query computes on the way, without a second pass.

    Without ``aggregates``: rows, detections (where there is ``is_anomaly``), and the sums behind mean price and quantity.
    """
    if not aggregates:
        aggregates = {"rows": F.count(F.lit(1))}
        if "is_anomaly" in df.columns:
            aggregates["anomalies"] = F.count_if(F.col("is_anomaly"))
        aggregates |= {f"sum_{c}": F.sum(F.col(c).cast("double")) for c in ("price", "quantity") if c in df.columns}
    return df.observe(metrics, *[value.alias(name) for name, value in aggregates.items()])


class ProgressLog(StreamingQueryListener):
    """Writes one small JSON file per micro-batch, and one for its observed metrics, below ``folder``.

    Files go through the session's file systems, so the folder may lie wherever Spark can write. A file is named by query
    run and batch: a replayed batch replaces its own.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _write(self, table: str, name: str, rows: list[dict]) -> None:
        jvm, context = self.spark._jvm, self.spark.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}/{name}.json")
        out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray("\n".join(map(json.dumps, rows)), "utf-8"))
        finally:
            out.close()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress_row(progress)
        name = f"{row['query'] or 'query'}-{progress.runId}-{row['batch_id']}"
        self._write("progress", name, [row])
        found = [
            {"query": row["query"], "batch_id": row["batch_id"], "metrics": metrics, "name": key, "value": value}
            for metrics, values in progress.observedMetrics.items() for key, value in values.asDict().items()
        ]
        if found:
            self._write("observed", name, found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PROGRESS_DDL).json(f"{folder}/progress")


def observed_table(spark: SparkSession, folder: str) -> DataFrame:
    """(query, batch_id, metrics, name, value) of every batch that has observed something."""
    return spark.read.schema(OBSERVED_DDL).json(f"{folder}/observed")


def consumer_lag(progress) -> list[tuple[str, int]]:
    """Rows behind the newest Kafka offset per partition, from a progress report."""
    lags = []
    for source in progress.sources:
        end, latest = _offsets(source.endOffset), _offsets(source.latestOffset)
        for topic, partitions in latest.items():
            for partition, high in partitions.items():
                done = end.get(topic, {}).get(partition, 0)
                lags.append((f"{topic}-{partition}", max(int(high) - max(int(done), 0), 0)))
    return lags


def _offsets(text) -> dict:
    parsed = json.loads(text) if isinstance(text, str) and text else text
    return parsed if isinstance(parsed, dict) else {}
