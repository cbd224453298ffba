"""Batch and streaming table writers, and where their checkpoints live."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def checkpoint_path(base: str, sink: str, mode: str = "local") -> str:
    """Checkpoint folder of one sink. It carries no date, so a restart resumes where it stopped."""
    return f"{base.rstrip('/')}/checkpoints/{mode}/{sink}"


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def dated(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.withColumn("date", F.to_date(time))


def write_table(
    df: DataFrame, path: str, time: str = "timestamp", cluster_by: tuple[str, ...] = ("symbol",), mode: str = "append",
    rows_per_file: int = 2_000_000,
) -> int:
    """Append to a Parquet table laid out by date and clustered by ``cluster_by`` and time; returns the rows written.

    The rows are counted and dealt by range of (date, cluster, time) into as many partitions as make files of about
    ``rows_per_file``, then sorted. A file covers a narrow stretch of one date, so row-group statistics skip data for time
    and symbol filters; a date or symbol of any size is cut by time; and there are at most as many files as partitions
    plus dates. Counting and sampling read ``df`` twice more: materialise it first if it is dear.
    """
    placed = dated(df, time)
    rows = placed.count()
    order = ["date", *cluster_by, time]
    (
        placed.repartitionByRange(max(1, -(-rows // rows_per_file)), *order).sortWithinPartitions(*order)
        .write.mode(mode).partitionBy("date").parquet(path)
    )
    return rows


def write_csv_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def with_detection_time(df: DataFrame) -> DataFrame:
    """Stamp rows with the time of writing. Only for the edge: it makes results differ between runs."""
    return df.withColumn("detection_time", F.current_timestamp())


def write_metrics(summary: DataFrame, path: str) -> None:
    """Append a run summary to the CSV history and replace the JSON snapshot."""
    row = summary.coalesce(1)  # a summary is one row
    row.write.mode("append").option("header", True).csv(f"{path}/history")
    row.write.mode("overwrite").json(f"{path}/latest")


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    trigger: Mapping[str, object] | None = None,
    single_file: bool = False,
) -> DataStreamWriter:
    """A named append query into a Parquet folder; start it with ``.start()``.

    ``single_file`` writes one file per batch and therefore with one task: fine for previews, not
    for volume, hence off by default.
    """
    shaped = df.coalesce(1) if single_file else df
    return (
        shaped.writeStream.format("parquet").outputMode("append").queryName(name)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**dict(trigger or {"processingTime": "20 seconds"}))
    )


def console_stream(df: DataFrame, checkpoint: str, every: str = "10 seconds") -> DataStreamWriter:
    return (
        df.writeStream.format("console").outputMode("append").queryName("console")
        .option("truncate", False).option("checkpointLocation", checkpoint).trigger(processingTime=every)
    )


def warehouse_options(
    project: str, dataset: str, table: str, staging_bucket: str, cluster_by: tuple[str, ...] = ("symbol",)
) -> dict[str, str]:
    """Options of the cloud warehouse connector: created when missing, by day, clustered."""
    return {
        "table": f"{project}.{dataset}.{table}",
        "temporaryGcsBucket": staging_bucket,
        "createDisposition": "CREATE_IF_NEEDED",
        "partitionField": "timestamp",
        "partitionType": "DAY",
        "clusteredFields": ",".join(cluster_by),
    }


def warehouse_stream(df: DataFrame, options: Mapping[str, str], checkpoint: str, name: str) -> DataStreamWriter:
    return (
        df.writeStream.format("bigquery").outputMode("append").queryName(name)
        .options(**options).option("checkpointLocation", checkpoint)
    )


def write_models(forest: DataFrame, meta: DataFrame, path: str, version: str) -> None:
    """Store a model set under a version; the metadata table is written last and marks it complete."""
    forest.write.mode("overwrite").partitionBy("symbol").parquet(f"{path}/forest/version={version}")
    meta.write.mode("overwrite").parquet(f"{path}/meta/version={version}")
