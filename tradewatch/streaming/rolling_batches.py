"""Rolling features of a stream in which one symbol may outgrow a task.

Every micro-batch is measured with the batch operator: symbols are cut into blocks (lanes) that take the trades before
them along, so a batch of one symbol uses all cores. Between batches the newest ``window - 1`` trades of each symbol are
handed over in a small snapshot table. A batch reads the snapshot before its own and writes the next, in rotating slots,
so a replayed batch starts from the same state and replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradewatch.config import RollingConfig
from tradewatch.operators.rolling import newest_per_key, rolling_features, rolling_input
from tradewatch.streaming.fanout import batch_folder

#: A batch writes one slot, its predecessor's stays for a replay.
SLOTS = 3


def snapshot_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The newest trades per symbol that batches before ``batch_id`` have left, or None."""
    try:
        slots = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    earlier = slots.where(F.col("of_batch") < batch_id)
    last = earlier.agg(F.max("of_batch").alias("last")).first()["last"]
    return None if last is None else earlier.where(F.col("of_batch") == last).drop("of_batch", "slot")


def measure_batches(path: str, config: RollingConfig = RollingConfig()) -> Callable[[DataFrame, int], None]:
    """Batch writer of the ``features`` table and of the snapshots below ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = rolling_input(batch).persist()
        try:
            history = snapshot_before(batch.sparkSession, f"{path}/snapshots", batch_id)
            rolling_features(fresh, config, history=history).write.mode("overwrite").parquet(
                batch_folder(path, "features", batch_id)
            )
            known = fresh if history is None else fresh.unionByName(history)
            newest_per_key(known, ["symbol"], config.window - 1).withColumn("of_batch", F.lit(batch_id)).write.mode(
                "overwrite"
            ).parquet(f"{path}/snapshots/slot={batch_id % SLOTS}")
        finally:
            fresh.unpersist()

    return write


def rolling_batch_stream(
    trades: DataFrame, path: str, checkpoint: str, config: RollingConfig = RollingConfig(), trigger: dict | None = None
) -> DataStreamWriter:
    """Write the rolling features of a trade stream, batch by batch; values as in the batch form over all trades.

    A late trade is measured against the newest trades known before its own time, and the trades after it stay as written.
    """
    return (
        trades.writeStream.queryName("rolling_batches").outputMode("append").foreachBatch(measure_batches(path, config))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "20 seconds"}))
    )
