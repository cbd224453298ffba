"""Scoring a feature stream with models that are refreshed as data arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradewatch.config import ForestConfig, RetrainPolicy, RollingConfig
from tradewatch.operators import forest
from tradewatch.operators.blocks import join_null_safe
from tradewatch.operators.detection import no_model_flags, rolling_labels
from tradewatch.operators.rolling import newest_per_key
from tradewatch.session import materialise
from tradewatch.sinks.tables import write_models
from tradewatch.sources.models import load_models
from tradewatch.streaming.fanout import batch_folder


#: Batches between two compactions of the newest rows.
COMPACT_EVERY = 16


def due_symbols(before: DataFrame | None, after: DataFrame, policy: RetrainPolicy) -> DataFrame:
    """Symbols of ``after`` (symbol, trades) that reached a training point since ``before``: the first one, or a multiple
    of ``every`` beyond it. These are the points of ``retrain_points``."""
    if before is None:
        joined = after.withColumn("old", F.lit(0).cast("long"))
    else:
        named = before.select(F.col("symbol").alias("_of"), F.col("trades").alias("_old"))
        joined = after.join(named, F.col("symbol").eqNullSafe(F.col("_of")), "left").withColumn("old", F.coalesce("_old", F.lit(0)))
    first_fit = policy.min_history - 1 + policy.first
    first = (F.col("old") < first_fit) & (F.col("trades") >= first_fit)
    multiple = F.floor(F.col("trades") / policy.every) * policy.every
    return joined.where(first | (multiple > F.greatest("old", F.lit(first_fit)))).select("symbol")


class NewestRows:
    """The newest usable feature rows of each symbol, kept across batches as a log of small tables.

    A batch appends its own newest ``rows`` per symbol; every ``every``-th batch merges the last whole table and the parts
    since into the next whole one. Which tables hold the state up to a batch follows from its number, so a reader lists
    nothing and sees at most one whole table and ``every`` parts, however long the stream has run.
    """

    def __init__(self, path: str, rows: int, every: int = COMPACT_EVERY):
        self.path, self.rows, self.every = path, rows, every

    def _tables(self, batch_id: int) -> list[str]:
        whole = (batch_id + 1) // self.every * self.every - 1
        parts = [f"{self.path}/parts/batch_id={i}" for i in range(whole + 1, batch_id + 1)]
        return ([f"{self.path}/whole/batch_id={whole}"] if whole >= 0 else []) + parts

    def write(self, usable: DataFrame, batch_id: int) -> None:
        newest_per_key(usable, ["symbol"], self.rows).write.mode("overwrite").parquet(f"{self.path}/parts/batch_id={batch_id}")
        if (batch_id + 1) % self.every == 0:
            paths = [*(self._tables(batch_id - 1) if batch_id else []), f"{self.path}/parts/batch_id={batch_id}"]
            merged = newest_per_key(self._read(usable, paths), ["symbol"], self.rows)
            merged.write.mode("overwrite").parquet(f"{self.path}/whole/batch_id={batch_id}")

    def _read(self, like: DataFrame, paths: list[str]) -> DataFrame:
        return like.sparkSession.read.schema(like.schema).parquet(*paths)

    def read(self, like: DataFrame, batch_id: int) -> DataFrame:
        """Rows of the schema of ``like`` that hold the newest ``rows`` of each symbol up to a batch, and some older ones."""
        return self._read(like, self._tables(batch_id))


def stored_models(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """The newest complete model set, or None before the first training."""
    try:
        return load_models(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def score_and_retrain(
    path: str, config: ForestConfig = ForestConfig(), policy: RetrainPolicy = RetrainPolicy(),
    rolling: RollingConfig = RollingConfig(),
) -> Callable[[DataFrame, int], None]:
    """Batch writer: labels with the newest model of each symbol, then fits the symbols that are due.

    All outputs of a batch go to folders of that batch and replace themselves on a replay. Trades are counted per symbol
    in a small running table, the newest usable rows lie in ``NewestRows``; a batch reads the counts of the one before it
    and, for due symbols only, these rows. A version has the models fitted in its batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            models = stored_models(spark, f"{path}/models")
            scored = forest.score(batch, *models, config) if models else no_model_flags(batch)
            rolling_labels(scored, rolling).write.mode("overwrite").parquet(batch_folder(path, "detections", batch_id))
            usable = batch.where(F.col("history_length") >= policy.min_history)
            tail = NewestRows(f"{path}/newest", config.max_rows)
            tail.write(usable, batch_id)
            counted = batch.groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))
            before = spark.read.parquet(f"{path}/counts/batch_id={batch_id - 1}") if batch_id else None
            if before is not None:
                counted = counted.unionByName(before).groupBy("symbol").agg(F.sum("trades").alias("trades"))
            counted.write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")
        finally:
            batch.unpersist()
        after = spark.read.parquet(f"{path}/counts/batch_id={batch_id}")
        due = materialise(due_symbols(before, after, policy))
        if not due.isEmpty():
            rows = join_null_safe(tail.read(batch, batch_id), due, ["symbol"], "left_semi")
            nodes, meta = forest.train(rows, config)
            if not meta.isEmpty():
                write_models(nodes, meta, f"{path}/models", f"{batch_id:012d}")

    return write


def retraining_stream(
    features: DataFrame, path: str, checkpoint: str, config: ForestConfig = ForestConfig(),
    policy: RetrainPolicy = RetrainPolicy(), rolling: RollingConfig = RollingConfig(), trigger: dict | None = None,
) -> DataStreamWriter:
    """Detections of a rolling-feature stream, with models retrained on the way."""
    return (
        features.writeStream.queryName("detect_and_retrain").outputMode("append")
        .foreachBatch(score_and_retrain(path, config, policy, rolling))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "20 seconds"}))
    )
