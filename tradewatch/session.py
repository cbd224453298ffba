"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64_000_000


def build_session(app_name: str = "tradewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; keyword arguments override settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.streaming.stopGracefullyOnShutdown": "true",
        # Call-site capture makes every column expression cost several extra round trips to the JVM.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the session's ``spark.checkpoint.dir``.

    Only where the setting is absent (local tests) is a temporary folder made, once per session.
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table by its contents: the bytes of texts, 16 per array element, 8 per other value."""
    def bytes_of(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 8
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            return F.greatest(F.size(column), F.lit(0)) * 16 + 8
        return F.lit(8)

    per_row = reduce(add, [bytes_of(field) for field in df.schema.fields], F.lit(16))
    return df.agg(F.sum(per_row.cast("long")).alias("bytes")).first()["bytes"] or 0


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring; beyond the limit the planner picks a shuffle join.

    Meant for tables that are already materialised, so that measuring them is cheap.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit_bytes else df
