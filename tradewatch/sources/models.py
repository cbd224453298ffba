"""Stored model sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.operators.forest import DEFAULT_KEY, latest_per_symbol


def load_models(spark: SparkSession, path: str, symbols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Node and metadata tables of each symbol's newest complete version, for the wanted symbols and the default.

    A version holds the symbols that were fitted in it and is complete once its metadata exists, so the metadata decides;
    nodes are read from the folders of these versions and symbols only.
    """
    meta, nodes = spark.read.parquet(f"{path}/meta"), spark.read.parquet(f"{path}/forest")
    if symbols is not None:
        wanted = F.col("symbol").isin([*symbols, DEFAULT_KEY])
        meta, nodes = meta.where(wanted), nodes.where(wanted)
    newest = latest_per_symbol(meta)
    return nodes.join(newest.select("symbol", "version"), ["symbol", "version"], "left_semi").drop("version"), newest.drop("version")
