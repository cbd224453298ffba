"""Small helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def expand_copies(rows: DataFrame, copies: str, index: str, keys: list[str], piece: int = 4096) -> DataFrame:
    """One row per copy, numbered from 0 in ``index``. A group of any number of copies is cut into pieces, which are
    dealt over all tasks before they are expanded, so no task writes a whole group and no array outgrows ``piece``."""
    cut = rows.withColumn("_piece", F.explode(F.expr(f"sequence(0L, (`{copies}` - 1) div {piece})")))
    cut = cut.repartition(*[F.col(k) for k in keys], F.col("_piece"))
    last = F.least(F.col(copies) - 1, (F.col("_piece") + 1) * piece - 1)
    return cut.withColumn(index, F.explode(F.sequence(F.col("_piece") * piece, last))).drop("_piece")
