"""Rule flags from per-symbol limits, model flags, and their fusion into one typed result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.config import DEFAULT_THRESHOLDS, SYMBOL_THRESHOLDS, RollingConfig, Thresholds
from tradewatch.schemas import THRESHOLD_DDL
from tradewatch.session import BROADCAST_LIMIT_BYTES

_LIMITS = {"z_threshold": "z", "volume_threshold": "volume", "price_change_threshold": "price_change"}


def threshold_table(spark: SparkSession, overrides: Mapping[str, Thresholds] = SYMBOL_THRESHOLDS) -> DataFrame:
    """Per-symbol limits as a table; unset fields stay null."""
    rows = [(symbol, t.z, t.volume, t.price_change) for symbol, t in overrides.items()]
    return spark.createDataFrame(rows, THRESHOLD_DDL)


def register_threshold_functions(
    spark: SparkSession,
    overrides: Mapping[str, Thresholds] = SYMBOL_THRESHOLDS,
    default: Thresholds = DEFAULT_THRESHOLDS,
) -> None:
    """View ``thresholds`` plus SQL functions ``get_*_threshold(symbol)``; no Python at run time."""
    threshold_table(spark, overrides).createOrReplaceTempView("thresholds")
    for column, attribute in _LIMITS.items():
        fallback = float(getattr(default, attribute))
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION get_{column}(s STRING) RETURNS DOUBLE RETURN "
            f"coalesce((SELECT max(t.{column}) FROM thresholds t WHERE t.symbol = s), {fallback}D)"
        )


def with_thresholds(
    df: DataFrame,
    overrides: Mapping[str, Thresholds] | DataFrame = SYMBOL_THRESHOLDS,
    default: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Attach the three limits of each row's symbol, defaulting field by field.

    Limits given as a mapping are broadcast while their number is small; a DataFrame is joined with
    whatever strategy its own statistics justify.
    """
    if isinstance(overrides, DataFrame):
        limits = overrides
    else:
        limits = threshold_table(df.sparkSession, overrides)
        if sum(len(str(symbol)) + 64 for symbol in overrides) <= BROADCAST_LIMIT_BYTES:
            limits = F.broadcast(limits)
    joined = df.join(limits, "symbol", "left")
    return joined.withColumns({
        column: F.coalesce(F.col(column), F.lit(float(getattr(default, attribute))))
        for column, attribute in _LIMITS.items()
    })


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def rule_flags(df: DataFrame) -> DataFrame:
    """Three rule flags against the attached limits; null measures never flag."""
    return df.withColumns({
        "is_z_anomaly": _true(F.abs("z_score") > F.col("z_threshold")),
        "is_volume_anomaly": _true(F.col("volume_spike") > F.col("volume_threshold")),
        "is_price_change_anomaly": _true(F.abs("price_change_pct") > F.col("price_change_threshold")),
    })


def no_model_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({"is_if_anomaly": F.lit(False), "if_anomaly_score": F.lit(0.0)})


def stub_model_flags(df: DataFrame, z_limit: float = 3.5, pct_limit: float = 5.0) -> DataFrame:
    """Development stand-in for a forest: flags and scores straight from z and price change."""
    z = F.abs(F.coalesce("z_score", F.lit(0.0)))
    pct = F.abs(F.coalesce("price_change_pct", F.lit(0.0)))
    return df.withColumns({
        "is_if_anomaly": (z > z_limit) | (pct > pct_limit),
        "if_anomaly_score": F.greatest(z / max(z_limit, _SMALL), pct / max(pct_limit, _SMALL)),
    })


_SMALL = 1e-9


def fuse(df: DataFrame) -> DataFrame:
    """Combine rule and model flags into ``is_anomaly``, one type, one score, one quality grade.

    When several flags are up, the type follows this priority: both signals, z, model, price
    change, volume; the score is the measure that belongs to the type.
    """
    both = F.col("is_z_anomaly") & F.col("is_if_anomaly")
    confidence = F.abs("z_score") / F.col("z_threshold") * F.col("if_anomaly_score")
    staged = df.withColumn("is_filtered_anomaly", _true(both)).withColumn(
        "filtered_confidence", F.when(F.col("is_filtered_anomaly"), confidence).otherwise(0.0)
    )
    ranked = [
        ("is_filtered_anomaly", "filtered", F.col("filtered_confidence"), "high"),
        ("is_z_anomaly", "z", F.abs("z_score"), "medium"),
        ("is_if_anomaly", "if", F.col("if_anomaly_score"), "medium"),
        ("is_price_change_anomaly", "pct", F.abs("price_change_pct"), "low"),
        ("is_volume_anomaly", "volume", F.col("volume_spike"), "low"),
    ]

    def first_of(pick, fallback) -> Column:
        return F.coalesce(*[F.when(F.col(row[0]), pick(row)) for row in ranked], F.lit(fallback))

    return staged.withColumns({
        "is_anomaly": F.greatest(*[_true(F.col(row[0])) for row in ranked]),
        "anomaly_type": first_of(lambda row: F.lit(row[1]), "none"),
        "anomaly_score": first_of(lambda row: row[2], 0.0),
        "detection_quality": first_of(lambda row: F.lit(row[3]), "none"),
    })


def detect_windows(
    features: DataFrame,
    overrides: Mapping[str, Thresholds] | DataFrame = SYMBOL_THRESHOLDS,
    default: Thresholds = DEFAULT_THRESHOLDS,
    model=no_model_flags,
) -> DataFrame:
    """Rules, model and fusion over window features. ``model`` adds the two model columns."""
    flagged = model(rule_flags(with_thresholds(features, overrides, default)))
    return fuse(flagged).drop(*_LIMITS)


def rolling_labels(df: DataFrame, config: RollingConfig = RollingConfig(), limits: DataFrame | None = None) -> DataFrame:
    """One row per detection label of each trade that has enough history.

    Uses ``is_if_anomaly`` when a model has added it. ``limits`` (symbol, z_threshold) replaces the
    global z limit symbol by symbol.
    """
    ready = df.where(F.col("history_length") >= config.min_history)
    limit = F.lit(config.z_threshold)
    if limits is not None:
        ready = ready.join(limits.select("symbol", "z_threshold"), "symbol", "left")
        limit = F.coalesce("z_threshold", limit)
    by_z = _true(F.abs("z_score") > limit)
    by_model = _true(F.col("is_if_anomaly")) if "is_if_anomaly" in df.columns else F.lit(False)
    labels = F.array_compact(F.array(
        F.when(by_z, F.lit("z_score")),
        F.when(by_model & by_z, F.lit("filtered_isoforest")).when(by_model, F.lit("isoforest")),
    ))
    return ready.withColumn("anomaly_type", F.explode(labels)).drop("z_threshold")
