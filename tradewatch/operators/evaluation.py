"""Synthetic anomalies and detection quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.config import InjectionConfig

# Fixed values of the draw below: primes, so that nearby ids draw unrelated numbers.
_FOLD, _SPREAD, _DRAWS = 1_000_003, 7_919, 10_007


def draw(trade_id: Column, salt: int = 0) -> Column:
    """A repeatable draw in [0, 10007) from a trade id."""
    return F.pmod(F.pmod(trade_id, F.lit(_FOLD)) * F.lit(_SPREAD) + F.lit(salt * 104_729), F.lit(_DRAWS))


def _chosen(rate: float) -> Column:
    return draw(F.col("trade_id")) < F.lit(int(rate * _DRAWS))


def inject_percent(trades: DataFrame, config: InjectionConfig = InjectionConfig()) -> DataFrame:
    """Move the price of some trades up or down by a fixed percentage and mark them."""
    up = draw(F.col("trade_id"), 1) % 2 == 0
    factor = F.when(up, 1.0 + config.magnitude_pct / 100).otherwise(1.0 - config.magnitude_pct / 100)
    hit = _chosen(config.rate)
    return trades.withColumns({
        "price": F.when(hit, F.greatest(F.lit(0.0), F.col("price") * factor)).otherwise(F.col("price")),
        "injected": hit,
    })


def inject_spikes(trades: DataFrame, config: InjectionConfig = InjectionConfig(rate=0.05)) -> DataFrame:
    """Multiply the price of some trades by one of a few factors and record which."""
    pick = F.pmod(draw(F.col("trade_id"), 2), F.lit(len(config.kinds)))
    hit = _chosen(config.rate)
    factor = F.element_at(F.array(*[F.lit(m) for m, _ in config.kinds]), (pick + 1).cast("int"))
    label = F.element_at(F.array(*[F.lit(k) for _, k in config.kinds]), (pick + 1).cast("int"))
    return trades.withColumns({
        "price": F.when(hit, F.col("price") * factor).otherwise(F.col("price")),
        "injection_kind": F.when(hit, label),
        "injected": hit,
    })


def injection_counts(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(
        F.count_if("injected").alias("injected_trades"), F.count(F.lit(1)).alias("trades")
    )


def proxy_labels(features: DataFrame, limit: float = 3.5) -> DataFrame:
    """Stand-in truth for tuning: 1 where |z| exceeds the limit."""
    return features.withColumn("label", F.when(F.abs(F.coalesce("z_score", F.lit(0.0))) > limit, 1).otherwise(0))


def proxy_label_rate(features: DataFrame, limit: float = 3.5) -> DataFrame:
    return proxy_labels(features, limit).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"), F.avg("label").alias("anomaly_rate")
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def confusion_matrix(scored: DataFrame, truth: str = "truth", predicted: str = "predicted", by: list[str] | None = None) -> DataFrame:
    """TP, FP, FN, TN with precision, recall and F1 (zero where undefined), in one aggregate."""
    t, p = F.col(truth).cast("boolean"), F.col(predicted).cast("boolean")
    counts = scored.groupBy(*(by or [])).agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"),
    )
    tp = F.col("tp")
    return counts.withColumns({
        "precision": _share(tp, tp + F.col("fp")),
        "recall": _share(tp, tp + F.col("fn")),
        "f1": _share(2 * tp, 2 * tp + F.col("fp") + F.col("fn")),
    })


def classification_report(scored: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support of both classes, from one confusion matrix."""
    m = confusion_matrix(scored, truth, predicted)

    def row(name: str, hit: str, false_alarm: str, missed: str) -> Column:
        h, a, x = F.col(hit), F.col(false_alarm), F.col(missed)
        return F.struct(
            F.lit(name).alias("class"),
            _share(h, h + a).alias("precision"), _share(h, h + x).alias("recall"),
            _share(2 * h, 2 * h + a + x).alias("f1"), (h + x).alias("support"),
        )

    return m.select(F.inline(F.array(row("Normal", "tn", "fn", "fp"), row("Anomaly", "tp", "fp", "fn"))))
