"""Alert selection, identity and text. Delivery is up to whoever reads the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.config import AlertConfig
from tradewatch.functions.numbers import fixed_text, number_text
from tradewatch.operators.cooldown import thin
from tradewatch.schemas import ALERT_PAYLOAD_COLUMNS

# The sign in front of each detection method's alert text.
METHOD_SIGNS = {"z_score": "📊", "isoforest": "🌳", "filtered_isoforest": "🎯"}
OTHER_SIGN = "🚨"

_NUMBERS = ("price", "z_score", "price_change_pct", "volume_spike", "anomaly_score")


def iso_text(timestamp: Column) -> Column:
    """ISO 8601 without zone; the fraction is left out when it is zero."""
    full = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.000000$", "")


def alert_key(symbol: Column, timestamp: Column, anomaly_type: Column, score: Column) -> Column:
    """Identity of an alert: SHA-1 over symbol, time, type and the score to three decimals."""
    parts = [symbol, timestamp, anomaly_type, number_text(F.coalesce(score, F.lit(0.0)), 3)]
    return F.sha1(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))


def enabled_only(labelled: DataFrame, config: AlertConfig = AlertConfig()) -> DataFrame:
    """Detections whose method may alert."""
    return labelled.where(F.col("anomaly_type").isin(list(config.enabled_methods)))


def alert_payloads(
    anomalies: DataFrame, as_of, last_sent=None, config: AlertConfig = AlertConfig(), source: str = "dispatcher"
) -> DataFrame:
    """Alert candidates since the later of the last sent alert and the look-back limit.

    Missing columns are left out, NaN becomes null, times become ISO text.
    """
    now = F.lit(as_of).cast("timestamp")
    since = now - F.make_dt_interval(mins=F.lit(config.lookback_minutes))
    if last_sent is not None:
        since = F.greatest(since, F.lit(last_sent).cast("timestamp"))
    return payload_columns(anomalies.where(F.col("timestamp") >= since), source)


def payload_columns(anomalies: DataFrame, source: str = "dispatcher") -> DataFrame:
    shaped = []
    for name in ALERT_PAYLOAD_COLUMNS:
        if name not in anomalies.columns:
            continue
        value = F.col(name)
        if name == "timestamp":
            value = iso_text(value)
        elif name in _NUMBERS:
            value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
        shaped.append(value.alias(name))
    return anomalies.select(*shaped, F.lit(source).alias("source"))


def with_alert_key(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn(
        "alert_key",
        alert_key(F.col("symbol"), F.col("timestamp"), F.col("anomaly_type"), F.col("anomaly_score")),
    )


def alert_message() -> Column:
    """One-line text of a payload row; absent numbers are left out."""
    def part(label: str, name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.concat(F.lit(label), number_text(F.col(name))))

    return F.concat_ws(
        " | ",
        F.concat(F.lit("ANOMALY: "), F.coalesce("symbol", F.lit("?"))),
        F.concat(
            F.lit("type="), F.coalesce("anomaly_type", F.lit("unknown")),
            F.lit(" score="), F.coalesce(number_text(F.col("anomaly_score")), F.lit("0")),
        ),
        F.concat(F.lit("time="), F.coalesce("timestamp", F.lit("?"))),
        part("price=", "price"), part("z=", "z_score"), part("pct=", "price_change_pct"),
        part("vol_spike=", "volume_spike"),
        F.concat(F.lit("source="), F.coalesce("source", F.lit("pipeline"))),
    )


def _title(method: Column) -> Column:
    return F.initcap(F.replace(method, F.lit("_"), F.lit(" ")))


def rich_alert_message() -> Column:
    """Multi-line text of a labelled trade; the optional lines appear only when they say something."""
    sign = F.coalesce(
        *[F.when(F.col("anomaly_type") == m, F.lit(s)) for m, s in METHOD_SIGNS.items()], F.lit(OTHER_SIGN)
    )

    def line(label: str, text: Column, only_if: Column | None = None) -> Column:
        whole = F.concat(F.lit(f"**{label}:** "), text, F.lit("\n"))
        return whole if only_if is None else F.when(only_if, whole).otherwise("")

    pct, spike, deviation = F.col("price_change_pct"), F.col("volume_spike"), F.col("vwap_deviation")
    return F.concat(
        sign, F.lit(" **ANOMALY DETECTED**\n\n"),
        line("Type", _title(F.col("anomaly_type"))),
        line("Symbol", F.col("symbol")),
        line("Time", iso_text(F.col("event_time"))),
        line("Price", F.concat(F.lit("$"), fixed_text(F.col("price"), 2, grouped=True))),
        line("Z-Score", fixed_text(F.coalesce("z_score", F.lit(0.0)), 2)),
        line("Price Change", F.concat(fixed_text(pct, 2), F.lit("%")), pct != 0),
        line("Volume Spike", F.concat(fixed_text(spike, 1), F.lit("x normal")), spike > 2),
        line("VWAP Deviation", F.concat(fixed_text(deviation, 2), F.lit("%")), deviation != 0),
    )


def alert_fields(labelled: DataFrame) -> DataFrame:
    """The same alert as separate text fields, for channels that lay fields out themselves."""
    return labelled.select(
        "trade_id",
        _title(F.col("anomaly_type")).alias("type"),
        "symbol",
        F.concat(F.lit("$"), fixed_text(F.col("price"), 2, grouped=True)).alias("price"),
        fixed_text(F.col("z_score"), 2).alias("z_score"),
        iso_text(F.col("event_time")).alias("time"),
    )


def deduplicate(keyed: DataFrame, tie_break: list[str]) -> DataFrame:
    """One row per alert key. Equal keys have equal times, so every copy is inside the interval.

    The rank limit runs before the shuffle: a key with many copies sends one row per input task.
    """
    first = W.partitionBy("alert_key").orderBy(*tie_break)
    return keyed.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def alert_outbox(labelled: DataFrame, config: AlertConfig = AlertConfig()) -> DataFrame:
    """Alerts to deliver: enabled methods, thinned per (symbol, type), with key and text."""
    thinned = thin(enabled_only(labelled, config), ["symbol", "anomaly_type"], config.cooldown_seconds)
    payload = payload_columns(
        thinned.withColumn("timestamp", F.col("event_time")).withColumn("anomaly_score", F.abs("z_score"))
    )
    return with_alert_key(payload).withColumn("message", alert_message())
