"""Run metrics: latency percentiles, lag, I/O and refit intervals, run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.functions.numbers import half_up
from tradewatch.operators.blocks import join_null_safe


def latency_ms(event_time: Column, detected_at: Column) -> Column:
    """Milliseconds from trade to decision, never negative."""
    return F.greatest(F.unix_millis(detected_at) - F.unix_millis(event_time), F.lit(0)).cast("double")


def exact_percentiles(df: DataFrame, value: str, probabilities: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation at (n-1)*p, without gathering a group.

    Values are first counted per distinct value, then per power-of-two range of values. Running counts
    over the few ranges tell which range holds a wanted rank, so only the distinct values of
    those ranges are ordered.
    """
    keys = list(by or [])
    v = F.col(value)
    counted = df.where(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # Thousand ranges per octave keep a range small; sign and zero get their own.
    octave = F.floor(F.log2(F.abs("_v") + 1) * 1000)
    ranged = counted.withColumn("_range", (F.signum("_v") * octave).cast("bigint"))
    spans = ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in_range"))
    running = W.partitionBy(*keys).orderBy("_range")
    spans = spans.withColumns({
        "_before": F.sum("_in_range").over(running.rowsBetween(W.unboundedPreceding, 0)) - F.col("_in_range"),
        "_total": F.sum("_in_range").over(W.partitionBy(*keys)),
    })
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), ((F.col("_total") - 1) * F.lit(float(p))).alias("rank"))
        for name, p in probabilities.items()
    ])

    def touches(w: Column) -> Column:
        low, high = F.floor(w["rank"]), F.ceil(w["rank"])
        return (high >= F.col("_before")) & (low < F.col("_before") + F.col("_in_range"))

    asked = spans.withColumn("_wanted", F.filter(wanted, touches)).where(F.size("_wanted") > 0).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_k"), "_before", "_in_range", "_wanted"
    )
    # Null-safe equality keeps rows with null keys, and leaves both sides of the join with the same
    # value counts, so that Spark computes these once and reuses the exchange.
    same = F.col("_range").eqNullSafe(F.col("_k"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = W.partitionBy(*keys, "_range").orderBy("_v")
    placed = ranged.join(asked, same).withColumn(
        "_from", F.col("_before") + F.sum("_n").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    ).withColumn("_w", F.explode("_wanted"))
    low, high = F.floor("_w.rank"), F.ceil("_w.rank")

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_n"))

    ends = placed.where(holds(low) | holds(high)).groupBy(*keys, F.col("_w.name").alias("_name")).agg(
        F.max("_w.rank").alias("_rank"),
        F.max(F.when(holds(low), F.col("_v"))).alias("_low"),
        F.max(F.when(holds(high), F.col("_v"))).alias("_high"),
    )
    fraction = F.col("_rank") - F.floor("_rank")
    value_at = F.col("_low") * (F.lit(1.0) - fraction) + F.col("_high") * fraction
    return ends.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_name") == name, value_at)).alias(name) for name in probabilities
    ])


_LATENCY = {"e2e_p50_ms": 0.50, "e2e_p95_ms": 0.95, "e2e_p99_ms": 0.99, "e2e_max_ms": 1.0}


def latency_percentiles(decided: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Latency percentiles of rows with ``event_time`` and ``detected_at``; zeros when there are none."""
    timed = decided.select(*(by or []), latency_ms(F.col("event_time"), F.col("detected_at")).alias("e2e_ms"))
    found = exact_percentiles(timed, "e2e_ms", _LATENCY, by)
    return found.withColumns({name: F.coalesce(name, F.lit(0.0)) for name in _LATENCY})


def top_symbols(trades: DataFrame, anomalies: DataFrame, decided: DataFrame, n: int = 5) -> DataFrame:
    """The busiest symbols with anomaly counts, rate and 95th latency percentile."""
    counts = trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))
    flagged = anomalies.groupBy("symbol").agg(F.count(F.lit(1)).alias("anomalies"))
    timing = latency_percentiles(decided, ["symbol"]).select("symbol", "e2e_p95_ms")
    joined = join_null_safe(counts, flagged, ["symbol"], "left", small=False)
    joined = join_null_safe(joined, timing, ["symbol"], "left", small=False)
    found = F.coalesce("anomalies", F.lit(0))
    return joined.select(
        "symbol", "trades", found.alias("anomalies"),
        half_up(found / F.col("trades") * 100, 3).alias("detect_rate_pct"),
        half_up(F.coalesce("e2e_p95_ms", F.lit(0.0)), 3).alias("e2e_p95_ms"),
    ).orderBy(F.desc("trades"), F.desc("anomalies"), "symbol").limit(n)


def top_symbols_json(top: DataFrame) -> DataFrame:
    """The top list as one JSON text, for sinks that cannot hold arrays."""
    entry = F.struct("trades", "anomalies", "symbol", "detect_rate_pct", "e2e_p95_ms")
    ordered = F.reverse(F.array_sort(F.collect_list(entry)))
    return top.agg(F.to_json(F.transform(ordered, lambda e: F.struct(
        e["symbol"].alias("symbol"), e["trades"].alias("trades"), e["anomalies"].alias("anomalies"),
        e["detect_rate_pct"].alias("detect_rate_pct"), e["e2e_p95_ms"].alias("e2e_p95_ms"),
    ))).alias("top_symbols_json"))


def lag_stats(offsets: DataFrame) -> DataFrame:
    """Consumer lag over (sample, partition, high, committed): min of mins, mean of means, max of maxs."""
    lag = F.greatest(F.col("high") - F.greatest(F.coalesce("committed", F.lit(0)), F.lit(0)), F.lit(0))
    per_sample = offsets.groupBy("sample").agg(
        F.min(lag).alias("low"), F.avg(lag).alias("mean"), F.max(lag).alias("high")
    )
    return per_sample.agg(
        F.coalesce(F.min("low"), F.lit(0)).alias("lag_min"),
        F.coalesce(F.avg("mean"), F.lit(0.0)).alias("lag_avg"),
        F.coalesce(F.max("high"), F.lit(0)).alias("lag_max"),
    )


def metric_intervals(events: DataFrame, interval: str = "10 seconds") -> DataFrame:
    """Write and refit figures per reporting interval, from (event_time, kind, ms, bytes) rows."""
    write, refit = F.col("kind") == "write", F.col("kind") == "refit"
    return events.groupBy(F.window("event_time", interval).alias("w")).agg(
        F.coalesce(F.avg(F.when(write, F.col("ms"))), F.lit(0.0)).alias("io_write_ms_avg"),
        F.coalesce(F.sum(F.when(write, F.col("bytes"))), F.lit(0)).alias("bytes_written"),
        F.count_if(refit).alias("refits"),
        F.coalesce(F.sum(F.when(refit, F.col("ms"))), F.lit(0.0)).alias("refit_time_ms"),
    ).select(F.col("w.start").alias("interval_start"), "io_write_ms_avg", "bytes_written", "refits", "refit_time_ms")


def timing_summary(events: DataFrame) -> DataFrame:
    """Mean processing and detection time in seconds and the number of alerts, from metric events."""
    def mean_sec(kind: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col("kind") == kind, F.col("ms"))) / F.lit(1e3), F.lit(0.0))

    return events.agg(
        half_up(mean_sec("process"), 6).alias("avg_processing_time_sec"),
        half_up(mean_sec("detect"), 6).alias("avg_detection_time_sec"),
        F.count_if(F.col("kind") == "alert").alias("total_alerts"),
    )


def run_summary(
    counts: DataFrame, latency: DataFrame, lag: DataFrame, intervals: DataFrame,
    timing: DataFrame | None = None, top: DataFrame | None = None, metadata: dict | None = None,
) -> DataFrame:
    """One row for the whole run; every input is already a single row or a small table.

    ``timing`` is a :func:`timing_summary`, ``top`` a :func:`top_symbols_json`; ``metadata`` holds run
    labels such as ``run_id``, ``env_mode``, ``replica`` and ``partitions``.
    """
    io = intervals.agg(
        F.coalesce(F.avg("io_write_ms_avg"), F.lit(0.0)).alias("io_write_ms_avg"),
        F.coalesce(F.sum("bytes_written"), F.lit(0)).alias("bytes_written"),
        F.coalesce(F.sum("refits"), F.lit(0)).alias("refits"),
        F.coalesce(F.sum("refit_time_ms"), F.lit(0.0)).alias("refit_time_ms"),
    )
    trades, found = F.col("total_trades"), F.col("total_anomalies")
    summary = counts.withColumn(
        "detection_rate_pct", half_up(F.coalesce(F.try_divide(found, trades), F.lit(0.0)) * 100, 6)
    )
    # One scalar subquery per input: single rows need no join.
    inputs = {"_latency": latency, "_lag": lag, "_io": io}
    inputs |= {name: frame for name, frame in (("_timing", timing), ("_top", top)) if frame is not None}
    summary = summary.withColumns({
        name: frame.select(F.struct(*frame.columns)).scalar() for name, frame in inputs.items()
    })
    return summary.select(
        *counts.columns, "detection_rate_pct",
        *[F.col(f"{name}.{c}").alias(c) for name, frame in inputs.items() for c in frame.columns],
        *[F.lit(value).alias(name) for name, value in (metadata or {}).items()],
    )


def record_bytes(df: DataFrame) -> Column:
    """UTF-8 size of a row's JSON form."""
    return F.octet_length(F.to_json(F.struct(*df.columns))).cast("bigint")
