"""Event time: epoch decoding, ordering keys, calendar and trading-session columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Candidate time columns in order of preference.
TIME_COLUMNS = ("timestamp", "timestamp_ms", "event_time", "ts", "time")

# Upper bound of |epoch| for each unit (seconds, milli-, micro-; else nano-seconds).
EPOCH_BOUNDS = (("s", 1e11), ("ms", 1e14), ("us", 1e17))
_MICROS_PER = {"s": 1e6, "ms": 1e3, "us": 1.0, "ns": 1e-3}
_OLDEST_PLAUSIBLE_MICROS = 1_104_537_600_000_000.0  # 2005-01-01T00:00:00Z

_ID_RANGE = "1" + "0" * 19


def order_key(event_time: Column, trade_id: Column) -> Column:
    """(event_time, trade_id) as one number, ordered like the pair.

    A decimal keeps ``min_by``/``max_by`` in hash aggregation; ordering by a struct would make
    Spark sort every input row before the partial aggregate.
    """
    micros = F.unix_micros(event_time).cast("decimal(19,0)")
    return micros * F.lit(_ID_RANGE).cast("decimal(20,0)") + F.coalesce(trade_id, F.lit(0).cast("bigint"))


def order_key_in_bucket(
    event_time: Column, trade_id: Column, bucket: int, max_trade_id: int | None = None
) -> Column:
    """An order key that need only be comparable within time buckets of ``bucket`` microseconds.

    Where the caller vouches for a largest trade id that fits beside the offset, the pair is packed
    into one long, which aggregates faster than a decimal; an id outside the promise is an error.
    """
    id_bits = max_trade_id.bit_length() if max_trade_id is not None else 64
    if bucket.bit_length() + id_bits > 63:
        return order_key(event_time, trade_id)
    offset = F.pmod(F.unix_micros(event_time), F.lit(bucket))
    ident = F.coalesce(trade_id, F.lit(0).cast("bigint"))
    wrong = F.raise_error(F.lit(f"trade_id outside 0..{max_trade_id}")).cast("bigint")
    return F.when(ident.between(0, max_trade_id), offset * F.lit(1 << id_bits) + ident).otherwise(wrong)


_UNITS = {
    "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
}


def micros_in(duration: str) -> int | None:
    """Microseconds of a duration such as ``"20 seconds"``; None for forms with several parts."""
    number, _, unit = duration.strip().partition(" ")
    size = _UNITS.get(unit.strip().lower().removesuffix("s"))
    return int(number) * size if number.isdigit() and size else None


def pick_time_column(df: DataFrame) -> str | None:
    """First of the usual time columns that ``df`` has."""
    return next((name for name in TIME_COLUMNS if name in df.columns), None)


def with_event_time(df: DataFrame) -> DataFrame:
    """Make sure ``event_time`` exists: integers are epoch milliseconds, the rest is cast."""
    if "event_time" in df.columns:
        return df
    name = pick_time_column(df)
    if name is None:
        raise ValueError(f"no time column among {', '.join(TIME_COLUMNS)}")
    integral = dict(df.dtypes)[name] in ("bigint", "int")
    value = F.timestamp_millis(name) if integral else F.col(name).cast("timestamp")
    return df.withColumn("event_time", value)


def _unit(largest: Column, newest: Column) -> Column:
    (s, s_max), (ms, ms_max), (us, us_max) = EPOCH_BOUNDS
    guess = (
        F.when(largest < s_max, F.lit(s)).when(largest < ms_max, F.lit(ms))
        .when(largest < us_max, F.lit(us)).otherwise(F.lit("ns"))
    )
    finer = F.coalesce(*[
        F.when(newest * F.lit(_MICROS_PER[u]) >= _OLDEST_PLAUSIBLE_MICROS, F.lit(u)) for u in ("ms", "us", "ns")
    ])
    return F.when(newest * _micros_factor(guess) < _OLDEST_PLAUSIBLE_MICROS, F.coalesce(finer, guess)).otherwise(guess)


def _micros_factor(unit: Column) -> Column:
    return (
        F.when(unit == "s", _MICROS_PER["s"]).when(unit == "ms", _MICROS_PER["ms"])
        .when(unit == "us", _MICROS_PER["us"]).otherwise(_MICROS_PER["ns"])
    )


def decode_epoch(df: DataFrame, column: str, into: str, by: str | None = None) -> DataFrame:
    """Decode a numeric epoch column whose unit is told by its magnitude.

    The unit is decided once for the whole column, or once per value of ``by`` (one feed each).
    Adds ``into`` (timestamp) and ``epoch_unit``.
    """
    value = F.col(column).cast("double")
    stats = [F.max(F.abs(value)).alias("_largest"), F.max(value).alias("_newest")]
    if by is None:
        unit = df.agg(*stats).select(_unit(F.col("_largest"), F.col("_newest"))).scalar()
        tagged = df.withColumn("epoch_unit", unit)
    else:
        units = df.groupBy(by).agg(*stats).select(
            by, _unit(F.col("_largest"), F.col("_newest")).alias("epoch_unit")
        )
        tagged = df.join(units, by, "left")
    whole = F.col(column).cast("bigint")
    return tagged.withColumn(
        into,
        F.when(F.col("epoch_unit") == "s", F.timestamp_seconds(whole))
        .when(F.col("epoch_unit") == "ms", F.timestamp_millis(whole))
        .when(F.col("epoch_unit") == "us", F.timestamp_micros(whole))
        .otherwise(F.timestamp_micros(F.floor(whole / F.lit(1000)))),
    )


def hour_bucket(event_time: Column) -> Column:
    return F.date_format(event_time, "yyyy-MM-dd-HH")


def calendar_columns(event_time: Column) -> dict[str, Column]:
    """Hour, Monday-based weekday, weekend flag and trading session of an event time."""
    hour = F.hour(event_time)
    weekday = F.weekday(event_time)
    asian = (hour >= 23) | (hour < 8)
    return {
        "hour": F.coalesce(hour, F.lit(0)),
        "day_of_week": F.coalesce(weekday, F.lit(0)),
        "is_weekend": F.when(weekday >= 5, 1).otherwise(0),
        "trading_session": F.when(event_time.isNull(), "unknown").when(asian, "asian")
        .when(hour < 16, "european").otherwise("us"),
    }


def shift_hours(event_time: Column, hours: int) -> Column:
    return event_time + F.make_dt_interval(hours=F.lit(hours))
