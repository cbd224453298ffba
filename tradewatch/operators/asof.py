"""As-of joins: for each row the version that was valid at its time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Time buckets per key that rows and validity intervals meet in.
BUCKETS = 1024


def as_of_join(
    rows: DataFrame, versions: DataFrame, key: str = "symbol", time: str = "event_time", since: str = "valid_from",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``rows`` with the columns of the newest version of their key that starts at or before their time, else nulls.

    Each version becomes an interval that ends where the next one starts; of several starting at once the last in column
    order holds. Time is cut into ``buckets`` equal pieces: an interval stands once in each piece that it touches, at most
    ``buckets`` plus the number of versions per key, and rows join by key and piece, so a key with most of all rows is dealt
    over the pieces and may be split further as a skewed join. No window runs over the rows. Rows without a time get nulls.
    """
    clash = set(rows.columns) & (set(versions.columns) - {key})
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(sorted(clash))}")
    facts = [c for c in versions.columns if c != key]
    micros, start = F.unix_micros(F.col(time).cast("timestamp")), F.unix_micros(F.col(since).cast("timestamp"))
    low, high = rows.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        low, high = 0, 0
    width = max(1, -(-(high - low + 1) // buckets))
    following = W.partitionBy(key).orderBy("_start", *facts)
    spans = versions.withColumn("_start", start).where(F.col("_start") <= high)
    spans = spans.withColumn("_end", F.coalesce(F.lead("_start").over(following), F.lit(high + 1)))
    spans = spans.where((F.col("_end") > F.col("_start")) & (F.col("_end") > low))
    place = lambda at: F.call_function("div", F.greatest(at, F.lit(low)) - low, F.lit(width))
    spans = spans.withColumn("_bucket", F.explode(F.sequence(place(F.col("_start")), place(F.col("_end") - 1))))
    spans = spans.select(F.col(key).alias("_key"), *facts, "_start", "_end", "_bucket")
    timed = rows.withColumn("_at", micros).withColumn("_slot", place(F.col("_at")))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slot") == F.col("_bucket"))
    valid = (F.col("_start") <= F.col("_at")) & (F.col("_at") < F.col("_end"))
    return timed.join(spans, same & valid, "left").select(*rows.columns, *facts)
