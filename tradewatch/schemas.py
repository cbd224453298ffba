"""Schemas of the tables and messages the package reads and writes.

Input columns are nullable throughout: ``from_json`` yields all-null structs for malformed
records, so "not null" could not be enforced anyway; ``sources.decode`` filters them explicitly.
"""

from pyspark.sql import types as T


# One JSON trade message; ``timestamp`` is epoch milliseconds (UTC).
TRADE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("injected", T.BooleanType()),
])

# The exchange's combined-stream message. ``data`` has keys s (symbol), T (trade time in ms), p (price),
# q (quantity), t (trade id), m (buyer is maker); T and t differ only in case, so it is read as a map.
ENVELOPE = T.StructType([
    T.StructField("stream", T.StringType()),
    T.StructField("data", T.MapType(T.StringType(), T.StringType())),
])

THRESHOLD_DDL = (
    "symbol string, z_threshold double, volume_threshold double, price_change_threshold double"
)

# Isolation forests as tables: one row per tree node, and one row of metadata per symbol.
FOREST_DDL = (
    "symbol string, tree int, node int, feature int, split double, "
    "left int, right int, size bigint, depth int"
)
FOREST_META_DDL = (
    "symbol string, n_trees int, psi int, contamination double, score_cut double, trained_rows bigint"
)

# Windowed-model tables: what every row of a window tells, then what is told of all windows or of flagged ones only.
_WINDOW_DDL = (
    "symbol string, window_start timestamp, window_end timestamp, hour string, timestamp timestamp, price double, "
    "z_score double, price_change_pct double, volume_spike double"
)
WINDOW_TRADE_DDL = f"{_WINDOW_DDL}, window_volume double, trade_count bigint"
WINDOW_ANOMALY_DDL = (
    f"{_WINDOW_DDL}, time_gap_sec double, anomaly_type string, anomaly_score double, if_anomaly_score double"
)
# Columns of these tables that go by another name in the feature rows, and what stands for a missing value.
WINDOW_SOURCES = {"timestamp": "latest_event_time", "price": "last_price"}
ANOMALY_DEFAULTS = {"anomaly_type": "unknown", "anomaly_score": 0.0}

# Rolling-model trade table, in column order.
ROLLING_TRADE_COLUMNS = [
    "id", "symbol", "timestamp", "price", "quantity", "is_buyer_maker",
    "z_score", "rolling_mean", "rolling_std", "price_change_pct", "time_gap_sec",
    "volume_ratio", "buy_pressure", "vwap", "vwap_deviation", "price_velocity",
    "volume_spike", "hour", "day_of_week", "trading_session", "is_weekend", "injected",
]

ROLLING_ANOMALY_COLUMNS = [
    "trade_id", "symbol", "timestamp", "anomaly_type", "price",
    "z_score", "price_change_pct", "volume_spike", "vwap_deviation",
]

ALERT_PAYLOAD_COLUMNS = [
    "symbol", "timestamp", "price", "z_score", "price_change_pct",
    "volume_spike", "anomaly_type", "anomaly_score",
]
