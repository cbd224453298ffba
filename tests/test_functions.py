"""Scalar helpers, decoding and model keys."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewatch.functions import numbers, symbols, timestamps
from tradewatch.sources import decode, kafka


def column(spark, values, ddl="v string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


@pytest.mark.parametrize("text,want", [
    ("BTCUSDT", "BTC/USDT"), ("btc-usdt", "BTC/USDT"), (" ETH/USDT ", "ETH/USDT"), ("SOLUSDC", "SOL/USDC"),
    ("BTC", "BTC"), ("", ""), (None, ""), ("\tethbtc\n", "ETH/BTC"), ("XYZABC", "XYZABC"), ("USDT", "USDT"), ("ABUSD", "AB/USD"),
])
def test_normalize_symbol(spark, text, want):
    assert column(spark, [text]).select(symbols.normalize_symbol(F.col("v"))).first()[0] == want


@pytest.mark.parametrize("path,want", [
    ("/models/BTC_USDT.pkl", "BTC/USDT"), ("/models/ethusdt.joblib", "ETH/USDT"), ("_default_v2.pickle", "_default_"),
    ("gs://b/m/SOL-USDT.parquet", "SOL/USDT"),
])
def test_model_key(spark, path, want):
    assert column(spark, [path]).select(symbols.model_key(F.col("v"))).first()[0] == want


def test_stream_symbol_and_base(spark):
    row = column(spark, ["BTC-USDT"]).select(symbols.stream_symbol(F.col("v")), symbols.base_currency(F.col("v"))).first()
    assert tuple(row) == ("btcusdt", "BTC")


@pytest.mark.parametrize("value,want", [(4.1, "4.1"), (0.0, "0.0"), (1234567.5, "1234567.5"), (-2.25, "-2.25"), (3.0, "3.0"), (1e-4, "0.0001")])
def test_number_text(spark, value, want):
    assert column(spark, [value], "v double").select(numbers.number_text(F.col("v"))).first()[0] == want


def test_coerce_double(spark):
    got = column(spark, ["1.5", "x", "", None, "NaN"]).select(
        numbers.coerce_double(F.col("v")), numbers.coerce_double(F.col("v"), 0.0)
    ).collect()
    assert [tuple(r) for r in got] == [(1.5, 1.5), (None, 0.0), (None, 0.0), (None, 0.0), (None, 0.0)]


@pytest.mark.parametrize("factor,unit", [(1, "s"), (10**3, "ms"), (10**6, "us"), (10**9, "ns")])
def test_epoch_units(spark, factor, unit):
    df = column(spark, [1_700_000_000 * factor, None], "v bigint")
    row = timestamps.decode_epoch(df, "v", "t").where("v IS NOT NULL").first()
    assert row["epoch_unit"] == unit and row["t"] == datetime(2023, 11, 14, 22, 13, 20)


def test_epoch_before_2005_keeps_the_guess(spark):
    row = timestamps.decode_epoch(column(spark, [1_000_000_000], "v bigint"), "v", "t").first()
    assert row["epoch_unit"] == "s" and row["t"].year == 2001


@pytest.mark.parametrize("hour,session", [(23, "asian"), (0, "asian"), (7, "asian"), (8, "european"), (15, "european"), (16, "us"), (22, "us")])
def test_sessions(spark, hour, session):
    df = column(spark, [datetime(2024, 1, 6, hour)], "v timestamp")
    row = df.select(*[c.alias(n) for n, c in timestamps.calendar_columns(F.col("v")).items()]).first()
    assert (row["hour"], row["day_of_week"], row["is_weekend"], row["trading_session"]) == (hour, 5, 1, session)


def test_missing_time_has_defaults(spark):
    df = column(spark, [None], "v timestamp")
    row = df.select(*[c.alias(n) for n, c in timestamps.calendar_columns(F.col("v")).items()]).first()
    assert tuple(row) == (0, 0, 0, "unknown")


def test_time_column_choice(spark):
    df = spark.createDataFrame([(1_700_000_000_000, 5)], "timestamp_ms bigint, time bigint")
    assert timestamps.pick_time_column(df) == "timestamp_ms"
    assert timestamps.with_event_time(df).first()["event_time"] == datetime(2023, 11, 14, 22, 13, 20)
    with pytest.raises(ValueError):
        timestamps.with_event_time(spark.range(1))


def test_shift_and_durations(spark):
    df = column(spark, [datetime(2024, 1, 1)], "v timestamp")
    assert df.select(timestamps.shift_hours(F.col("v"), 2)).first()[0] == datetime(2024, 1, 1, 2)
    assert timestamps.micros_in("20 seconds") == 20_000_000
    assert timestamps.micros_in("1 day") == 86_400_000_000
    assert timestamps.micros_in("1 hour 30 minutes") is None


MESSAGES = [
    json.dumps({"symbol": "BTC/USDT", "timestamp": 1700000000123, "price": 1.5, "quantity": 2.0, "trade_id": 7,
                "is_buyer_maker": True, "injected": True}),
    json.dumps({"symbol": "BTC/USDT", "timestamp": 1700000000123, "price": 1.5, "quantity": 2.0}),
    '{"symbol": "BTC/US', "", None, "[]", json.dumps({"timestamp": 1}), json.dumps({"symbol": "A"}),
]


def test_parse_trades(spark):
    raw = column(spark, MESSAGES, "value string")
    rows = decode.parse_trades(raw).orderBy("trade_id").collect()
    assert len(rows) == 2
    assert rows[0]["is_buyer_maker"] is False and rows[0]["injected"] is False and rows[0]["trade_id"] is None
    assert rows[1]["is_buyer_maker"] is True and rows[1]["event_time"] == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert tuple(decode.message_counts(raw).first()) == (2, 6, 8)
    assert decode.rejected_messages(raw).count() == 6


def test_parse_envelopes(spark):
    good = {"stream": "btcusdt@trade", "data": {"s": "BTCUSDT", "T": 1700000000123, "p": "1.5", "q": "2", "t": 9, "m": True}}
    sparse = {"stream": "x@trade", "data": {"s": "ETHUSDT"}}
    raw = column(spark, [json.dumps(good), json.dumps(sparse), json.dumps({"stream": "a"}), json.dumps({"data": {}}), "x"], "value string")
    rows = {r["symbol"]: r for r in decode.parse_envelopes(raw).collect()}
    assert set(rows) == {"BTC/USDT", "ETH/USDT"}
    assert (rows["BTC/USDT"]["price"], rows["BTC/USDT"]["trade_id"], rows["BTC/USDT"]["is_buyer_maker"]) == (1.5, 9, True)
    assert (rows["ETH/USDT"]["price"], rows["ETH/USDT"]["trade_id"]) == (0.0, 0)


def test_kafka_options_pass_secrets_through():
    options = kafka.source_options(
        "broker:9092", "trades", group_id="g", security={"security.protocol": "SASL_SSL", "sasl.mechanism": "PLAIN"}
    )
    assert options["subscribe"] == "trades" and options["failOnDataLoss"] == "true"
    assert "maxOffsetsPerTrigger" not in options and options["startingOffsets"] == "latest"
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.group.id"] == "g"
    tolerant = kafka.source_options("b", "t", max_offsets_per_trigger=1000, fail_on_data_loss=False)
    assert tolerant["maxOffsetsPerTrigger"] == "1000" and tolerant["failOnDataLoss"] == "false"
    assert kafka.sink_options("b", "t", compression="lz4")["kafka.compression.type"] == "lz4"


def test_kafka_records(small_trades):
    row = kafka.kafka_records(small_trades.where("trade_id = 0")).first()
    assert row["key"] == "XRP/USDT"
    sent = small_trades.where("trade_id = 0").select(F.unix_millis("event_time")).first()[0]
    assert json.loads(row["value"])["timestamp"] == sent
    assert kafka.kafka_records(small_trades, keyed=False).columns == ["value"]


def test_packed_order_key_guards_its_promise(spark):
    df = spark.createDataFrame([(5, 1.0)], "trade_id bigint, v double").withColumn("t", F.timestamp_seconds(F.lit(100)))
    key = timestamps.order_key_in_bucket(F.col("t"), F.col("trade_id"), 60_000_000, max_trade_id=7)
    assert df.select(key).first()[0] == (40_000_000 << 3) + 5
    bad = timestamps.order_key_in_bucket(F.col("t"), F.col("trade_id"), 60_000_000, max_trade_id=3)
    with pytest.raises(Exception, match="trade_id outside"):
        df.select(bad).collect()
