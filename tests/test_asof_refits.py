"""Versions valid at a time, refits of due symbols, and the log of newest rows."""

import pytest
from pyspark.sql import functions as F

from tradewatch.config import ForestConfig, RetrainPolicy
from tradewatch.operators import forest
from tradewatch.operators.asof import as_of_join
from tradewatch.streaming.retrain import NewestRows, due_symbols


def moments(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_as_of_join_takes_the_newest_version_before(spark, buckets):
    rows = spark.range(200).select(
        "id", F.when(F.col("id") % 3 != 0, F.lit("A")).alias("symbol"),
        F.when(F.col("id") % 50 != 7, F.timestamp_seconds(F.col("id") * 10)).alias("event_time"),
    )
    points = [("A", 95, 1), ("A", 95, 2), ("A", 1000, 3), (None, 500, 4), ("B", 0, 5), ("A", 99_999, 6), ("A", -50, 0)]
    versions = spark.createDataFrame(points, "symbol string, s long, version int").select(
        "symbol", F.timestamp_seconds("s").alias("valid_from"), "version"
    )
    got = {r["id"]: r["version"] for r in as_of_join(rows, versions, buckets=buckets).collect()}
    assert len(got) == 200
    for i, version in got.items():
        symbol, at = None if i % 3 == 0 else "A", i * 10
        fits = [(s, v) for key, s, v in points if key == symbol and s <= at]
        assert version == (max(fits)[1] if fits and i % 50 != 7 else None), i


def test_as_of_join_of_nothing(spark):
    rows = spark.createDataFrame([], "symbol string, event_time timestamp")
    versions = spark.createDataFrame([], "symbol string, valid_from timestamp, version int")
    assert as_of_join(rows, versions).collect() == []
    one = spark.sql("SELECT 'A' AS symbol, timestamp'2024-01-01' AS event_time")
    assert as_of_join(one, versions).first()["version"] is None
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(one.withColumn("version", F.lit(1)), versions)


def test_replay_scores_with_the_model_of_the_time(spark):
    rows = spark.range(400).select(
        F.col("id").alias("trade_id"), F.lit("btcusdt").alias("symbol"), F.timestamp_seconds("id").alias("event_time"),
        (F.col("id") % 17).cast("double").alias("z_score"), (F.col("id") % 5).cast("double").alias("price_change_pct"),
        F.lit(1.0).alias("time_gap_sec"),
    )
    config = ForestConfig(n_trees=10, max_samples=64)
    named = rows.withColumn("symbol", F.lit("BTC/USDT"))
    models = [forest.train(named.where(condition), config) for condition in ("trade_id < 200", "trade_id >= 100")]
    nodes, meta = (
        models[0][i].withColumn("version", F.lit(1)).unionByName(models[1][i].withColumn("version", F.lit(2))) for i in (0, 1)
    )
    since = spark.createDataFrame([("BTC/USDT", 1, 50), ("BTC/USDT", 2, 300)], "symbol string, version int, s long").select(
        "symbol", "version", F.timestamp_seconds("s").alias("valid_from")
    )
    got = {r["trade_id"]: r["if_anomaly_score"] for r in forest.score_as_of(rows, nodes, meta, since, config).collect()}
    first, second = ({r["trade_id"]: r["if_anomaly_score"] for r in forest.score(rows, *m, config).collect()} for m in models)
    assert len(got) == 400
    assert all(got[i] == pytest.approx(0.0 if i < 50 else (first if i < 300 else second)[i], abs=1e-12) for i in got)


def test_due_symbols(spark):
    policy = RetrainPolicy(first=10, every=20, min_history=5)  # first fit at trade 14, then at 20, 40, ...
    before = spark.createDataFrame([("A", 13), ("B", 14), ("C", 39), ("D", 40), (None, 15)], "symbol string, trades long")
    after = spark.createDataFrame(
        [("A", 14), ("B", 19), ("C", 45), ("D", 59), (None, 20), ("N", 14), ("F", 13)], "symbol string, trades long"
    )
    assert {r[0] for r in due_symbols(before, after, policy).collect()} == {"A", "C", None, "N"}
    assert {r[0] for r in due_symbols(None, after, policy).collect()} == {"A", "B", "C", "D", None, "N"}


def test_newest_rows_survive_compaction(spark, folder):
    """After any batch the log holds the newest rows of all batches; a replayed batch changes nothing."""
    log = NewestRows(folder, rows=5, every=3)
    ddl = "symbol string, trade_id long, event_time timestamp"
    seen = []
    for batch in range(8):
        rows = [(("A", "B")[i % 2], batch * 10 + i) for i in range(4 + batch % 3)]
        seen += rows
        df = spark.createDataFrame(rows, "symbol string, trade_id long").withColumn("event_time", F.timestamp_seconds("trade_id"))
        for _ in range(2 if batch in (2, 4) else 1):
            log.write(df.select("symbol", "trade_id", "event_time"), batch)
        like = spark.createDataFrame([], ddl)
        held = [(r["symbol"], r["trade_id"]) for r in log.read(like, batch).collect()]
        for symbol in "AB":
            own = sorted((i for s, i in seen if s == symbol), reverse=True)[:5]
            assert sorted((i for s, i in held if s == symbol), reverse=True)[:5] == own
        assert len(log._tables(batch)) <= 3
