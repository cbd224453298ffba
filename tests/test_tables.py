"""Sources and sinks on disk, and what reaches the file scan."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewatch.sinks import tables
from tradewatch.sources import scan


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def log(small_trades):
    return small_trades.select("symbol", F.col("event_time").alias("timestamp"), "price", "trade_id")


def test_table_is_dated_and_clustered(spark, log, folder):
    tables.write_table(log, f"{folder}/t")
    back = spark.read.parquet(f"{folder}/t")
    assert back.count() == 1000 and os.path.isdir(f"{folder}/t/date=2024-01-05")
    one_day = back.where("date = DATE'2024-01-05' AND symbol = 'BTC/USDT'")
    text = plan(one_day)
    assert "PartitionFilters: [isnotnull(date" in text and "EqualTo(symbol,BTC/USDT)" in text
    rows = spark.read.parquet(f"{folder}/t/date=2024-01-05").select("symbol", "timestamp").collect()
    assert rows == sorted(rows), "rows of one file are in cluster order"


def test_scan_since_pushes_down(spark, log, folder):
    log.write.parquet(f"{folder}/t")
    recent = scan.scan_since(spark, f"{folder}/t", "2024-01-20 00:00:00").select("price", "timestamp")
    text = plan(recent)
    assert "GreaterThanOrEqual(timestamp" in text
    assert "ReadSchema: struct<timestamp:timestamp,price:double>" in text
    assert recent.count() == log.where("timestamp >= TIMESTAMP'2024-01-20 00:00:00'").count()
    later = scan.scan_since(spark, f"{folder}/t", "2024-01-20 00:00:00", files_modified_after=datetime(2999, 1, 1), schema=log.schema)
    assert later.count() == 0
    assert scan.day_before(datetime(2024, 1, 2)) == datetime(2024, 1, 1)


def test_recursive_scan_stops_at_corrupt_files_or_names_them(spark, log, folder):
    log.write.parquet(f"{folder}/t/a/b")
    log.withColumn("extra", F.lit(1)).write.parquet(f"{folder}/t/c")
    both = scan.scan_parquet(spark, f"{folder}/t", merge_schema=True)
    assert both.count() == 2000 and "extra" in both.columns
    with open(f"{folder}/t/a/broken.parquet", "wb") as out:
        out.write(b"PAR1 this is no parquet file")
    assert spark.read.schema(both.schema).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).parquet(
        f"{folder}/t"
    ).count() == 2000
    with pytest.raises(Exception, match="broken.parquet"):
        scan.scan_parquet(spark, f"{folder}/t", merge_schema=True).count()
    tolerant = scan.scan_parquet(spark, f"{folder}/t", skip_unreadable=True, merge_schema=True)
    assert tolerant.count() == 2000
    missed = scan.rowless_files(spark, tolerant, f"{folder}/t").collect()
    assert [(r["file"].rsplit("/", 1)[1], r["bytes"]) for r in missed] == [("broken.parquet", 28)]


def scanned_files(df):
    """Files that the executed scan has read."""
    node = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = node.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_scan_latest_files_opens_no_others(spark, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for i in (3, 1, 0, 2):
            spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(f"{folder}/t/part={i}")
        by_path = scan.scan_latest_files(spark, f"{folder}/t", files=2)
        assert sorted(r[0] for r in by_path.collect()) == list(range(20, 40))
        assert scanned_files(by_path) == 2
        by_change = scan.scan_latest_files(spark, f"{folder}/t", files=1, by="modified", schema=by_path.schema)
        assert sorted(r[0] for r in by_change.collect()) == list(range(20, 30)) and scanned_files(by_change) == 1
        assert scan.scan_latest_files(spark, f"{folder}/t", files=9).count() == 40
        assert scan.scan_latest_files(spark, f"{folder}/t", files=0).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with pytest.raises(ValueError):
        scan.scan_latest_files(spark, f"{folder}/t", files=1, by="size")


def test_files_follow_the_size_of_the_data(spark, log, folder):
    """One symbol with nearly all rows of one day is cut; filters on symbol and time skip most row groups."""
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq

    hot = spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, "B").otherwise("A").alias("symbol"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 4).alias("timestamp"), F.col("id").alias("trade_id"),
    ).repartition(13, F.rand(1))
    assert tables.write_table(hot, f"{folder}/t", rows_per_file=1000) == 20_000
    files = spark.read.parquet(f"{folder}/t").inputFiles()
    assert 15 <= len(files) <= 20 + 2
    groups = [
        pq.ParquetFile(f).metadata.row_group(g) for f in ds.dataset(f"{folder}/t", format="parquet").files
        for g in range(pq.ParquetFile(f).metadata.num_row_groups)
    ]
    sizes = [g.num_rows for g in groups]
    assert max(sizes) <= 2500 and sum(sizes) == 20_000
    stats = [{g.column(i).path_in_schema: g.column(i).statistics for i in range(g.num_columns)} for g in groups]
    hold_b = [s for s in stats if s["symbol"].min <= "B" <= s["symbol"].max]
    assert len(hold_b) <= 3, "a filter on the rare symbol reads few row groups"
    assert tables.write_table(hot.limit(0), f"{folder}/none") == 0


def test_csv_log_filters(spark, log, folder):
    tables.write_csv_log(log, f"{folder}/log")
    some = scan.read_csv_log(
        spark, f"{folder}/log", log.schema, since="2024-01-10 00:00:00", until="2024-01-20 00:00:00", symbols=["btcusdt", " ETH/USDT "]
    )
    want = log.where(
        "timestamp >= timestamp'2024-01-10' AND timestamp < timestamp'2024-01-20' AND symbol IN ('BTC/USDT', 'ETH/USDT')"
    )
    assert some.count() == want.count() > 0
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan(some)
    assert scan.read_csv_log(spark, f"{folder}/log", log.schema, symbols=[]).count() == 0


def test_training_tail_is_exact(small_trades):
    table = small_trades.select(
        F.col("trade_id").alias("id"), "symbol", F.col("event_time").alias("timestamp"),
        *[F.lit(0.0).alias(c) for c in ("z_score", "price_change_pct", "time_gap_sec")],
    )
    tail = scan.training_tail(table, 37).collect()
    want = [r[0] for r in table.orderBy(F.desc("timestamp"), F.desc("id")).limit(37).select("id").collect()]
    assert [r["id"] for r in tail] == want
    assert scan.training_tail(table, 5000).count() == 1000


def test_csv_round_trip(spark, log, folder):
    tables.write_csv_log(log, f"{folder}/log")
    tables.write_csv_log(log.limit(5), f"{folder}/log")
    with open(f"{folder}/log/bad.csv", "w") as out:
        out.write("symbol,timestamp,price,trade_id\nA,2024-01-01T00:00:00.000Z,abc,1\n")
    back = scan.read_csv_log(spark, f"{folder}/log", log.schema)
    assert back.count() == 1006
    bad = back.where("symbol = 'A'").first()
    assert bad["price"] is None and bad["trade_id"] == 1
    assert back.where("symbol <> 'A'").agg(F.round(F.sum("price"), 2)).first()[0] is not None


def test_required_columns(log):
    assert tables.require_columns(log, ["price"]) is log
    with pytest.raises(ValueError, match="volume"):
        tables.require_columns(log, ["price", "volume"])


def test_paths_and_connector_options():
    assert tables.checkpoint_path("/data/", "trades", "gcs") == "/data/checkpoints/gcs/trades"
    assert scan.bucket_path("bucket/", "anomalies") == "gs://bucket/anomalies"
    options = tables.warehouse_options("p", "d", "anomalies", "staging", ("symbol", "anomaly_type"))
    assert options["table"] == "p.d.anomalies" and options["partitionType"] == "DAY"
    assert options["clusteredFields"] == "symbol,anomaly_type"
