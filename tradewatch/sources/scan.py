"""Table scans: Parquet folders, recent files, connectors. All return lazily evaluated frames."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewatch.functions.symbols import normalize_symbol


def scan_parquet(
    spark: SparkSession, *paths: str, pattern: str = "*.parquet", skip_unreadable: bool = False, merge_schema: bool = False
) -> DataFrame:
    """All Parquet files below the given folders.

    An unreadable file stops the scan unless ``skip_unreadable``; ``rowless_files`` then tells what was passed over.
    ``merge_schema`` opens every footer, for folders whose files differ in columns.
    """
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", skip_unreadable)
        .option("mergeSchema", merge_schema)
        .option("pathGlobFilter", pattern)
    )
    return reader.parquet(*paths)


def rowless_files(spark: SparkSession, scanned: DataFrame, *paths: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, bytes) of the files below ``paths`` from which the tolerant scan ``scanned`` got no row."""
    files = list_files(spark, *paths, pattern=pattern).select("file", "bytes")
    read = scanned.select(F.col("_metadata.file_path").alias("file")).distinct()
    return files.join(read, "file", "left_anti")


def list_files(spark: SparkSession, *paths: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, modified, bytes) of the files below ``paths``, from listings alone: no file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return listing.load(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"),
    )


def scan_latest_files(
    spark: SparkSession, *paths: str, files: int, by: str = "file", pattern: str = "*.parquet", schema: StructType | None = None
) -> DataFrame:
    """Rows of the last ``files`` files in path order, or in order of change with ``by="modified"``.

    The newest names are found in the listing and become a literal filter on the file path, by which the scan leaves out
    all other files before it opens any. ``schema`` spares reading a footer.
    """
    if by not in ("file", "modified"):
        raise ValueError("files are ordered by 'file' or 'modified'")
    order = [F.desc(by), F.desc("file")]
    newest = [row["file"] for row in list_files(spark, *paths, pattern=pattern).orderBy(*order).limit(files).collect()]
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    df = (reader if schema is None else reader.schema(schema)).parquet(*paths)
    return df.where(F.col("_metadata.file_path").isin(newest))


def scan_since(
    spark: SparkSession, path: str, since, time: str = "timestamp", files_modified_after: datetime | None = None,
    pattern: str = "*.parquet", schema: StructType | None = None,
) -> DataFrame:
    """Rows at or after ``since``; the predicate reaches the file scan.

    ``files_modified_after`` additionally skips older files by modification time; give ``schema``
    with it, because no file at all may be left to read one from.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if files_modified_after is not None:
        reader = reader.option("modifiedAfter", files_modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    kind = dict(df.dtypes)[time]
    return df.where(F.col(time) >= F.lit(since).cast(kind))


def day_before(moment: datetime) -> datetime:
    return moment - timedelta(hours=24)


def anomalies_since(anomalies: DataFrame, since, limit: int | None = None) -> DataFrame:
    """Anomalies at or after ``since``, in time order, for the alert dispatcher; with a ``limit`` the oldest of them."""
    found = (
        anomalies.where(F.col("timestamp") >= F.lit(since).cast("timestamp"))
        .select(
            "symbol", "timestamp", "price", "z_score", "price_change_pct", "volume_spike",
            "anomaly_type", "anomaly_score",
        )
        .orderBy("timestamp", "symbol", "anomaly_type")
    )
    return found if limit is None else found.limit(limit)


def newest_hours(times: DataFrame, rows: int, time: str = "timestamp") -> Column:
    """Start of the hour since which there are at least ``rows`` rows, as a scalar subquery.

    Counts per hour form a small table; running it backwards finds the hour. Sorting is then left
    with the newest hours instead of every task's candidates.
    """
    hours = times.groupBy(F.date_trunc("hour", F.col(time)).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    since = F.sum("n").over(W.orderBy(F.desc("hour")).rowsBetween(W.unboundedPreceding, 0))
    enough = hours.withColumn("since", since).agg(
        F.coalesce(F.max(F.when(F.col("since") >= rows, F.col("hour"))), F.min("hour")).alias("hour")
    )
    return enough.select("hour").scalar()


def training_tail(trades: DataFrame, rows: int = 10_000, times: DataFrame | None = None) -> DataFrame:
    """The newest rows of the trade log with the model features.

    ``times`` may name a cheaper table with the same ``timestamp`` values to find the tail in, when
    ``trades`` is a computed frame.
    """
    start = newest_hours(trades if times is None else times, rows)
    return (
        trades.where(F.col("timestamp") >= start)
        .orderBy(F.col("timestamp").desc(), F.col("id").desc())
        .limit(rows)
        .select("id", "symbol", "timestamp", "z_score", "price_change_pct", "time_gap_sec")
    )


def read_csv_log(
    spark: SparkSession, path: str, schema: StructType, since=None, until=None, symbols: list[str] | None = None,
    time: str = "timestamp",
) -> DataFrame:
    """CSV trade or anomaly log with a declared schema; bad numbers become null.

    Rows from ``since`` on, before ``until``, and of ``symbols`` in any spelling; rows without a time or a symbol are left
    out where that is asked for. The time limits reach the CSV reader.
    """
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    kind = dict(df.dtypes)[time] if time in df.columns else None
    if since is not None:
        df = df.where(F.col(time) >= F.lit(since).cast(kind))
    if until is not None:
        df = df.where(F.col(time) < F.lit(until).cast(kind))
    if symbols is not None:
        wanted = [normalize_symbol(F.lit(s)) for s in symbols]
        df = df.where(normalize_symbol(F.col("symbol")).isin(*wanted) if wanted else F.lit(False))
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, as_of, minutes: int, **options: str) -> DataFrame:
    """Recent rows of a database table; the time filter is pushed into the database."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
    return df.where(F.col("timestamp") >= since)


def bucket_path(bucket: str, table: str, scheme: str = "gs") -> str:
    """Folder of a table in an object store bucket."""
    return f"{scheme}://{bucket.strip('/')}/{table}"


def read_warehouse(spark: SparkSession, project: str, dataset: str, table: str, since) -> DataFrame:
    """Table of a cloud warehouse through its Spark connector, filtered at the source."""
    df = spark.read.format("bigquery").option("table", f"{project}.{dataset}.{table}").load()
    return df.where(F.col("timestamp") >= F.lit(since).cast("timestamp"))
