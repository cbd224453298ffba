"""Token shards in training order.

Texts become BPE ids and ids become sequences of ``LENGTH`` (a document's last one is filled up with the end token). Texts are
encoded once: a document reserves as many indices as it can have sequences at most (a token has at least one byte), from
a running count of bytes that one cheap pass over the scan's partitions gives. A keyed Feistel network over the next even
power of two, walked until it lands below the number of reserved indices, permutes these into places. Places are dealt
to tasks by range; each task sorts its places and writes one shard of fixed-stride records. A sequence's global slot is
its rank among all places: the records before its shard (lengths of files / stride) plus its number in the shard. So
slots have no gaps, record ``slot`` stands at a known byte of a known file, and reading can begin, or go on, anywhere.

A record is the document's id (8 bytes), the sequence's number in it (4), its count of true tokens (4), LENGTH ids of 2
bytes and the end token, all little-endian; Spark's text writer puts the end token as its line separator.

Both passes see the same partitions, because the input is a table scan with the same settings (as with zipWithIndex). A
partition that reserves more than it was counted for stops the job.

Defined cases: a null or empty text has no sequence; a null doc_id is stored as the smallest long; equal rows are
separate documents; an empty table writes no record; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm.bpe import Codec, vocabulary_file
from tradewatch.session import shared_folder

LENGTH = 247
HEADER = 16
STRIDE = HEADER + 2 * LENGTH + 2
#: Places per shard; about four in ten hold a sequence.
SHARD_PLACES = 65_536
KEY = 20_240_229
ROUNDS = 6
NULL_ID = -(2**63)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def feistel(index: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """A keyed permutation of 0..size-1, applied to ``index``."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64(2**half - 1)
    x = index.astype(np.uint64)
    walking = np.ones(len(x), bool)
    while walking.any():
        y = x[walking]
        left, right = y >> np.uint64(half), y & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key * ROUNDS + r) & mask)
        x[walking] = (left << np.uint64(half)) | right
        walking = x >= np.uint64(size)
    return x.astype(np.int64)


def _sequences(batches: Iterator[pa.RecordBatch], path: str, length: int, offsets: dict[int, tuple[int, int]], size: int, key: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    codec, index, stop = None, *offsets.get(part, (0, 0))
    for batch in batches:
        codec = codec or Codec(path)
        for at in range(0, batch.num_rows, 500):
            rows, records, places = batch.slice(at, 500), [], []
            for doc_id, value in zip(rows.column("doc_id").to_pylist(), rows.column("text").cast(pa.binary())):
                text = value.as_py() or b""
                ids = codec.whole(text)
                places.append(np.arange(index, index - (-len(ids) // length)))
                index -= -len(text) // length
                for number, start in enumerate(range(0, len(ids), length)):
                    own = ids[start : start + length]
                    head = np.array([NULL_ID if doc_id is None else doc_id], "<i8").tobytes() + np.array([number, len(own)], "<i4").tobytes()
                    records.append(head + own.astype("<u2").tobytes() + np.full(length - len(own), codec.end, "<u2").tobytes())
            if records:
                found = feistel(np.concatenate(places), size, key)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(records, pa.binary())], ["place", "record"])
    if index > stop:
        raise RuntimeError(f"partition {part} was counted over other rows")


def write_shards(
    docs: DataFrame, folder: str, length: int = LENGTH, shard_places: int = SHARD_PLACES, key: int = KEY, path: str | None = None
) -> None:
    """Writes the shards of ``docs`` (doc_id, text) to ``folder``."""
    path = path or vocabulary_file()
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    most = F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / length)
    counts = docs.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(most).alias("n")).collect()  # a row for each task
    offsets, size = {}, 0
    for r in sorted(counts, key=lambda r: r.part):
        offsets[r.part] = size, size + r.n
        size += r.n
    shards = max(1, -(-size // shard_places))
    rows = docs.mapInArrow(lambda b: _sequences(b, path, length, offsets, size, key), "place long, record binary")
    rows = rows.repartitionById(shards, F.expr(f"cast(place div {shard_places} as int)")).sortWithinPartitions("place")
    end = int(Codec(path).end).to_bytes(2, "little").decode("latin-1")
    rows.select(F.col("record").cast("string")).write.option("lineSep", end).option("encoding", "ISO-8859-1").text(folder)


RECORDS = "slot long, shard int, byte_offset long, doc_id long, sequence int, n_tokens int, ids binary"


def _read(batches: Iterator[pa.RecordBatch], length: int, slots: dict[int, int], first: int) -> Iterator[pa.RecordBatch]:
    stride = HEADER + 2 * length + 2
    names = [c.split()[0] for c in RECORDS.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            shard, data = batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8)
            rows = data.reshape(-1, stride)
            skip = max(0, first - slots[shard])
            for at in range(skip, len(rows), 4096):
                some = rows[at : at + 4096]
                n = len(some)
                place = np.arange(at, at + n)
                doc = np.ascontiguousarray(some[:, :8]).view("<i8").ravel()
                counts = np.ascontiguousarray(some[:, 8:16]).view("<i4")
                ids = [r[HEADER : HEADER + 2 * c].tobytes() for r, c in zip(some, counts[:, 1])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(slots[shard] + place), pa.array(np.full(n, shard, np.int32)), pa.array(place * stride),
                    pa.array(doc, mask=doc == NULL_ID), pa.array(counts[:, 0].copy()), pa.array(counts[:, 1].copy()), pa.array(ids, pa.binary()),
                ], names)


def shard_slots(spark: SparkSession, folder: str, length: int = LENGTH) -> tuple[dict[int, int], int]:
    """The first slot of every shard, and the number of slots, from the lengths of the files (contents are not read)."""
    stride = HEADER + 2 * length + 2
    files = _files(spark, folder).select("shard", "length").collect()  # a row for each file
    slots, total = {}, 0
    for r in sorted(files, key=lambda r: r.shard):
        if r.length % stride:
            raise ValueError(f"shard {r.shard} is not a whole number of records")
        slots[r.shard] = total
        total += r.length // stride
    return slots, total


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(folder).where("length > 0")
    return files.withColumn("shard", F.regexp_extract("path", r"part-(\d+)-", 1).cast("int"))


def read_shards(spark: SparkSession, folder: str, length: int = LENGTH, first: int = 0) -> DataFrame:
    """The records from slot ``first`` on; shards before it are not opened."""
    slots, _ = shard_slots(spark, folder, length)
    start = max([s for s, at in slots.items() if at <= first], default=0)
    files = _files(spark, folder).where(F.col("shard") >= start).select("shard", "content")
    return files.mapInArrow(lambda b: _read(b, length, slots, first), RECORDS)


def materialised(docs: DataFrame) -> DataFrame:
    """Writes all of ``docs`` to shards in the shared folder and reads them back: one row per sequence, with the CRC of
    its ids."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/tokens"
    write_shards(docs, folder)
    return read_shards(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
