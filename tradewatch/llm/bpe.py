"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes of a text cuts it into chunks; equal passages are cut alike wherever they stand. Documents
are routed by their smallest line hash, so that documents with common passages meet in one task and stand side by side,
where each distinct chunk is encoded once. Chunk joins are then repaired: a space before a character that is not white
space always begins a new pre-token, so the ids between a chunk's first and last such place hold in any context. What lies
between the last sure place of one chunk and the first of the next (over whole chunks that have none) is encoded anew, and
the ids agree exactly with those of the whole text.

Routes with many documents are counted and spread over tasks by a salt, so a hot passage is encoded once per task that it
is spread over. The cache of chunks is bounded.

Defined cases: a null text is empty and has no tokens; a special token's string in a text becomes its id, as in the
tokenizers library; equal rows get equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the public vocabulary: how texts part into pre-tokens, and its special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"

WINDOW = 32
CHUNK_BYTES = 2048
LONGEST_CHUNK = 16_384
CACHED_CHUNK_BYTES = 24_000_000
HOT_ROUTE = 1_000
_SURE = re.compile(r" (?=\S)")


def vocabulary_file() -> str:
    """Where the public vocabulary lies on this machine; every executor needs it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _gear() -> np.ndarray:
    state, out = 0x9E3779B97F4A7C15, []
    for _ in range(256):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(state ^ (state >> 29))
    return np.array(out, np.uint64)


def cut_points(data: bytes, gear: np.ndarray) -> list[int]:
    """Ends of the content-defined chunks: after bytes where the hash of the last WINDOW bytes has its high bits clear, moved
    on to the start of a character; a stretch without such a byte is cut every LONGEST_CHUNK bytes."""
    n = len(data)
    if n <= CHUNK_BYTES // 4:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    h, width = gear[raw], 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint64(width)
        width *= 2
    starts = (raw & 0xC0) != 0x80
    at = np.flatnonzero(h >> np.uint64(64 - CHUNK_BYTES.bit_length() + 1) == 0) + 1
    out, last = [], 0
    for end in [*at.tolist(), n]:
        while end - last > LONGEST_CHUNK:
            last = _character(starts, last + LONGEST_CHUNK, n)
            out.append(last)
        end = _character(starts, end, n)
        if end > last:
            out.append(end)
            last = end
    return out


def _character(starts: np.ndarray, at: int, n: int) -> int:
    while at < n and not starts[at]:
        at += 1
    return at


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = max(ranks.values()) + 1
        self.engine = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: special})
        self.end = special
        self.bytes_of = [b""] * (special + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.bytes_of[special] = SPECIAL.encode()
        self.names = [str(i) for i in range(special + 1)]
        self.kind = np.dtype("<u2" if special < 2**16 else "<u4")
        self.gear = _gear()
        self.chunks: dict[bytes, tuple] = {}
        self.chunk_bytes = 0
        self.encoded_chunks = self.reused_chunks = 0

    def ids(self, text: str) -> bytes:
        """Packed ids of a text that begins at a sure place or at the start of its document."""
        if SPECIAL in text:
            return np.array(self.engine.encode(text, allowed_special="all"), self.kind).tobytes()
        return np.array(self.engine.encode_ordinary(text), self.kind).tobytes()

    def _chunk(self, data: bytes) -> tuple[str, bytes | None, str]:
        """(head, ids, tail): what stands before the first and from the last sure place, and the ids in between."""
        found = self.chunks.get(data)
        if found is not None:
            self.reused_chunks += 1
            return found
        self.encoded_chunks += 1
        text = data.decode()
        first, last = _SURE.search(text), text.rfind(" ")
        while last > 0 and not _SURE.match(text, last):
            last = text.rfind(" ", 0, last)
        if first is None:
            found = (text, None, "")
        else:
            found = (text[: first.start()], self.ids(text[first.start() : last]) if last > first.start() else b"", text[last:])
        if self.chunk_bytes > CACHED_CHUNK_BYTES:
            self.chunks.clear()
            self.chunk_bytes = 0
        self.chunks[data] = found
        self.chunk_bytes += 2 * len(data)
        return found

    def encode(self, data: bytes) -> np.ndarray:
        """Ids of a whole text."""
        out, pending, start = [], "", 0
        for stop in cut_points(data, self.gear):
            head, inner, tail = self._chunk(data[start:stop])
            start = stop
            pending += head
            if inner is not None:
                out += [self.ids(pending), inner]
                pending = tail
        return np.frombuffer(b"".join([*out, self.ids(pending)]), self.kind)

    def whole(self, data: bytes) -> np.ndarray:
        """Ids of a whole text, encoded in one piece."""
        return np.frombuffer(self.ids(data.decode()), self.kind)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8; bytes that are no characters become the replacement character."""
        names = self.bytes_of
        return b"".join([names[i] for i in ids.tolist()]).decode("utf-8", "replace").encode()

    def listing(self, ids: np.ndarray) -> str:
        names = self.names
        return ",".join([names[i] for i in ids.tolist()])


def routed(docs: DataFrame, hot: int = HOT_ROUTE) -> DataFrame:
    """(doc, text) with documents that share their smallest line hash in one task, next to each other. Routes of more
    than ``hot`` documents (and more than a fair share of a task) are spread by the hash of the row."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"), F.col("text").cast("string")
    )
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.length(x) >= 20)
    route = F.coalesce(F.array_min(F.transform(lines, lambda x: F.xxhash64(x))), F.xxhash64("text"))
    counts = rows.select(route.alias("route")).groupBy("route").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = rows.count() // (4 * tasks)
    counts = counts.where(F.col("n") > share).select(F.col("route").alias("hot_route"), (F.col("n") / max(hot, share) + 1).cast("int").alias("parts"))
    rows = rows.withColumn("route", route).join(F.broadcast(counts), F.col("route") == F.col("hot_route"), "left")
    salt = F.pmod(F.xxhash64(F.to_json("doc")), F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("salt", salt).select("doc", "text", "route", "salt")
    return rows.repartition("route", "salt").sortWithinPartitions("route").select("doc", "text")


RESULTS = {"ids": "array<int>", "digests": "struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>"}


def _encoded(batches: Iterator[pa.RecordBatch], path: str, digests: bool) -> Iterator[pa.RecordBatch]:
    codec = None
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for batch in batches:
        codec = codec or Codec(path)
        for part in range(0, batch.num_rows, 200):
            rows = batch.slice(part, 200)
            out = []
            for value in rows.column("text").cast(pa.binary()):
                ids = codec.encode(value.as_py() or b"")
                out.append((len(ids), sha(codec.listing(ids).encode()), sha(codec.decode(ids))) if digests else ids.astype(np.int32))
            if digests:
                columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.string(), pa.string()))]
                found = pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                found = pa.array(out, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column("doc"), found], ["doc", "result"])


def encoded(docs: DataFrame, result: str = "ids", path: str | None = None) -> DataFrame:
    """(doc, result): the other columns of ``docs`` as a struct, and the ids of their texts or digests of them."""
    path = path or vocabulary_file()
    rows = routed(docs)
    schema = T.StructType([rows.schema["doc"], T.StructField("result", T._parse_datatype_string(RESULTS[result]))])
    return rows.mapInArrow(lambda b: _encoded(b, path, result == "digests"), schema)


def document_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded(docs.select("doc_id", "text"), "digests", path).select("doc.doc_id", "result.*")
