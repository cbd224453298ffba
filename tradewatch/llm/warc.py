"""WARC archives: a writer with revisit records, and a salvage reader.

The writer makes one record per page, each a gzip member of its own, and lets Spark's text writer put the members into
files; its line separator is an empty gzip member, so a file is a valid multi-member archive on any file system that
Spark can write to. Of pages with equal payloads the one with the largest page_id is a response, the others are revisits.

The salvage reader checks every member (gzip CRC and length) and record (version line, Content-Length, closing line
breaks, payload digest). After a failed check it searches for the next gzip member that unpacks to a version line, or the
next version line of a plain archive, goes on from there, and logs the bytes in between as a quarantined gap. Inside an
unpacked member it goes on at the next version line too; a gap there is logged with the bounds of its member. Of a member
that is cut off the whole records are kept, of one that fails gzip's checks those that a digest confirms, unless there is
only one record, whose header then is the damaged part.

Defined cases: a null html is an empty payload; a null page_id is kept as null, and is a response only if all pages of its
payload have none; equal rows are all responses or all revisits; null or odd URLs are percent-encoded; an empty table
gives no files and an empty result; other columns are ignored. A file that holds no valid record is one gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm.common import staged
from tradewatch.session import broadcast_if_small, shared_folder

RECORDS_PER_FILE = 2_000
MIN_REVISIT_BYTES = 0
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"
#: An empty gzip member: unpacks to nothing, and parts the records of an archive.
SEPARATOR = gzip.compress(b"", mtime=0)
#: Bytes of an archive that are unpacked at a time.
PIECE = 8_192
HEADERS = (
    "file string, start long, stop long, record_id string, record_type string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long"
)
RECORDS = f"{HEADERS}, payload binary"
GAPS = "file string, start long, stop long, reason string"


def digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, unpacked. A revisit has no block; its payload's digest and length stand in the header."""
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    block = b"" if refers_to is not None else payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", quote(url or "urn:none", safe="%/:?#[]@!$&'()*+,;=~-._")),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", name(refers_to)),
        ]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + END


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 500):
            rows = batch.slice(part, 500).to_pylist()
            packed = [gzip.compress(record(r["page_id"], r["url"], r["payload"], r["refers_to"]), 6, mtime=0) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["member"])


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, least: int = MIN_REVISIT_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html) under ``path``.

    Only (page_id, SHA-1) is grouped to find repeated payloads, and the repeated digests are stored, so that they are
    measured before the join: html moves only if they are too many to broadcast.
    """
    members = with_revisits(pages, least).mapInArrow(_members, "member binary").select(F.col("member").cast("string"))
    writer = members.write.option("lineSep", SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def with_revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, and of a revisit the page_id of the response it refers to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    again = pages.where(F.octet_length("payload") >= least).groupBy("sha1")
    again = again.agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1")
    again = staged(again.select(F.col("sha1").alias("same"), "response_id"), "repeated")
    pages = pages.join(broadcast_if_small(again), F.col("sha1") == F.col("same"), "left")
    other = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return pages.select("page_id", "url", "payload", F.when(other, F.col("response_id")).alias("refers_to"))


class Damaged(ValueError):
    """A check failed; the message says which."""


def parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Header fields, block and end of the plain record at ``at``."""
    line = re.compile(rb"WARC/1\.[01]\r\n").match(data, at)
    if not line:
        raise Damaged("no version line")
    end = data.find(END, at)
    if end < 0:
        raise Damaged("header does not end")
    fields = {}
    for row in data[line.end() : end].split(b"\r\n"):
        key, colon, value = row.partition(b":")
        if not colon:
            raise Damaged("header field without a colon")
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        raise Damaged("no valid Content-Length") from None
    start, stop = end + 4, end + 4 + length
    if length < 0 or data[stop : stop + 4] != END:
        raise Damaged("block does not end where Content-Length says")
    block = data[start:stop]
    if fields.get("warc-type") == "response" and agrees(fields.get("warc-payload-digest"), payloads(fields, block)) is False:
        raise Damaged("payload digest differs")
    return fields, block, stop + 4


def payloads(fields: dict, block: bytes) -> list[bytes]:
    """What a payload digest may cover: the block, or of an HTTP message what follows its head, with and without chunking."""
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return [block]
    head, _, body = block.partition(END)
    if not re.search(rb"(?im)^transfer-encoding:.*chunked", head):
        return [body]
    out, at = [], 0
    while size := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n").match(body, at):
        length = int(size[1], 16)
        out.append(body[size.end() : size.end() + length])
        at = size.end() + length + 2
        if not length:
            break
    return [body, b"".join(out)]


def agrees(named: str | None, contents: list[bytes]) -> bool | None:
    """Whether a digest (``algorithm:value``, the value in Base32 or hexadecimal) is that of one of ``contents``; None if
    there is none or its algorithm is not known."""
    algorithm, colon, value = (named or "").rpartition(":")
    algorithm = algorithm.lower().replace("-", "") if colon else "sha1"
    if not value or algorithm not in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        return None
    sums = [hashlib.new(algorithm, c).digest() for c in contents]
    value = value.rstrip("=").lower()
    return any(value in (x.hex(), base64.b32encode(x).decode().rstrip("=").lower()) for x in sums)


def confirmed(fields: dict, block: bytes) -> bool:
    """Whether a digest of the record's own confirms its content."""
    return bool(agrees(fields.get("warc-block-digest"), [block])) or (
        fields.get("warc-type") == "response" and bool(agrees(fields.get("warc-payload-digest"), payloads(fields, block)))
    )


def unpack(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``. The engine copies what it is given beyond the member's end, so it is
    given the file in pieces."""
    engine, out, stop = zlib.decompressobj(31), [], at
    try:
        while stop < len(data) and not engine.eof:
            part = data[stop : stop + PIECE]
            out.append(engine.decompress(part))
            stop += len(part)
    except zlib.error as error:
        raise Damaged(f"gzip: {str(error)[:60]}") from None
    if not engine.eof:
        raise Damaged("gzip member is cut off")
    return b"".join(out), stop - len(engine.unused_data)


def readable(data: bytes, at: int, stop: int) -> tuple[bytes, bool]:
    """What the damaged gzip member at ``at`` unpacks to before its first error, and whether it is only cut off."""
    engine, out = zlib.decompressobj(31), []
    for start in range(at, stop, 4096):
        before, part = engine.copy(), data[start : min(start + 4096, stop)]
        try:
            out.append(engine.decompress(part))
        except zlib.error:
            try:
                for k in range(len(part)):
                    out.append(before.decompress(part[k : k + 1]))
            except zlib.error:
                pass
            return b"".join(out), False
        if engine.eof:
            break
    return b"".join(out), True


def inside(content: bytes, torn: bool) -> tuple[list[tuple], int]:
    """Records and gaps of a member's content, in order, as (None, fields, block) and (reason, start, stop), and the number
    of records. ``torn``: gzip's checks failed, and only records that a digest confirms count."""
    out, at, gap, reason, records = [], 0, None, "", 0
    while at < len(content):
        try:
            fields, block, stop = parse(content, at)
            if torn and not confirmed(fields, block):
                raise Damaged("no digest confirms the record")
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            following = re.compile(rb"(?<=\n)WARC/1\.[01]\r\n").search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if gap is not None:
            out.append((reason, gap, at))
            gap = None
        out.append((None, fields, block))
        records, at = records + 1, stop
    if gap is not None:
        out.append((reason, gap, len(content)))
    return out, records


def member(data: bytes, at: int) -> tuple[list[tuple], int]:
    """What ``inside`` finds in the member at ``at``, with the failed gzip check as a last gap, and the member's end."""
    if data.startswith(SEPARATOR, at):
        return [], at + len(SEPARATOR)
    try:
        content, stop = unpack(data, at)
    except Damaged as error:
        stop = _next(data, at)
        content, cut = readable(data, at, stop)
        found, records = inside(content, not cut)
        if not records or not cut and len(found) == 1:
            raise
        return [*found, (str(error), len(content), len(content))], stop
    found, records = inside(content, False)
    if found and not records:
        raise Damaged(found[0][0])
    return found, stop


def _starts_member(data: bytes, at: int) -> bool:
    try:
        head = zlib.decompressobj(31).decompress(data[at : at + 4096], 16)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.")


def _next(data: bytes, at: int) -> int:
    """The next place after ``at`` at which a record may start, or the end."""
    for m in re.compile(rb"\x1f\x8b\x08|(?<=\n)WARC/1\.[01]\r\n").finditer(data, at + 1):
        if m.group() != MEMBER or _starts_member(data, m.start()):
            return m.start()
    return len(data)


def salvage(data: bytes) -> Iterator[tuple]:
    """("record", start, stop, fields, block) and ("gap", start, stop, reason), in order, covering ``data``; several of them
    may have the bounds of one member."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                found, stop = member(data, at)
            else:
                fields, block, stop = parse(data, at)
                found = [(None, fields, block)]
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            at = _next(data, at)
            continue
        if gap is not None:
            yield "gap", gap, at, reason
            gap = None
        for why, *what in found:
            if why is None:
                yield "record", at, stop, *what
            else:
                yield "gap", at, stop, f"{why} (unpacked bytes {what[0]} to {what[1]} of the member)"
        at = stop
    if gap is not None:
        yield "gap", gap, len(data), reason


def _records(batches: Iterator[pa.RecordBatch], gaps: bool, payload: bool = True) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64()] + ([pa.string()] if gaps else [pa.string()] * 5 + [pa.int64(), pa.binary()])
    names = [c.split()[0] for c in (GAPS if gaps else RECORDS if payload else HEADERS).split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k, _ in zip(zip(*rows), kinds, names)], names)

    for batch in batches:
        for i in range(batch.num_rows):
            file, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            rows = []
            for kind, start, stop, *rest in salvage(data):
                if gaps != (kind == "gap"):
                    continue
                if gaps:
                    rows.append((file, start, stop, rest[0]))
                else:
                    f, block = rest
                    rows.append((
                        file, start, stop, f.get("warc-record-id"), f.get("warc-type"), f.get("warc-target-uri"),
                        f.get("warc-refers-to"), f.get("warc-payload-digest", "").removeprefix("sha1:") or digest(payloads(f, block)[0]),
                        int(f.get("x-payload-length", len(block))), block,
                    ))
                if len(rows) == 500:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content")


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The valid records of all archives under ``path``. Payloads are checked always, and returned only with ``payload``."""
    return _files(spark, path).mapInArrow(lambda b: _records(b, False, payload), RECORDS if payload else HEADERS)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The gaps: bytes of archives under ``path`` that belong to no valid record, and the check that failed first. A gap
    inside a member has the member's bounds, and its own in the unpacked content as part of the reason."""
    return _files(spark, path).mapInArrow(lambda b: _records(b, True), GAPS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back, one row per record."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/warc"
    write_archives(pages, path)
    rows = read_archives(spark, path, payload=False)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return rows.select(
        number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )
