"""Exact substring dedup by longest previous factors of suffix arrays over buckets of a corpus.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts at another place too: at any other place, or, with
``keep_first``, at an earlier one (longest previous factor of at least LENGTH), so that the first copy stays.

Every window of LENGTH bytes has an anchor, the place of its smallest hashed gram of ``GRAM`` bytes (the last of equals).
Equal windows have equal anchors at the same offset, so only windows whose anchor's gram occurs again can be equal, and
they meet in the bucket of that gram. Per text and anchor the windows form one stretch, whose bytes (the context) are sent
to the bucket. There the suffixes at the windows' starts are sorted by prefix doubling, compared up to LENGTH bytes, which
gives their order and where neighbours' common prefixes reach LENGTH. Longest previous factors come from the previous and
next smaller places in this order: one of at least LENGTH exists exactly if a smaller place lies in the same run of
neighbours that agree so far. Where every place but one is to go, larger places count in the same way. Buckets of more
than ``BUCKET_ROWS`` contexts are not gathered: their windows are hashed (MD5) and grouped one by one, which is as exact
and has no large group.

Equal texts are one text with a count, and equal contexts one context: each of their windows has a copy elsewhere. Inside
a periodic passage (such as a ruler of dashes) one anchor follows the other and all their windows are equal: the passage is
one row and one context, its later windows are copies of the first.

Defined cases: a null text has no bytes; texts shorter than LENGTH lose nothing; equal rows are copies of each other; with
``keep_first`` the row with the smallest doc_id (null last) keeps its bytes, of several such rows all; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import staged

LENGTH = 400
GRAM = 50
BUCKET_ROWS = 5_000
STRETCH = 1 << 19
#: Contexts sorted together: small enough for the arrays to stay in a core's cache.
TASK_BYTES = 250_000
#: Contexts sent on at a time.
CONTEXT_BYTES = 4_000_000
_REL = np.uint64((1 << 20) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Finds the anchors of the windows of a text."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        step = 0x9E3779B97F4A7C15
        n = STRETCH + length + 1
        self.powers = _powers(step, n)
        self.inverse = _powers(pow(step, -1, 2**64), n)

    def __call__(self, text: bytes) -> tuple[np.ndarray, ...]:
        """Gram hash, first window start, last + 1, and end of its repeats of every stretch of windows with one anchor.

        The end is that of the stretch itself but for stretches that repeat at once, which are one row.
        """
        parts = [self._part(text[at : at + STRETCH + self.length - 1], at) for at in range(0, max(len(text) - self.length + 1, 0), STRETCH)]
        return tuple(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4))

    def _part(self, text: bytes, offset: int) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(text, np.uint8)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)])])
        h = (sums[self.gram :] - sums[: -self.gram]) * self.inverse[: len(raw) - self.gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        rank = (h & ~_REL) | (_REL - np.arange(len(h), dtype=np.uint64))
        width = self.length - self.gram + 1
        blocks = -(-len(rank) // width)
        grid = np.full(blocks * width, ~np.uint64(0))
        grid[: len(rank)] = rank
        grid = grid.reshape(blocks, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(rank) - width + 1
        at = (_REL - (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _REL)).astype(np.int64)
        edges = np.flatnonzero(np.diff(at)) + 1
        low, high = np.append(0, edges), np.append(edges, windows)
        gram, low, high, until = _without_repeats(h[at[low]].view(np.int64), at[low], low, high, self.gram)
        return gram, low + offset, high + offset, until + offset


def _without_repeats(gram: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """Stretches of a periodic passage as one row (gram, low, high, until).

    Neighbouring stretches of one gram whose anchors lie ``period`` = their width apart, no more than a gram's length, make
    the text periodic from the first of these anchors to the last one's end. Windows that start behind the first anchor
    and whose stretch is followed by another lie inside: such stretches are equal.
    """
    period = high - low
    tied = (gram[1:] == gram[:-1]) & (period[1:] == period[:-1]) & (np.diff(anchor) == period[1:]) & (period[1:] <= reach)
    if not tied.any():
        return gram, low, high, high
    begins = np.concatenate([[True], ~tied])
    run = np.cumsum(begins) - 1
    inside = low >= anchor[np.flatnonzero(begins)][run]
    inside[:-1] &= tied
    inside[-1] = False
    follows = np.concatenate([[False], inside[1:] & inside[:-1] & tied])  # equal to the stretch before it
    first = np.flatnonzero(~follows)
    last = np.append(first[1:], len(low)) - 1
    return gram[first], low[first], high[first], high[last]


def _anchored(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    anchors = Anchors(length, gram)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = batch.slice(at, 500)
            found = [anchors(t.as_py() or b"") for t in rows.column("text").cast(pa.binary())]
            sizes = [len(f[0]) for f in found]
            columns = [np.concatenate([f[i] for f in found]) for i in range(4)]
            keys = rows.column("key").take(pa.array(np.repeat(np.arange(rows.num_rows), sizes)))
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(c) for c in columns]], ["key", "gram", "low", "high", "until"])


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["gram", "place", "key", "low", "context"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    rows, size = [], 0
    for batch in batches:
        for at in range(batch.num_rows):
            stretches = batch.column("stretches")[at].values
            key, place, text = (batch.column(c)[at].as_py() for c in ("key", "place", "text"))
            text = text.encode()
            facts = [stretches.field(c).to_numpy() for c in ("gram", "low", "high")]
            for start in range(0, len(stretches), 4096):
                for gram, low, high in zip(*(f[start : start + 4096].tolist() for f in facts)):
                    rows.append((gram, place, key, low, text[low : high - 1 + length]))
                    size += high - low + length
                    if size > CONTEXT_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def suffix_classes(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix at each start by its first ``length`` bytes; equal ranks are equal strings. Ranks of prefixes
    double in length; the last step overlaps two of the longest below ``length``."""
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(length, np.uint8)]).astype(np.uint64)
    n = len(data)
    known = min(8, length)
    key = np.zeros(n, np.uint64)
    for i in range(known):
        key = (key << np.uint64(8)) | raw[i : i + n]
    _, rank = np.unique(key, return_inverse=True)
    while known < length:
        step = min(known, length - known)
        if known + step < length:
            second = np.concatenate([rank[step:], np.zeros(min(step, n), rank.dtype)])[:n]
            _, rank = np.unique(rank * (n + 1) + second, return_inverse=True)
        else:
            _, rank = np.unique(rank[starts] * (n + 1) + rank[starts + step], return_inverse=True)
            return rank
        known += step
    return rank[starts]


def smaller_place(places: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Whether a previous or next smaller place lies in the same run of suffixes, ``places`` being in suffix order and
    ``agree`` telling whether a suffix and the one before it agree: then a factor of that length stands earlier."""
    run = np.cumsum(~agree)
    span = int(places.max(initial=0)) - int(places.min(initial=0)) + 1
    before = np.minimum.accumulate(places - run * span)  # a later run lies wholly below an earlier one
    after = np.minimum.accumulate((places + run * span)[::-1])[::-1]
    return (before < places - run * span) | (after < places + run * span)


def repeated(contexts: list[dict], length: int, keep_first: bool) -> list[tuple[str, int, int]]:
    """(key, first, last + 1) of runs of window starts that are to be removed."""
    counts = np.array([len(c["context"]) - length + 1 for c in contexts])
    offsets = np.concatenate([[0], np.cumsum([len(c["context"]) for c in contexts])[:-1]])
    owner = np.repeat(np.arange(len(contexts)), counts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    classes = suffix_classes(b"".join(c["context"] for c in contexts), offsets[owner] + inner, length)
    order = sorted(range(len(contexts)), key=lambda k: (contexts[k]["place"], contexts[k]["key"], contexts[k]["low"]))
    turn = np.empty(len(contexts), np.int64)
    turn[order] = np.arange(len(contexts))
    places = turn[owner] * (int(counts.max()) + 1) + inner
    suffixes = np.argsort(classes, kind="stable")
    agree = np.concatenate([[False], classes[suffixes[1:]] == classes[suffixes[:-1]]])
    marked = np.zeros(len(owner), bool)
    marked[suffixes] = smaller_place(places[suffixes], agree)
    if not keep_first:
        marked[suffixes] |= smaller_place(-places[suffixes], agree)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)) | np.concatenate(
        [[False], (owner[1:] != owner[:-1]) & marked[1:] & marked[:-1], [False]]).astype(np.int8))
    out = []
    for a, b in zip(edge[:-1], edge[1:]):
        if marked[a]:
            c = contexts[owner[a]]
            out.append((c["key"], c["low"] + int(inner[a]), c["low"] + int(inner[b - 1]) + 1))
    return out


def _repeats(batches: Iterator[pa.RecordBatch], length: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Contexts arrive bucket by bucket; whole buckets are worked on together, TASK_BYTES at a time."""
    held, size, last = [], 0, None

    def done():
        rows = repeated(held, length, keep_first)
        kinds = [pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ([], [], []), kinds)], ["key", "a", "b"])

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            for r in batch.slice(at, 1000).to_pylist():
                if r["gram"] != last and size > TASK_BYTES:
                    yield done()
                    held, size = [], 0
                last = r["gram"]
                held.append(r)
                size += len(r["context"])
    if held:
        yield done()


def _kept(batches: Iterator[pa.RecordBatch], length: int, digests: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows, out = batch.slice(at, 500), []
            for r in rows.to_pylist():
                text = (r["text"] or "").encode()
                runs = [(0, len(text) - length + 1)] if r["whole"] and len(text) >= length else [(x["a"], x["b"]) for x in r["runs"] or []]
                pieces, end, removed, spans = [], 0, 0, 0
                for a, b in sorted(runs):
                    stop = b - 1 + length
                    if a > end or not spans:
                        spans += 1
                        pieces.append(text[end:a])
                        removed += stop - a
                    else:
                        removed += max(0, stop - end)
                    end = max(end, stop)
                kept = b"".join([*pieces, text[end:]])
                out.append((r["doc_id"], len(text), removed, spans, hashlib.sha256(kept).hexdigest() if digests else kept))
            kinds = [pa.int64()] * 4 + [pa.string() if digests else pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def removed_repeats(
    docs: DataFrame, keep_first: bool = False, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS, digests: bool = True
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and kept (SHA-256 of the remaining bytes, or the bytes)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", F.md5("text"))
    long = docs.where(F.octet_length("text") >= length)
    copies = long.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
    copies = staged(copies, "copies")
    anchors = staged(long.mapInArrow(lambda b: _anchored(b, length, gram), "key string, gram long, low long, high long, until long"), "anchors")
    # Windows of a periodic passage but its first: copies of those a period before. The first ones have a copy too.
    within = anchors.where("until > high").select("key", F.col("high" if keep_first else "low").alias("a"), F.col("until").alias("b"))
    place = F.struct("key", "low")
    again = anchors.groupBy("gram").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p <> q").select(F.col("gram").alias("again"))
    again = staged(again, "again")  # a table of its own, so that Spark can split a frequent gram in the join
    stretches = anchors.join(again, F.col("gram") == F.col("again"), "left_semi").groupBy("key")
    stretches = stretches.agg(F.collect_set(F.struct("gram", "low", "high")).alias("stretches"))
    texts = long.groupBy("key").agg(F.first("text").alias("text"), F.coalesce(F.min("doc_id"), F.lit(2**63 - 1)).alias("place"))
    texts = texts.join(stretches.withColumnRenamed("key", "of"), F.col("key") == F.col("of"))
    contexts = texts.select("key", "place", "text", "stretches")
    contexts = contexts.mapInArrow(lambda b: _contexts(b, length), "gram long, place long, key string, low long, context binary")
    contexts = staged(contexts.withColumn("same", F.md5("context")), "contexts")

    # Of equal contexts the first stands for all; every window of the others has an earlier copy.
    spot = F.struct("place", "key", "low")
    groups = contexts.groupBy("gram", "same").agg(F.count("*").alias("n"), F.min(spot).alias("head"), F.first("context").alias("context"))
    groups = staged(groups.select("gram", F.col("same").alias("alike"), "n", "head", "head.*", "context"), "groups")
    copied = contexts.join(groups.where("n > 1").select("alike", F.col("head").alias("first_spot")), F.col("same") == F.col("alike"))
    if keep_first:
        copied = copied.where(spot != F.col("first_spot"))
    copied = copied.select("key", F.col("low").alias("a"), (F.col("low") + F.octet_length("context") - length + 1).alias("b"))
    contexts = groups.select("gram", "place", "key", "low", "context")

    # A context alone in its bucket has no equal windows: these would have the anchor at the same offset, so be one window.
    buckets = contexts.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("gram", "met")
    buckets = staged(buckets, "buckets")
    hot = buckets.where(F.col("n") > bucket_rows).select(F.col("met").alias("hot"))
    shared = buckets.where(F.col("n") <= bucket_rows).select("met")
    usual = contexts.join(shared, F.col("gram") == F.col("met"), "left_semi")
    usual = usual.repartition("gram").sortWithinPartitions("gram")
    runs = usual.mapInArrow(lambda b: _repeats(b, length, keep_first), "key string, a long, b long")
    crowded = contexts.join(hot, F.col("gram") == F.col("hot"), "left_semi")
    each = crowded.select(
        "place", "key", "low", "context", F.explode(F.sequence(F.lit(0), F.octet_length("context") - length)).alias("i")
    )
    each = each.select("place", "key", (F.col("low") + F.col("i")).alias("a"), F.md5(F.expr(f"substring(context, i + 1, {length})")).alias("window"))
    where = F.struct("place", "key", "a")
    twice = each.groupBy("window").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first <> last")
    single = each.join(twice.withColumnRenamed("window", "same"), F.col("window") == F.col("same"))
    if keep_first:
        single = single.where(where != F.col("first"))
    runs = runs.union(single.select("key", "a", (F.col("a") + 1).alias("b"))).union(copied).union(within)
    runs = runs.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    found = copies.where("n > 1").join(runs.withColumnRenamed("key", "of"), F.col("key") == F.col("of"), "full")
    found = staged(found.select(F.coalesce("key", "of").alias("of"), "n", "first_id", "runs"), "found")
    rows = docs.join(found, F.col("key") == F.col("of"), "left")
    whole = F.col("n").isNotNull()
    if keep_first:
        whole = whole & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    rows = rows.select("doc_id", "text", whole.alias("whole"), "runs")
    kind = "string" if digests else "binary"
    return rows.mapInArrow(lambda b: _kept(b, length, digests), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}")


def document_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, repeated (whether a string of it stands elsewhere too), n_removed, n_spans, n_bytes,
    kept_sha256; every place of a repeated string is removed."""
    return removed_repeats(docs).select(
        "doc_id", (F.col("n_removed") > 0).alias("repeated"), "n_removed", "n_spans", "n_bytes", F.col("kept").alias("kept_sha256")
    )
