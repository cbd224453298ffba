"""Near-duplicates: MinHash bands, sequential Bayesian verification, components.

Documents with equal shingle sets are one class from the start. Each class has a MinHash signature; bands of it are
buckets, and classes that share a bucket are candidates. The number of rows per band is the largest that misses a pair at
the threshold with at most ``MISS`` chance. Candidates of a bucket are compared on their signatures batch by batch: after
each batch the pair is dropped if the posterior chance that its similarity reaches the threshold (uniform prior) is below
``EPSILON``. The survivors are verified on the full shingle sets, and links join components.

To keep what is written linear in a group that is connected, the first ``FOREST_ROUNDS`` rounds propose only survivors that
join different components, at most a spanning forest per bucket, each round in another hashed order of the members. The
last round verifies every survivor that is still between two components on the spot, each pair in the first bucket that it
shares, and writes only links. So every candidate pair ends up verified or connected. Buckets with the same members are
looked at once; buckets of more than ``BLOCK`` members are cut into blocks; these meet pairwise, in different tasks,
in the last round, while in the others each is for itself and dealt anew.

Defined cases: null texts and texts without words have the empty set, are linked with nothing and stay; texts with fewer
words than a shingle have their whole sequence as one shingle; equal rows are one class; rows that share a doc_id are told
apart by their texts, but ``kept`` goes by doc_id alone; a null doc_id takes part but is never a component's name unless all
ids of the component are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import WORD, staged

HASHES = 128
BATCH = 16
MISS = 1e-6
EPSILON = 1e-6
BLOCK = 256
FOREST_ROUNDS = 2
KNOWN_WORDS = 200_000
KNOWN_SETS = 500


def rows_per_band(percent: int, hashes: int = HASHES, miss: float = MISS) -> int:
    """The longest bands that still find a pair at the threshold with a chance of 1 - ``miss``."""
    s = percent / 100
    return max([r for r in range(1, 17) if (1 - s**r) ** (hashes // r) <= miss], default=1)


def least_matches(percent: int, hashes: int = HASHES, batch: int = BATCH, epsilon: float = EPSILON) -> list[int]:
    """For each number of compared hashes the fewest matches with which a pair lives on: with m of n matches and a uniform
    prior, the similarity is at least s with the chance that n + 1 trials of chance s have at most m successes."""
    s, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
            if below >= epsilon:
                break
            m += 1
        out.append(m)
    return out


class Shingler:
    """Shingle sets as sorted arrays of 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        self.words: dict[bytes, int] = {}
        self.odd = np.array([(2 * i + 1) * 0x9E3779B97F4A7C15 % 2**64 | 1 for i in range(1, width + 1)], np.uint64)

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        if len(h) < self.width:
            return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], np.uint64)
        n = len(h) - self.width + 1
        out = np.zeros(n, np.uint64)
        for i, odd in enumerate(self.odd):
            x = h[i : i + n] * odd
            out = (out ^ x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
        return np.unique(out)


def _factors(hashes: int) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.sha256(b"minhash %d" % i).digest()[:8], "little") | 1 for i in range(hashes)], np.uint64)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest product of each factor with the shingles (its high half)."""
    low = None
    for at in range(0, len(shingles), 256):
        part = np.multiply.outer(factors, shingles[at : at + 256]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return (low >> np.uint64(32)).astype(np.uint32)


def _signed(batches: Iterator[pa.RecordBatch], width: int, hashes: int) -> Iterator[pa.RecordBatch]:
    shingler, factors = Shingler(width), _factors(hashes)
    for batch in batches:
        for part in range(0, batch.num_rows, 1000):
            rows = batch.slice(part, 1000)
            sets = [shingler(t.as_py()) for t in rows.column("text").cast(pa.binary())]
            keys = [None if not len(s) else xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            signs = [None if not len(s) else signature(s, factors).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("pick"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(signs, pa.binary())],
                ["doc_id", "pick", "n_shingles", "class", "signature"],
            )


def _bands(batches: Iterator[pa.RecordBatch], rows_: int, hashes: int) -> Iterator[pa.RecordBatch]:
    bands = hashes // rows_
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        m = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(n, hashes)
        keys = np.zeros((n, bands), np.uint64)
        for i in range(rows_):
            x = (keys ^ m[:, i : bands * rows_ : rows_].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            keys = x ^ (x >> np.uint64(29))
        keys = (keys ^ np.arange(1, bands + 1, dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64).ravel()), batch.column("id").take(pa.array(np.repeat(np.arange(n), bands)))], ["bucket", "id"]
        )


class _Forest:
    """Union-find over the members of one bucket."""

    def __init__(self, components: np.ndarray):
        _, self.of = np.unique(components, return_inverse=True)

    def join(self, a: int, b: int) -> None:
        self.of[self.of == self.of[b]] = self.of[a]


def survivors(i: int, rest: np.ndarray, sizes: np.ndarray, signs: np.ndarray, least: list[int], percent: int) -> np.ndarray:
    """Those of the members ``rest`` that pass the sequential test against member ``i``, the likeliest first."""
    a, b = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
    rest = rest[100 * a >= percent * b]
    matches = np.zeros(len(rest), np.int64)
    for k, fewest in enumerate(least):
        if not len(rest):
            break
        columns = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (signs[rest, columns] == signs[i, columns]).sum(1)
        rest, matches = rest[matches >= fewest], matches[matches >= fewest]
    return rest[np.argsort(-matches, kind="stable")]


def block_links(rows: list[dict], hashes: int, least: list[int], percent: int, shingler: Shingler | None) -> Iterator[tuple[int, int]]:
    """Links within a block (all rows of side 0) or between two blocks, of members in different components, at most a
    forest: proposals if there is no ``shingler``, else verified links among all survivors."""
    ids = np.array([r["id"] for r in rows], np.int64)
    sizes = np.array([r["n_shingles"] for r in rows], np.int64)
    signs = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint32).reshape(len(rows), hashes)
    forest, n = _Forest(np.array([r["component"] for r in rows], np.int64)), len(rows)
    edge = sum(r["side"] == 0 for r in rows)
    across, bucket = edge < n or rows[0]["block"] != rows[0]["other"], rows[0]["bucket"]
    if shingler is not None:
        own = [sorted(b for b in r["buckets"] if b < bucket) for r in rows]
        earlier = np.zeros((n, max(map(len, own), default=0)), np.int64)
        for k, b in enumerate(own):
            earlier[k, : len(b)] = b
        sets: dict[int, np.ndarray] = {}

    def shingles(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = shingler(rows[k]["text"])
        return sets[k]

    for i in range(edge):
        rest = np.arange(edge if across else i + 1, n)
        rest = rest[forest.of[rest] != forest.of[i]]
        if shingler is not None and len(rest):
            seen = np.zeros(len(rest), bool)  # pairs that an earlier bucket has looked at
            for b in own[i]:
                seen |= (earlier[rest] == b).any(1)
            rest = rest[~seen]
        for j in survivors(i, rest, sizes, signs, least, percent):
            if forest.of[j] == forest.of[i]:
                continue
            if shingler is not None:
                common = len(np.intersect1d(shingles(i), shingles(int(j)), assume_unique=True))
                if 100 * common < percent * (int(sizes[i]) + int(sizes[j]) - common):
                    continue
            forest.join(i, int(j))
            yield int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))


def _linked(batches: Iterator[pa.RecordBatch], percent: int, hashes: int, width: int | None) -> Iterator[pa.RecordBatch]:
    """Rows of (bucket, block, other) arrive sorted; each such group becomes its links. ``width``: verify them."""
    least, shingler = least_matches(percent, hashes), None if width is None else Shingler(width)
    name, rows, out = None, [], []

    def flush():
        pairs = np.array(out, np.int64).reshape(-1, 2)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            for r in batch.slice(at, 500).to_pylist():
                if (key := (r["bucket"], r["block"], r["other"])) != name:
                    if rows:
                        out.extend(block_links(rows, hashes, least, percent, shingler))
                    name, rows = key, []
                rows.append(r)
            if len(out) > 10_000:
                yield flush()
    if rows:
        out.extend(block_links(rows, hashes, least, percent, shingler))
    yield flush()


def _verified(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    shingler, sets = Shingler(width), {}

    def shingles(name, text):
        if name not in sets:
            if len(sets) >= KNOWN_SETS:
                sets.clear()
            sets[name] = shingler(text)
        return sets[name]

    for batch in batches:
        linked = []
        for r in batch.to_pylist():
            own, other = shingles(r["a"], r["text_a"]), shingles(r["b"], r["text_b"])
            common = len(np.intersect1d(own, other, assume_unique=True))
            linked.append(100 * common >= percent * (len(own) + len(other) - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of ``links`` (a, b) reaches, by alternating large and small stars."""
    edges = staged(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v <> m").distinct(), "edges")
    before = None
    while True:
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).union(edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("least")).withColumnRenamed("u", "center")
        large = both.join(least, F.col("u") == F.col("center")).where("w > u").select(F.col("w").alias("v"), F.col("least").alias("m"))
        large = large.distinct()
        least = large.groupBy("v").agg(F.min("m").alias("least")).withColumnRenamed("v", "center")
        small = large.join(least, F.col("v") == F.col("center"))
        small = small.select(F.col("m").alias("v"), F.col("least").alias("m")).union(small.select("v", F.col("least").alias("m")))
        edges = staged(small.where("v <> m").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    names = edges.select(F.col("m").alias("id"), F.col("m").alias("component")).distinct()
    return edges.select(F.col("v").alias("id"), F.col("m").alias("component")).union(names)


def _pick(doc_id: Column, text: Column) -> Column:
    """A name for rows of one doc_id and one text."""
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.md5(text), F.lit("-"))))


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, hashes: int = HASHES, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that it reaches by links), kept."""
    signed, named = _groups(docs, width, percent, hashes, block)
    named = named.select(F.col("class").alias("of_class"), F.col("head.doc_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "class").join(named, F.col("class") == F.col("of_class"), "left")
    name = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", name.alias("component_id"), F.col("doc_id").eqNullSafe(name).alias("kept"))


def _groups(docs: DataFrame, width: int, percent: int, hashes: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The documents with their class, and each class with its component and that component's first document (head)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn("pick", _pick(F.col("doc_id"), F.col("text")))
    rows = docs.mapInArrow(lambda b: _signed(b, width, hashes), "doc_id long, pick string, n_shingles long, class binary, signature binary")
    signed = staged(rows, "signed")
    classes = signed.where("class is not null").groupBy("class")
    head = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "pick")
    classes = classes.agg(F.min(head).alias("head"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = staged(classes.withColumn("id", F.xxhash64("class")), "classes")

    band = rows_per_band(percent, hashes)
    buckets = classes.select("id", "signature").mapInArrow(lambda b: _bands(b, band, hashes), "bucket long, id long")
    groups = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("members"))
    groups = groups.where("n > 1").groupBy("n", "members").agg(F.min("bucket").alias("of_bucket"))
    members = buckets.join(groups, F.col("bucket") == F.col("of_bucket")).select("bucket", "n", "id")
    members = staged(members, "members")

    joined = None
    ids = staged(members.select("id").distinct(), "ids")
    texts = staged(_texts_of(docs, classes, ids), "texts")
    infos = staged(classes.join(ids, "id", "left_semi").select("id", "n_shingles", "signature"), "infos")
    for turn in range(FOREST_ROUNDS + 1):
        current = infos.withColumn("component", F.col("id"))
        if joined is not None:
            current = infos.join(joined.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left").drop("of")
            current = current.withColumn("component", F.coalesce("component", "id"))
        rows = _round(members, current, turn, block)
        if turn < FOREST_ROUNDS:
            pairs = _together(rows).mapInArrow(lambda b: _linked(b, percent, hashes, None), "a long, b long").distinct()
            left, right = (texts.select(F.col("id").alias(f"id_{s}"), F.col("text").alias(f"text_{s}")) for s in "ab")
            checked = pairs.join(right, F.col("b") == F.col("id_b")).join(left, F.col("a") == F.col("id_a"))
            checked = checked.select("a", "b", "text_a", "text_b").mapInArrow(
                lambda b: _verified(b, width, percent), "a long, b long, linked boolean"
            )
            found = staged(checked.where("linked").select("a", "b"), "found")
        else:
            rows = rows.join(texts.withColumnRenamed("id", "text_id"), F.col("id") == F.col("text_id")).drop("text_id")
            every = members.groupBy(F.col("id").alias("every_id")).agg(F.collect_set("bucket").alias("buckets"))
            rows = _together(rows.join(every, F.col("id") == F.col("every_id")).drop("every_id"))
            found = staged(rows.mapInArrow(lambda b: _linked(b, percent, hashes, width), "a long, b long").distinct(), "found")
        if found.isEmpty():
            continue
        known = found if joined is None else joined.select(F.col("id").alias("a"), F.col("component").alias("b")).union(found)
        joined = components(known)  # stars of the rounds before stand for their links

    named = classes.select("class", "id", "head")
    if joined is not None:
        named = named.join(joined.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
        named = named.withColumn("component", F.coalesce("component", "id"))
        least = named.groupBy("component").agg(F.min("head").alias("first")).withColumnRenamed("component", "whole")
        named = named.join(least, F.col("component") == F.col("whole")).select("class", "component", F.col("first").alias("head"))
    else:
        named = named.select("class", F.col("id").alias("component"), "head")
    return signed, named


def _texts_of(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of one document of each class in ``ids``; the text as bytes, as words are words of bytes."""
    wanted = classes.join(ids.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left_semi")
    wanted = wanted.select("id", F.col("head.pick").alias("wanted"))
    texts = docs.groupBy("pick").agg(F.first("text").cast("binary").alias("text"))
    return wanted.join(texts, F.col("wanted") == F.col("pick")).select("id", "text")


def _round(members: DataFrame, current: DataFrame, turn: int, block: int) -> DataFrame:
    """The members of buckets with more than one component, with what is known of them, block by block."""
    parts = current.select(F.col("id").alias("of"), "component")
    rows = members.join(parts, F.col("id") == F.col("of")).drop("of")
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rows = rows.join(mixed.select(F.col("bucket").alias("mixed")), F.col("bucket") == F.col("mixed"), "left_semi")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("id", "bucket", F.lit(turn)), blocks).cast("int")
    meets = F.col("own") if turn < FOREST_ROUNDS else F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = rows.withColumn("own", own).withColumn("with", meets)
    rows = rows.select(
        "bucket", "id", F.least("own", "with").alias("block"), F.greatest("own", "with").alias("other"),
        F.when(F.col("own") <= F.col("with"), 0).otherwise(1).alias("side"),
    )
    facts = current.withColumnRenamed("id", "of")
    rows = rows.join(facts, F.col("id") == F.col("of")).drop("of").withColumn("turn", F.xxhash64("id", F.lit(turn)))
    return rows


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "block", "other").sortWithinPartitions("bucket", "block", "other", "side", "turn")


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest doc_id (null last; of equal doc_ids that with the
    smallest hash of its text, of equal texts the smallest row). Rows whose text has no word all stay."""
    _, named = _groups(docs, width, percent, HASHES, BLOCK)
    firsts = named.select(F.col("head.pick").alias("wanted")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    words = F.coalesce(F.col("row.text").cast("string").rlike(WORD), F.lit(False))
    rows = rows.withColumn("pick", F.when(words, _pick(F.col("row.doc_id").cast("long"), F.col("row.text").cast("string"))))
    own = rows.where(F.col("pick").isNotNull()).join(firsts, F.col("pick") == F.col("wanted"), "left_semi")
    own = own.groupBy("pick").agg(F.min("row").alias("row")).select("row.*")
    return own.union(rows.where(F.col("pick").isNull()).select("row.*"))
