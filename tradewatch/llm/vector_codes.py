"""Product codes of integer vectors, with codebooks trained by exact search over Walsh-Hadamard coefficients.

A vector is cut into equal parts; each part position has a codebook. A round assigns every part to its nearest entry and
moves each entry to the floored mean of its parts. Parts and entries are zero-padded to a power of two and transformed;
scaled squared differences are summed in sequency order and entries that are strictly worse go early (``walsh.nearest``).
Only sums per entry leave a task, and the driver holds codebooks alone: parts x entries x width of a part numbers.

Defined cases: vectors that are null or hold a null or non-finite component take no part; shorter vectors (empty ones
too) end in zeros up to the longest; a width that the parts do not divide is padded likewise; with fewer rows than
entries, codebooks have one entry per row; equal rows are separate rows; rows without an id come last; an empty table
gives an empty result; other columns are ignored. A component that would overflow exact sums is an error.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import walsh
from tradewatch.llm.common import staged

_PARTIAL = "part int, entry int, n long, sums array<long>"


def _partial_sums(batches: Iterator[pa.RecordBatch], books: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Sums and counts of the parts that fall to each entry, over all rows of a task."""
    parts, entries, size = books.shape
    turned = [walsh.transform(book) for book in books]
    counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
    for batch in batches:
        rows = walsh.matrix(batch.column(0), width).reshape(-1, parts, size)
        for p in range(parts):
            nearest, _ = walsh.nearest(walsh.transform(rows[:, p]), turned[p])
            counts[p] += np.bincount(nearest, minlength=entries)
            np.add.at(sums[p], nearest, rows[:, p])
    part, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
            pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
        ],
        ["part", "entry", "n", "sums"],
    )


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of (id, label, v) with their code and error in place of v."""
    parts, _, size = books.shape
    turned = [walsh.transform(book) for book in books]
    digits = max(2, len(f"{books.shape[1] - 1:x}"))
    for batch in batches:
        rows = walsh.matrix(batch.column(2), width).reshape(-1, parts, size)
        codes, error = [], np.zeros(len(rows), np.int64)
        for p in range(parts):
            nearest, distance = walsh.nearest(walsh.transform(rows[:, p]), turned[p])
            codes.append([f"{x:0{digits}x}" for x in nearest.tolist()])
            error += distance
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(map("".join, zip(*codes)), pa.string()), pa.array(error)],
            ["id", "label", "code", "error"],
        )


def train(vectors: DataFrame, width: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, place) after so many rounds, from the rows with the smallest ids."""
    size = width // parts
    first = vectors.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    rows = np.zeros((len(first), width), np.int64)
    for i, row in enumerate(first):
        rows[i, : len(row["v"])] = row["v"]
    books = rows.reshape(-1, parts, size).swapaxes(0, 1).copy()
    for _ in range(rounds):
        partial = vectors.select("v").mapInArrow(lambda b, books=books: _partial_sums(b, books, width), _PARTIAL)
        sums, counts = [defaultdict(dict) for _ in range(parts)], [{} for _ in range(parts)]
        for r in walsh.sums_by_place(partial, ["part", "entry"]):
            counts[r["part"]][r["entry"]] = r["n"]
            sums[r["part"]][r["entry"]][r["place"]] = int(r["total"])
        books = np.stack([walsh.means(s, c, book) for s, c, book in zip(sums, counts, books)])
    return books


def product_codes(
    rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id",
    vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error and the digest of the final codebooks, a row per vector that takes part."""
    kept = rows.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("x")).where(walsh.finite(F.col("x")))
    longest = kept.agg(F.max(F.size("x"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    vectors = staged(
        kept.select("id", "label", walsh.integers(F.col("x"), scale, walsh.magnitude_limit(width // parts)).alias("v")), "integers"
    )
    books = train(vectors, width, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    coded = staged(vectors.mapInArrow(
        lambda batches: _coded(batches, books, width), f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    ), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
