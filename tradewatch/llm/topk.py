"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Candidates are packed into blocks of rows, each block an inverted index: for every dimension a posting of weights. For a
query row, the postings of its non-zero dimensions are weighted and scattered into one dense array of scores for the
block; a partition selects the block's best k, and the best of all blocks are merged. Every pair is scored.

Rows are numbered once, in a stored table: a query is a row, and every row but itself is its candidate.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no part; equal rows, and rows that
share an id, are separate queries and candidates of each other; a row without an id is neither; dimensions missing in the
shorter of two vectors count as 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import staged

BLOCK_ROWS = 8192
QUERY_ROWS = 512
#: Blocks meet in a grid of tasks, whose sides grow with the square root of the number of blocks, within these limits.
LANES = (8, 256)


def integer_vectors(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """``v``: floor(scale * x) per component, as long, for the vectors that take part."""
    x = F.col(vector)
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = rows.where(x.isNotNull() & (F.size(x) > 0)).where(~F.exists(x, lambda c: bad(c.cast("double"))))
    return rows.withColumn("v", F.transform(x, lambda c: F.floor(c.cast("double") * scale)))


def _small(m: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them."""
    low, high = m.min(initial=0), m.max(initial=0)
    return m.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _packed(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows of (row, id, v) as blocks: row numbers, ids, a dense little-endian matrix by dimension, its width."""
    def block(numbers, ids, vectors):
        width = max(map(len, vectors))
        m = np.zeros((width, len(vectors)), np.int64)
        for i, v in enumerate(vectors):
            m[: len(v), i] = v
        return pa.RecordBatch.from_arrays(
            [
                pa.array([numbers], pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64())),
                pa.array([_small(m).tobytes()], pa.binary()), pa.array([width], pa.int32()),
            ],
            ["numbers", "ids", "m", "width"],
        )

    numbers, ids, vectors = [], [], []
    for batch in batches:
        numbers += batch.column(0).to_pylist()
        ids += batch.column(1).to_pylist()
        vectors += batch.column(2).to_pylist()
        while len(ids) >= rows:
            yield block(numbers[:rows], ids[:rows], vectors[:rows])
            numbers, ids, vectors = numbers[rows:], ids[rows:], vectors[rows:]
    if ids:
        yield block(numbers, ids, vectors)


def blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    return rows.select("row", "id", "v").mapInArrow(
        lambda batches: _packed(batches, block_rows), "numbers array<bigint>, ids array<bigint>, m binary, width int"
    )


def _matrix(data: bytes, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"i{len(data) // (width * rows)}").reshape(width, rows).astype(np.int64)


def block_scores(query: np.ndarray, candidates: np.ndarray) -> Iterator[np.ndarray]:
    """The scores of each query (column of ``query``) with all candidates of a block, term by term."""
    terms = min(len(query), len(candidates))
    most = float(np.abs(query).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(terms, 1)
    kind = np.int32 if most < 2**31 else np.int64
    postings = candidates[:terms].astype(kind)
    filled = [np.flatnonzero(p) for p in postings]
    dense = [2 * len(f) >= len(p) for f, p in zip(filled, postings)]
    scores, step = np.empty(candidates.shape[1], kind), np.empty(candidates.shape[1], kind)
    for weights in query[:terms].T.astype(kind):
        scores[:] = 0
        for t in np.flatnonzero(weights):
            if dense[t]:  # the posting names nearly every row of the block
                np.multiply(postings[t], weights[t], out=step)
                scores += step
            else:
                scores[filled[t]] += postings[t][filled[t]] * weights[t]
        yield scores


def best(scores: np.ndarray, ids: np.ndarray, numbers: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates other than row ``own``, ties to the smaller id."""
    n = len(scores)
    room = k + 1
    if n > room:
        least = np.partition(scores, n - room)[n - room]
        over = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)
        at = np.concatenate([over, level[np.argsort(ids[level], kind="stable")[: room - len(over)]]])
    else:
        at = np.arange(n)
    at = at[numbers[at] != own]
    at = at[np.lexsort((ids[at], -scores[at].astype(np.int64)))][:k]
    return ids[at], scores[at]


def _scored(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            numbers, ids = np.array(r["numbers"], np.int64), np.array(r["ids"], np.int64)
            rows, query_ids = np.array(r["query_numbers"], np.int64), np.array(r["query_ids"], np.int64)
            queries = _matrix(r["query_m"], r["query_width"], len(rows))
            candidates = _matrix(r["m"], r["width"], len(ids))
            found = [best(scores, ids, numbers, own, k) for own, scores in zip(rows, block_scores(queries, candidates))]
            sizes = [len(f[0]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(rows, sizes)), pa.array(np.repeat(query_ids, sizes)),
                    pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)),
                ],
                ["row", "query_id", "vec_id", "score"],
            )


def lanes(rows: int, block_rows: int) -> int:
    """Lanes that the blocks of so many rows are dealt over."""
    return min(max(LANES[0], math.isqrt(-(-rows // block_rows)) + 1), LANES[1])


def top_k(
    rows: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k best candidates of every row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Each block of candidates meets each block of queries once, in the cell of the grid that their lanes name.
    """
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("x")).where("id is not null")
    rows = integer_vectors(rows, "x", scale).select(F.monotonically_increasing_id().alias("row"), "id", "v")
    rows = staged(rows, "vectors")  # numbers must not change when a task runs again
    asked = F.col("id") % every == 0
    count, queries_count = rows.agg(F.count("*"), F.count_if(asked)).first()
    sides = lanes(count, block_rows), lanes(queries_count, query_rows)
    lane = lambda n: F.pmod(F.xxhash64("numbers"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = blocks(rows.where(asked), query_rows).withColumn("query_lane", lane(sides[1])).withColumn("lane", each(sides[0]))
    queries = queries.withColumnsRenamed({c: f"query_{c}" for c in ("numbers", "ids", "m", "width")})
    candidates = blocks(rows, block_rows).withColumn("lane", lane(sides[0])).withColumn("query_lane", each(sides[1]))
    pairs = candidates.join(queries, ["lane", "query_lane"])
    found = pairs.mapInArrow(lambda batches: _scored(batches, k), "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
