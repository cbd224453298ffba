"""Integer Walsh-Hadamard transforms and exact nearest-row search by their coefficients.

The transform of two rows of n integers keeps squared distances up to the factor n: |Tp - Te|^2 = n |p - e|^2. With the
coefficients in sequency order (by number of sign changes) the first ones hold the coarse shape of a row, so a partial
sum of squared differences soon exceeds the distance to a good candidate. All arithmetic is in 64-bit integers.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs of row and candidate whose first coefficients are compared at a time.
PAIRS = 1 << 17


def padded(width: int) -> int:
    """The power of two that a row of ``width`` numbers is padded to."""
    return 1 << max(width - 1, 0).bit_length()


def magnitude_limit(width: int) -> int:
    """Components below this size keep every sum of squared coefficient differences below 2^62."""
    return 1 << ((60 - 3 * (padded(width).bit_length() - 1)) // 2)


@lru_cache
def sequency_order(n: int) -> np.ndarray:
    """Places of the Sylvester-Hadamard rows by number of sign changes."""
    place = np.arange(n)
    rows = 1 - 2 * (np.bitwise_count(place[:, None] & place[None, :]) & 1).astype(np.int64)
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, zero-padded to a power of two, in sequency order."""
    n = padded(rows.shape[1])
    out = np.zeros((len(rows), n), np.int64)
    out[:, : rows.shape[1]] = rows
    half = 1
    while half < n:
        pair = out.reshape(len(rows), n // (2 * half), 2, half)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(len(rows), n)
        half *= 2
    return out[:, sequency_order(n)]


def _stages(n: int) -> list[tuple[int, int]]:
    """Ranges of coefficients, each as long as all before it."""
    edges = [0, min(4, n)]
    while edges[-1] < n:
        edges.append(2 * edges[-1])
    return list(zip(edges, edges[1:]))


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each point, ties to the lower index.

    Both are transforms. The entry with the least sum over the first coefficients gives each point a reachable
    distance; entries whose partial sum is strictly above it go after every stage, the others are summed to the end.
    """
    n, stages = points.shape[1], _stages(points.shape[1])
    index, distance = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    at_once = max(1, PAIRS // max(len(entries), 1))
    for start in range(0, len(points), at_once):
        part = points[start : start + at_once]
        partial = np.zeros((len(part), len(entries)), np.int64)
        for k in range(*stages[0]):
            step = part[:, k, None] - entries[None, :, k]
            partial += step * step
        guess = partial.argmin(axis=1)
        rest = part[:, stages[0][1] :] - entries[guess, stages[0][1] :]
        reach = partial[np.arange(len(part)), guess] + (rest * rest).sum(axis=1)
        row, entry = np.nonzero(partial <= reach[:, None])
        sums = partial[row, entry]
        for first, end in stages[1:]:
            step = part[row, first:end] - entries[entry, first:end]
            sums = sums + (step * step).sum(axis=1)
            left = sums <= reach[row]
            row, entry, sums = row[left], entry[left], sums[left]
        order = np.lexsort((entry, sums, row))
        first_of_row = order[np.r_[True, row[order][1:] != row[order][:-1]]] if len(order) else order
        index[start : start + at_once], distance[start : start + at_once] = entry[first_of_row], sums[first_of_row] // n
    return index, distance


def means(sums: dict, counts: dict, before: np.ndarray) -> np.ndarray:
    """The entries moved to the floored means of their members; entries without members stay."""
    out = before.copy()
    for entry, n in counts.items():
        for place, total in sums[entry].items():
            out[entry, place] = total // n
    return out


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, lambda c: bad(c.cast("double"))), F.lit(False))


def integers(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of each component; a component that would leave 64 bits in later sums is an error."""
    scaled = lambda c: F.floor(c.cast("double") * scale).cast("int")
    small = F.forall(vector, lambda c: F.abs(c.cast("double") * scale) < limit)
    return F.when(small, F.transform(vector, scaled)).otherwise(
        F.raise_error(F.lit(f"a component times {scale} reaches {limit}, beyond exact 64-bit sums"))
    )


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of ``width`` numbers; shorter lists end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(vectors), width)
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def sums_by_place(partial: DataFrame, keys: list[str]) -> list:
    """Rows (keys, place, n, total) of the partial sums (keys, n, sums) that tasks have reported."""
    flat = partial.select(*keys, "n", F.posexplode("sums").alias("place", "value"))
    return flat.groupBy(*keys, "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total")
    ).collect()
