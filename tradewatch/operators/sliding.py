"""Sums and moments over the last k rows of an array, at a cost that does not depend on k.

Helpers for grouped-map tasks: Spark partitions, shuffles and bounds the groups, these evaluate
the frames inside one group. The array is cut into chunks of k; every frame of k rows is the tail
of one chunk plus the head of the next, and heads and tails are running sums inside a chunk.
Values are only ever added, so an extreme value leaves no rounding error once out of the frame.
"""

from __future__ import annotations

import numpy as np


def _chunks(values: np.ndarray, k: int, fill) -> np.ndarray:
    rows = -(-len(values) // k)
    padded = np.full(rows * k, fill, dtype=values.dtype)
    padded[: len(values)] = values
    return padded.reshape(rows, k)


def _heads_and_tails(chunks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    heads = chunks.cumsum(axis=1).ravel()[:n]
    tails = chunks[:, ::-1].cumsum(axis=1)[:, ::-1].ravel()
    return heads, tails


def _frame_starts(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose frame begins in the chunk before theirs, and where it begins."""
    start = np.arange(n) - (k - 1)
    rows = np.flatnonzero((start > 0) & (start % k != 0))
    return rows, start[rows]


def sliding_sum(values: np.ndarray, k: int) -> np.ndarray:
    """Sum of each value and up to ``k - 1`` values before it."""
    n = len(values)
    if n == 0:
        return values.copy()
    heads, tails = _heads_and_tails(_chunks(values, k, 0), n)
    rows, start = _frame_starts(n, k)
    heads[rows] += tails[start]
    return heads


def sliding_m2(values: np.ndarray, k: int) -> np.ndarray:
    """Sum of squared deviations from the frame mean, over the same frames.

    Heads and tails are centred on the median of their chunk and joined by the pairwise formula of
    Chan, Golub and LeVeque (1983), which avoids subtracting large squares.
    """
    n = len(values)
    if n == 0:
        return values.astype(float)
    chunks = _chunks(values.astype(float), k, values[-1])
    centre = np.median(chunks, axis=1)
    centred = chunks - centre[:, None]
    head_1, tail_1 = _heads_and_tails(centred, n)
    head_2, tail_2 = _heads_and_tails(centred * centred, n)
    index = np.arange(n)
    head_n = index % k + 1.0
    m2 = head_2 - head_1 * head_1 / head_n
    rows, start = _frame_starts(n, k)
    tail_n = k - start % k
    tail_mean = centre[start // k] + tail_1[start] / tail_n
    head_mean = centre[rows // k] + head_1[rows] / head_n[rows]
    gap = head_mean - tail_mean
    m2[rows] += tail_2[start] - tail_1[start] ** 2 / tail_n
    m2[rows] += gap * gap * (head_n[rows] * tail_n / (head_n[rows] + tail_n))
    return np.maximum(m2, 0.0)


def shifted(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The value ``k`` rows earlier and a mask of the rows that have none."""
    out = np.zeros_like(values)
    out[k:] = values[:-k] if k < len(values) else values[:0]
    return out, np.arange(len(values)) < k
