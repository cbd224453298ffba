"""Ordered passes over groups of any size: Spark sorts, a task sees one Arrow batch at a time.

A grouped map hands a task its group as one table, so its memory follows the group. Here rows are dealt by group and
sorted inside the partition by Spark, which spills; Python takes the sorted rows batch by batch and carries what
the next batch needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_order(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Rows of a group side by side in one partition, by ``order``; missing values last."""
    return df.repartition(*groups).sortWithinPartitions(*groups, *[F.asc_nulls_last(c) for c in order])


def rebatched(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """The same rows in tables of at least ``least`` rows, but for the last."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= least:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def slices(tables: Iterator[pa.Table], groups: list[str]) -> Iterator[tuple[pa.Table, list[tuple[int, int, bool]]]]:
    """Every table with its runs of one group: (start, end, whether the group begins here)."""
    last = None
    for table in tables:
        if table.num_rows == 0:
            continue
        changed = np.zeros(table.num_rows, dtype=bool)
        for name in groups:
            codes = table[name].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            changed[1:] |= codes[1:] != codes[:-1]
        changed[0] = last != tuple(table[name][0].as_py() for name in groups)
        starts = np.flatnonzero(changed).tolist()
        if not changed[0]:
            starts.insert(0, 0)
        ends = [*starts[1:], table.num_rows]
        yield table, [(start, end, bool(changed[start])) for start, end in zip(starts, ends)]
        last = tuple(table[name][-1].as_py() for name in groups)
