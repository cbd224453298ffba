"""Cooldown thinning: an event passes if none has passed for its key in the last N seconds.

The interval counts from the last event that passed, so this is an ordered fold, not a window.
Small keys are folded whole. A key too large for one task is cut into cells of consecutive events.
What a cell does to the state is a step function, and two neighbouring ones compose into one, an
associative operation: groups of ``FAN_IN`` neighbours are composed level by level up to the whole
key, and the true entry states are then handed down the same tree (a parallel prefix). At last all
cells emit in parallel. Rows pass in order, batch by batch; no task holds more than a batch, the times of a cell or a
batch of step functions, none of which is longer than a cell, and the result is the same as one sequential pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.operators.blocks import join_null_safe, split_keys
from tradewatch.operators.runs import in_order, rebatched, slices
from tradewatch.session import materialise

_NEVER = -(2**62)
#: Step functions that one task composes.
FAN_IN = 8
_STEPS = "_first bigint, _upto array<bigint>, _final array<bigint>"


def passing(times: np.ndarray, gap: int, not_before: int = _NEVER) -> np.ndarray:
    """Indices that pass, for sorted ``times`` and a gap above 0; nothing passes earlier than ``not_before``."""
    if gap <= 0:
        raise ValueError("the gap must be above 0")
    picked = []
    i = int(np.searchsorted(times, not_before, side="left"))
    while i < len(times):
        picked.append(i)
        i = int(np.searchsorted(times, times[i] + gap, side="left"))
    return np.asarray(picked, dtype=np.int64)


def exit_steps(times: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """What a run of sorted times does to the state, as a step function.

    Entered with "nothing before x", the last event to pass is ``last[j]`` for the first
    ``upto[j] >= x``; beyond the final ``upto`` nothing passes. Only entry states that earlier
    events can leave behind (at most ``gap`` after the first time here) are covered.
    """
    n = len(times)
    follow = np.searchsorted(times, times + gap, side="left")
    last = np.arange(n)
    while True:  # pointer doubling: each round covers twice as many hops
        live = np.flatnonzero(follow < n)
        if len(live) == 0:
            break
        hop = follow[live]
        last[live] = last[hop]
        follow = follow.copy()
        follow[live] = follow[hop]
    reach = min(n, int(np.searchsorted(times, times[0] + gap, side="left")) + 1)
    upto, final = times[:reach], times[last[:reach]]
    ends = np.append(np.flatnonzero(final[1:] != final[:-1]), reach - 1)
    return upto[ends], final[ends]


def compose(one: tuple, two: tuple, gap: int) -> tuple:
    """The step function (first time, upto, final) of a run of events followed directly by a later run.

    States above the reach of the first run enter the second unchanged; those it leaves behind enter at its last passing
    event plus the gap. Like the parts, the result covers entry states up to ``gap`` after its first time.
    """
    (first, upto, final), (_, upto2, final2) = one, two
    hop = np.searchsorted(upto2, final + gap, side="left")
    met = hop < len(upto2)
    through = np.where(met, final2[np.minimum(hop, len(upto2) - 1)], final)
    reach = upto[-1]
    beyond = upto2 > reach
    known = np.searchsorted(upto2[beyond], first + gap, side="left") + 1  # the step that holds the last entry state
    upto, final = np.concatenate([upto, upto2[beyond][:known]]), np.concatenate([through, final2[beyond][:known]])
    ends = np.append(np.flatnonzero(final[1:] != final[:-1]), len(upto) - 1)
    return first, upto[ends], final[ends]


def after(steps: tuple, state: int, gap: int) -> int:
    """The state that a run of events leaves behind: nothing passes before it."""
    _, upto, final = steps
    j = int(np.searchsorted(upto, state, side="left"))
    return int(final[j]) + gap if j < len(upto) else state


def _micros(table: pa.Table, time: str) -> np.ndarray:
    return table[time].cast(pa.timestamp("us", "UTC")).cast(pa.int64()).to_numpy()


def _steps_of(table: pa.Table) -> list[tuple]:
    """The step functions of a table's rows."""
    upto, final = table["_upto"].combine_chunks(), table["_final"].combine_chunks()
    ends = upto.offsets.to_numpy()
    values = upto.values.to_numpy(), final.values.to_numpy()
    shift = final.offsets[0].as_py() - ends[0]
    return [
        (first, values[0][low:high], values[1][low + shift:high + shift])
        for first, low, high in zip(table["_first"].to_numpy(), ends[:-1], ends[1:])
    ]


def _steps_table(heads: list[pa.Table], steps: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of their group's columns and step functions."""
    offsets = np.concatenate([[0], np.cumsum([len(upto) for _, upto, _ in steps])]).astype(np.int32)
    table = pa.concat_tables(heads).append_column("_first", pa.array([int(first) for first, _, _ in steps], pa.int64()))
    for name, at in (("_upto", 1), ("_final", 2)):
        table = table.append_column(name, pa.ListArray.from_arrays(offsets, np.concatenate([step[at] for step in steps])))
    yield from table.combine_chunks().to_batches()


def thinnable(df: DataFrame, seconds: int, time: str = "event_time") -> DataFrame:
    """The rows a cooldown of ``seconds`` can order."""
    if seconds < 0:
        raise ValueError("a cooldown cannot be negative")
    return df.where(F.col(time).isNotNull())


def thin(
    df: DataFrame,
    keys: list[str],
    seconds: int = 60,
    time: str = "event_time",
    ident: str = "trade_id",
    block_rows: int = 1_000_000,
) -> DataFrame:
    """The rows of ``df`` that pass the cooldown of their key, by event time.

    Detections are few but costly to compute and are read more than once here, so they are
    materialised first. A row without a time has no place in the order and never passes; with 0
    seconds all others do. Of several events at one instant only the first by id can pass.
    """
    df = thinnable(df, seconds, time)
    if seconds == 0:
        return df
    gap = seconds * 1_000_000
    instant = W.partitionBy(*keys, time).orderBy(F.asc_nulls_last(ident))
    df = materialise(df.withColumn("_rank", F.row_number().over(instant)).where("_rank = 1").drop("_rank"))
    schema = df.schema
    split = split_keys(df, keys, time, ident, block_rows)
    names = df.columns

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _NEVER
        for table, runs in slices(rebatched(batches, 1), groups):
            times, picked = _micros(table, time), []
            for start, end, begins in runs:
                if begins:
                    entry = table["_entry"][start].as_py() if "_entry" in table.column_names else None
                    state = _NEVER if entry is None else entry
                hits = passing(times[start:end], gap, state) + start
                if len(hits):
                    picked.append(hits)
                    state = int(times[hits[-1]]) + gap
            if picked:
                yield from table.select(names).take(np.concatenate(picked)).to_batches()

    groups = split.group_columns
    if not split.cell_columns:
        return in_order(df, groups, [time, ident]).mapInArrow(emit, schema)

    key_fields = [T.StructField(k, schema[k].dataType) for k in keys]
    cell_fields = [T.StructField(c, T.LongType()) for c in split.cell_columns]
    steps = T._parse_datatype_string(_STEPS).fields

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, []
        for table, runs in slices(rebatched(batches, 1), groups):
            times, heads, done = _micros(table, time), [], []
            for start, end, begins in runs:
                if begins:
                    if held:
                        heads.append(head)
                        done.append((held[0][0], *exit_steps(np.concatenate(held), gap)))
                    head, held = table.slice(start, 1).select(groups), []
                held.append(times[start:end])
            if done:
                yield from _steps_table(heads, done)
        if held:
            yield from _steps_table([head], [(held[0][0], *exit_steps(np.concatenate(held), gap))])

    cut = split.rows.where(F.col(split.cell_columns[0]) >= 0).select(*dict.fromkeys([*groups, time, ident]))
    reports = in_order(cut, groups, [time, ident]).mapInArrow(
        report, T.StructType([*key_fields, *cell_fields, *steps])
    )
    reports = materialise(reports)
    # Places of the cells of a key in time order; these rows are one small number each, the step functions stay apart.
    place = (F.row_number().over(W.partitionBy(*keys).orderBy("_first")) - 1).cast("long")
    placed = materialise(reports.select(*groups, "_first").withColumn("_at", place).drop("_first"))
    entries = _entry_states(join_null_safe(reports, placed, groups, "inner"), keys, key_fields, steps, gap)
    entries = join_null_safe(placed, entries, [*keys, "_at"], "inner", small=False).drop("_at")

    entered = join_null_safe(split.rows.drop("_tail"), entries, groups, "left", small=False)
    return in_order(entered, groups, [time, ident]).mapInArrow(emit, schema)


def _entry_states(
    reports: DataFrame, keys: list[str], key_fields: list[T.StructField], steps: list[T.StructField], gap: int
) -> DataFrame:
    """(keys, _at, _entry): the state each cell is entered with, by composing up a tree and handing states down it."""
    at = T.StructField("_at", T.LongType())

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, whole = None, None
        for table, runs in slices(rebatched(batches, 1), [*keys, "_up"]):
            parts, heads, done = _steps_of(table), [], []
            for start, end, begins in runs:
                if begins:
                    if head is not None:
                        heads.append(head)
                        done.append(whole)
                    head, whole = table.slice(start, 1).select([*keys, "_up"]).rename_columns([*keys, "_at"]), parts[start]
                for part in parts[start + begins:end]:
                    whole = compose(whole, part, gap)
            if done:
                yield from _steps_table(heads, done)
        if head is not None:
            yield from _steps_table([head], [whole])

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _NEVER
        for table, runs in slices(rebatched(batches, 1), [*keys, "_up"]):
            parts, entry = _steps_of(table), []
            for start, end, begins in runs:
                state = table["_entry"][start].as_py() if begins else state
                for part in parts[start:end]:
                    entry.append(state)
                    state = after(part, state, gap)
            yield from table.select([*keys, "_at"]).append_column("_entry", pa.array(entry, pa.int64())).to_batches()

    levels = [materialise(reports.select(*keys, "_at", *[f.name for f in steps]))]
    while levels[-1].agg(F.max("_at")).first()[0] > 0:
        up = levels[-1].withColumn("_up", F.call_function("div", F.col("_at"), F.lit(FAN_IN)))
        levels.append(materialise(in_order(up, [*keys, "_up"], ["_at"]).mapInArrow(composed, T.StructType([*key_fields, at, *steps]))))
    entries = levels[-1].select(*keys, "_at", F.lit(_NEVER).alias("_entry"))
    for below in reversed(levels[:-1]):
        up = below.withColumn("_up", F.call_function("div", F.col("_at"), F.lit(FAN_IN)))
        known = entries.withColumnRenamed("_at", "_up")
        joined = join_null_safe(up, known, [*keys, "_up"], "inner", small=False)
        entries = in_order(joined, [*keys, "_up"], ["_at"]).mapInArrow(
            handed, T.StructType([*key_fields, at, T.StructField("_entry", T.LongType())])
        )
    return entries
