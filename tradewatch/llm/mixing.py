"""Mixing sources to target weights by a time-varying curriculum (DataFrame functions only).

Each source has a piecewise-linear weight schedule over training time 0..1. The integral of its schedule is its weight;
weights share the words of the whole corpus, no source beyond ``max_repeats`` times its own size. A source's documents,
in a hashed order, form a line of words which is laid along the source's cumulative demand, epoch after epoch: the
position of a document is the time at which demand reaches its first word, found by inverting the schedule's integral.
Sorting by position gives the training order.

Defined cases: a null text has no words; a null source is a source of its own, last in order; documents without words
are never placed (taken 0, no position); equal rows are separate documents that share one place in the order one after
the other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import expand_copies, staged, word_count

Schedule = Sequence[tuple[float, float]]

#: Sources by code point take these in turn. The integrals are 5, 2 and 1; the first leads early, the last late.
CURRICULUM: tuple[Schedule, ...] = (
    ((0.0, 7.0), (0.5, 5.0), (1.0, 3.0)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)
MAX_REPEATS = 3
#: Hex digits of the hashed order that cut a source into cells, so that no source is one task's work.
CELL_DIGITS = 3


def weight_of(schedule: Schedule) -> float:
    """Integral of a schedule."""
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))


def time_of(share: Column, schedule: Schedule) -> Column:
    """The time at which ``share`` (0..1) of a schedule's integral is reached."""
    area = share * F.lit(weight_of(schedule))
    out, done = None, 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        slope = (w1 - w0) / (t1 - t0)
        rest = area - F.lit(done)
        here = F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        done += (t1 - t0) * (w0 + w1) / 2
        out = F.when(area <= F.lit(done), here) if out is None else out.when(area <= F.lit(done), here)
    return out.otherwise(F.lit(schedule[-1][0]))


def source_targets(
    sizes: DataFrame, curriculum: Sequence[Schedule] = CURRICULUM, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """(source, source_size, schedule, target) from (source, size) rows.

    Sources sorted by size per weight reach their limit in that order, so the level at which the rest share what is
    left follows from running sums. One row per source stands in the one window without a key.
    """
    weights = F.array(*[F.lit(weight_of(s)) for s in curriculum])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("schedule", (F.row_number().over(by_name) - 1) % len(curriculum))
    sources = sources.withColumn("weight", F.element_at(weights, F.col("schedule") + 1))
    sources = sources.withColumn("limit", F.col("source_size") * max_repeats)
    filling = everything.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.select(
        "*",
        F.row_number().over(filling).alias("turn"),
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("sharing"),
    )
    open_turn = F.when(F.col("left") * F.col("weight") <= F.col("limit") * F.col("sharing"), F.col("turn"))
    first = F.min(open_turn).over(everything)
    sources = sources.withColumn("first", first)
    level = lambda c: F.max(F.when(F.col("turn") == F.col("first"), F.col(c))).over(everything)
    shared = level("left") * F.col("weight") / level("sharing")
    target = F.when(F.col("turn") < F.col("first"), F.col("limit").cast("double")).otherwise(shared)
    return sources.select("source", "source_size", "schedule", target.alias("target"))


def placed(
    groups: DataFrame, keys: list[str], curriculum: Sequence[Schedule] = CURRICULUM, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per copy of each group of equal documents: its source's size and target, ``taken`` words, the number of
    ``visits`` and its ``start`` in the source's line of words.

    ``groups`` has the columns ``keys``, source, size, copies and a hex string ``place`` that is unique in a source.
    """
    targets = source_targets(groups.select("source", (F.col("size") * F.col("copies")).alias("size")), curriculum, max_repeats)
    cell = F.substring("place", 1, CELL_DIGITS)
    groups = groups.withColumn("cell", cell).withColumn("words", F.col("size") * F.col("copies"))
    cells = groups.groupBy("source", "cell").agg(F.sum("words").alias("cell_words"))
    earlier = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("source", "cell", F.coalesce(F.sum("cell_words").over(earlier), F.lit(0)).alias("cell_start"))
    cells = cells.withColumnsRenamed({"source": "cell_source", "cell": "cell_name"})
    targets = targets.withColumnRenamed("source", "target_source")
    inside = Window.partitionBy("source", "cell").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    lines = groups.withColumn("in_cell", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    lines = lines.join(cells, F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("cell") == F.col("cell_name")))
    lines = lines.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
    lines = lines.select(
        *keys, "source", "size", "source_size", "schedule", "target", "copies",
        (F.col("cell_start") + F.col("in_cell")).alias("first_start"),
    )
    rows = expand_copies(lines, "copies", "copy", keys)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div nullif(source_size, 0)")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    rows = rows.withColumn("start", F.col("first_start") + F.col("copy") * F.col("size"))
    part = F.least(F.greatest(rest - F.col("start"), F.lit(0)), F.col("size"))
    visits = F.when(F.col("size") > 0, epochs + F.when(part > 0, 1).otherwise(0)).otherwise(F.lit(0))
    return rows.select(
        *keys, "source", "size", "source_size", "schedule", "target", "start",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
        visits.cast("long").alias("visits"), part.cast("long").alias("last_words"),
    )


def position(visit: Column, curriculum: Sequence[Schedule] = CURRICULUM) -> Column:
    """Training time of a visit (from 0) of a placed document."""
    share = (visit * F.col("source_size") + F.col("start")).cast("double") / F.floor("target").cast("double")
    out = F.lit(None).cast("double")
    for k, schedule in enumerate(curriculum):
        out = F.when(F.col("schedule") == k, time_of(share, schedule)).otherwise(out)
    return out


def mixture(docs: DataFrame, curriculum: Sequence[Schedule] = CURRICULUM, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken, visits, position of its first visit; in training
    order over range partitions, documents that are not taken first."""
    place = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size")))
    groups = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    groups = groups.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    groups = staged(groups.withColumn("place", place), "groups")
    first = F.when(F.col("visits") > 0, position(F.lit(0), curriculum))
    rows = placed(groups, ["doc_id"], curriculum, max_repeats)
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "taken", "visits", first.alias("position"))
    rows = staged(rows, "placed")
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def training_stream(
    docs: DataFrame, curriculum: Sequence[Schedule] = CURRICULUM, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """The mixed corpus itself: a row with the columns of ``docs`` for every visit of a document, in training order. A
    source's last document is cut after the word at which its target is met. ``n_chars``, if there, is kept true.

    Texts move twice: to their group of equal rows, and to their place in the order.
    """
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    rows = rows.withColumn("place", F.md5(F.to_json("row")))
    groups = rows.select("place", "row.source", word_count(F.col("row.text")).alias("size"))
    groups = groups.groupBy("place").agg(F.first("source").alias("source"), F.first("size").alias("size"), F.count("*").alias("copies"))
    visits = placed(staged(groups, "groups"), ["place"], curriculum, max_repeats).where("visits > 0")
    visits = visits.withColumn("visit", F.explode(F.expr("sequence(0L, visits - 1)")))
    cut_short = (F.col("visit") == F.col("visits") - 1) & F.col("last_words").between(1, F.col("size") - 1)
    visits = staged(visits.select(
        F.col("place").alias("visit_of"), position(F.col("visit"), curriculum).alias("position"),
        F.when(cut_short, F.col("last_words")).cast("int").alias("words"),
    ), "visits")
    rows = rows.groupBy("place").agg(F.first("row").alias("row"))
    rows = rows.join(visits, F.col("place") == F.col("visit_of"))
    rows = rows.repartitionByRange("position", "place").sortWithinPartitions("position", "place")
    text = F.col("row.text")
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    out = {c: F.col(f"row.`{c}`") for c in columns}
    out["text"] = F.when(F.col("words").isNull(), text).otherwise(F.array_join(F.slice(pieces, 1, F.col("words")), ""))
    if "n_chars" in out:
        length = F.length(out["text"]).cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col("words").isNull(), F.col("row.n_chars")).otherwise(length)
    return rows.select(*[e.alias(c) for c, e in out.items()])
