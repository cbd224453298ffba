"""Consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

A key's hash is a place on a ring of ``RING`` places; it belongs to the next virtual node clockwise, and so to a shard.
Shards have capacities that sum to at least all rows. Keys that find their shard full go on clockwise to the next shard
with room. Only counts per arc (the stretch before a virtual node) decide how many keys of an arc go where: at most
shards x virtual nodes of them, whatever the number of rows, are seen by the driver. Within an arc keys are taken in
the order of their hash; their ranks come from cells, so neither a hot key nor a hot arc is one task's work.

Every shard is filled to at most its capacity, wave by wave: first all keys try their own shard, the rest of each arc
then its next shard with room, and so on; of several arcs that want the same room the nearer one, then the one with the
lower number, comes first. With ``slack`` 0 the capacities are n/shards rounded up or down, so counts differ by one at
most; more slack moves fewer keys.

Defined cases: a null key is a key like any other; equal rows are separate rows that get separate slots; a null text
has size 16 and CRC 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import expand_copies, staged

RING = 65_536
CELLS = 256
SHARDS = 40
VIRTUAL_NODES = 64


def ring(spark, shards: int, virtual_nodes: int) -> DataFrame:
    """(place, arc, home_shard) for every place of the ring; its size is fixed by RING."""
    nodes = spark.range(shards * virtual_nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.expr(f"cast(id div {shards} as int)").alias("replica")
    )
    nodes = nodes.withColumn("at", F.pmod(F.xxhash64(F.lit("node"), "shard", "replica"), F.lit(RING)))
    order = Window.partitionBy(F.lit(0)).orderBy("at", "shard", "replica")
    nodes = nodes.withColumn("arc", F.row_number().over(order) - 1)
    first = nodes.groupBy("at").agg(F.min(F.struct("arc", "shard")).alias("node"))
    places = spark.range(RING).join(first, F.col("id") == F.col("at"), "left")
    after = Window.partitionBy(F.lit(0)).orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    start = F.min("node").over(Window.partitionBy(F.lit(0)))
    node = F.coalesce(F.last("node", ignorenulls=True).over(after), start)
    return places.select(F.col("id").alias("place"), node.alias("node")).select("place", "node.arc", F.col("node.shard").alias("home_shard"))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def fill(arcs: Sequence[tuple[int, int]], room: list[int]) -> list[dict]:
    """Which ranks of which arc go to which shard: ``arcs`` has (shard, rows) clockwise, ``room`` the capacities."""
    n, left, used = len(arcs), list(room), [0] * len(room)
    waiting = {a: [0, 0, rows] for a, (_, rows) in enumerate(arcs) if rows}  # hops, next rank, rows
    runs = []
    while waiting:
        for a in sorted(waiting, key=lambda a: (waiting[a][0], a)):
            hops, rank, rows = waiting[a]
            shard = arcs[(a + hops) % n][0]
            take = min(rows, left[shard])
            if take:
                runs.append({"run_arc": a, "low": rank, "high": rank + take, "shard": shard, "first_slot": used[shard]})
                left[shard] -= take
                used[shard] += take
            waiting[a] = [hops, rank + take, rows - take]
        waiting = {a: w for a, w in waiting.items() if w[2]}
        for a, w in waiting.items():
            w[0] += 1
            while not left[arcs[(a + w[0]) % n][0]]:
                w[0] += 1
    return runs


def ring_shards(
    rows: DataFrame, key: str, carry: Sequence[str] = (), shards: int = SHARDS,
    virtual_nodes: int = VIRTUAL_NODES, slack: float = 0.0,
) -> DataFrame:
    """``key`` and the columns ``carry`` of every row, with home_shard, shard and a slot that is gapless in the shard."""
    spark = rows.sparkSession
    columns = list(dict.fromkeys([key, *carry]))
    names = [f"k{i}" for i in range(len(columns))]
    groups = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)])
    groups = groups.groupBy(*names).agg(F.count("*").alias("copies"))
    text = F.concat_ws(":", *[F.coalesce(F.col(n).cast("string"), F.lit("-")) for n in names])
    groups = groups.withColumn("hash", F.xxhash64(F.lit("key"), F.coalesce(F.col("k0").cast("string"), F.lit("-"))))
    groups = groups.withColumn("at", F.pmod("hash", F.lit(RING)))
    groups = groups.withColumn("cell", F.pmod(F.xxhash64(text), F.lit(CELLS)).cast("int"))
    places = ring(spark, shards, virtual_nodes)
    groups = staged(groups.join(F.broadcast(places), F.col("at") == F.col("place")).drop("at", "place"), "groups")
    cells = staged(groups.groupBy("arc", "home_shard", "cell").agg(F.sum("copies").alias("rows")), "cells")
    counts = {r.arc: r.rows for r in cells.groupBy("arc").agg(F.sum("rows").alias("rows")).collect()}
    owners = {r.arc: r.home_shard for r in places.select("arc", "home_shard").distinct().collect()}
    arcs = [(owners[a], counts.get(a, 0)) for a in sorted(owners)]
    numbered = [a for a in sorted(owners)]
    runs = fill(arcs, capacities(sum(counts.values()), shards, slack))
    for run in runs:
        run["run_arc"] = numbered[run["run_arc"]]
    kind = "array<struct<run_arc: int, low: bigint, high: bigint, shard: int, first_slot: bigint>>"
    runs = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(runs)), kind)))

    earlier = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("arc").alias("cell_arc"), F.col("cell").alias("cell_name"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("cell_start"),
    )
    inside = Window.partitionBy("arc", "cell").orderBy("hash", *names).rowsBetween(Window.unboundedPreceding, -1)
    ranked = groups.withColumn("in_cell", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    ranked = ranked.join(cells, (F.col("arc") == F.col("cell_arc")) & (F.col("cell") == F.col("cell_name")))
    ranked = ranked.withColumn("rank", F.col("cell_start") + F.col("in_cell"))
    end = F.col("rank") + F.col("copies")
    parts = ranked.join(
        F.broadcast(runs), (F.col("arc") == F.col("run_arc")) & (F.col("low") < end) & (F.col("high") > F.col("rank"))
    )
    parts = parts.withColumn("from", F.greatest("rank", "low")).withColumn("part", F.least(end, F.col("high")) - F.col("from"))
    out = expand_copies(parts, "part", "copy", [*names, "shard"])
    slot = F.col("first_slot") + F.col("from") + F.col("copy") - F.col("low")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns)], "home_shard", "shard", slot.alias("slot"))


def document_shards(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Every document's shard: doc_id, size (UTF-8 bytes + 16), text_crc32, law, shard, slot, grown_shard, home_shard."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = ring_shards(rows, "doc_id", ["size", "text_crc32"], shards, virtual_nodes)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard",
    )
