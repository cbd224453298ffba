"""Split ordered per-key data into bounded blocks, so that no key has to fit one task.

Row-frame features and ordered folds are defined per symbol, and one symbol may hold a large
share of all trades. ``split_keys`` cuts every key with more than ``block_rows`` rows into cells
that are contiguous in (time, id) and hold at most ``block_rows`` rows. Cells start as equal time
slices; a cell that is still too large is cut again, by id once it covers a single instant; one that can't be cut is an
error. Only
small tables of cell statistics are materialised; a row finds its cell by arithmetic.

``with_halo`` then gives every cell a copy of the last rows before it, so that a row frame can be
evaluated inside the cell alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.session import broadcast_if_small, materialise

_SLICES = 64
_MAX_DEPTH = 12


@dataclass(frozen=True)
class SplitFrame:
    """Rows tagged with their cell. ``cell_columns`` is empty when no key needed splitting."""

    rows: DataFrame
    keys: list[str]
    cell_columns: list[str]
    cells: DataFrame | None

    @property
    def group_columns(self) -> list[str]:
        return self.keys + self.cell_columns


def join_null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str, small: bool = True) -> DataFrame:
    """Join on equal or equally null columns; a missing symbol can be as frequent as any other.

    ``small`` marks a materialised right side, which is broadcast if its counted size allows.
    """
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_right_{name}")) for name in names])
    return left.join(broadcast_if_small(renamed) if small else renamed, same, how).drop(
        *[f"_right_{name}" for name in names]
    )


def _bounds(time: Column, ident: Column) -> list[Column]:
    micros = F.unix_micros(time)
    return [
        F.count(F.lit(1)).alias("n"),
        F.min(micros).alias("t_lo"), F.max(micros).alias("t_hi"),
        F.min(ident).alias("i_lo"), F.max(ident).alias("i_hi"),
    ]


def _merge_bounds() -> list[Column]:
    return [
        F.sum("n").alias("n"),
        F.min("t_lo").alias("t_lo"), F.max("t_hi").alias("t_hi"),
        F.min("i_lo").alias("i_lo"), F.max("i_hi").alias("i_hi"),
    ]


def _too_large(block_rows: int) -> Column:
    divisible = (F.col("t_lo") < F.col("t_hi")) | (F.col("i_lo") < F.col("i_hi"))
    return (F.col("n") > block_rows) & divisible


def split_keys(
    df: DataFrame,
    keys: list[str],
    time: str = "event_time",
    ident: str = "trade_id",
    block_rows: int = 1_000_000,
) -> SplitFrame:
    """Tag rows of large keys with a cell; rows of small keys keep the key as their only cell."""
    time_col, id_col = F.col(time), F.coalesce(F.col(ident), F.lit(0).cast("bigint"))
    stats = df.groupBy(*keys).agg(*_bounds(time_col, id_col))
    heavy = materialise(stats.where(_too_large(block_rows)))
    if heavy.isEmpty():
        return SplitFrame(df, keys, [], None)

    rows, path, leaves = df, [], []
    for depth in range(_MAX_DEPTH):
        by_time = F.col("t_lo") < F.col("t_hi")
        low = F.when(by_time, F.col("t_lo")).otherwise(F.col("i_lo"))
        high = F.when(by_time, F.col("t_hi")).otherwise(F.col("i_hi"))
        # Half-full cells on average; a single skewed key cannot ask for an unbounded number.
        parts = F.ceil(F.col("n") * F.lit(2.0) / F.lit(float(block_rows)))
        spec = heavy.select(
            *keys, *path, by_time.alias("_by_time"), low.alias("_low"),
            F.greatest(F.lit(1), F.ceil((high - low + 1) / parts)).cast("bigint").alias("_step"),
        )
        cell = f"_cell{depth}"
        rows = join_null_safe(rows, spec, keys + path, "left")
        offset = F.when(F.col("_by_time"), F.unix_micros(time_col)).otherwise(id_col) - F.col("_low")
        inside = F.col("_step").isNotNull()
        slice_width = F.greatest(F.lit(1), F.call_function("div", F.col("_step"), F.lit(_SLICES)))
        rows = rows.withColumns({
            "_offset": F.when(inside, offset),
            cell: F.when(inside, F.call_function("div", offset, F.col("_step"))).otherwise(F.lit(-1).cast("bigint")),
            "_slice": F.when(
                inside, F.call_function("div", F.pmod(offset, F.col("_step")), slice_width)
            ),
        })
        # The deepest level a row reaches decides its slice inside the final cell.
        if depth == 0:
            rows = rows.withColumn("_tail", F.col("_slice"))
        else:
            rows = rows.withColumn("_tail", F.coalesce("_slice", "_tail"))
        rows = rows.drop("_by_time", "_low", "_step", "_offset", "_slice")
        path = path + [cell]
        slices = materialise(
            rows.where(F.col(cell) >= 0).groupBy(*keys, *path, "_tail").agg(*_bounds(time_col, id_col))
        )
        cells = materialise(slices.groupBy(*keys, *path).agg(
            *_merge_bounds(), F.collect_list(F.struct("_tail", "n")).alias("tails")
        ))
        heavy = cells.where(_too_large(block_rows))
        leaves.append((path, cells.where(~_too_large(block_rows))))
        if heavy.isEmpty():
            break
    stuck = leaves[0][1].where(F.col("n") > block_rows)
    for _, part in leaves[1:]:
        stuck = stuck.unionByName(part.where(F.col("n") > block_rows), allowMissingColumns=True)
    stuck = heavy.unionByName(stuck, allowMissingColumns=True).select(*keys, "n").head()
    if stuck is not None:
        raise ValueError(
            f"{stuck['n']} rows of {[stuck[k] for k in keys]} cannot be cut into blocks of {block_rows}: too many share one "
            "time and id; give the rows ids, or larger blocks"
        )
    padded = [
        part.select(
            *keys, *[F.col(c) if c in have else F.lit(-1).cast("bigint").alias(c) for c in path],
            "n", "t_lo", "i_lo", "tails",
        )
        for have, part in leaves
    ]
    table = padded[0]
    for part in padded[1:]:
        table = table.unionByName(part)
    return SplitFrame(rows, keys, path, table)


def with_halo(split: SplitFrame, halo_rows: int) -> DataFrame:
    """Rows plus, for every cell, at least the ``halo_rows`` rows before it (marked ``_halo``).

    A halo row keeps its values but carries the cell it is copied into. Copies are whole tail slices
    of the preceding cells, about 1/64 of a cell each, found from the cell counts alone.
    """
    if not split.cell_columns:
        return split.rows.withColumn("_halo", F.lit(False))
    keys, path = split.keys, split.cell_columns
    ordered = W.partitionBy(*keys).orderBy("t_lo", "i_lo")
    cells = materialise(split.cells.select(
        *keys, *path, "tails", "n",
        (F.sum("n").over(ordered.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("start"),
    ))

    # The rows a cell can lend are the last `halo_rows` before its end, the rows a cell needs are the
    # `halo_rows` before its start: intervals of equal length, matched on buckets of that length.
    def bucketed(df: DataFrame, low: Column, high: Column) -> DataFrame:
        first, last = F.floor(low / halo_rows), F.floor((high - 1) / halo_rows)
        return df.withColumn("_first", first).withColumn("_bucket", F.explode(F.sequence(first, last)))

    end = F.col("start") + F.col("n")
    target = F.struct(*path)
    lends = bucketed(
        cells.withColumn("end", end).withColumn("from", F.greatest(F.col("start"), end - halo_rows)),
        F.col("from"), F.col("end"),
    ).select(*keys, *path, "tails", "n", "end", "from", "_bucket", F.col("_first").alias("_lend_first"))
    needs = bucketed(
        cells.where("start > 0").withColumn("want", F.greatest(F.lit(0), F.col("start") - halo_rows)),
        F.col("want"), F.col("start"),
    ).select(
        *keys, target.alias("_target"), F.col("start").alias("to"), "want", "_bucket",
        F.col("_first").alias("_need_first"),
    )
    pairs = join_null_safe(lends, needs, keys + ["_bucket"], "inner", small=False).where(
        (F.col("end") <= F.col("to")) & (F.col("end") > F.col("want"))
        & (F.col("_bucket") == F.greatest("_lend_first", "_need_first"))
    )
    # Tail slices, latest first, until they hold what the target needs from this cell.
    needed = F.least(F.col("n"), F.col("end") - F.col("want"))
    latest_first = F.reverse(F.array_sort("tails"))
    cut = F.aggregate(
        latest_first,
        F.struct(F.lit(0).cast("bigint").alias("got"), F.lit(None).cast("bigint").alias("cut")),
        lambda acc, s: F.when(acc["got"] >= needed, acc).otherwise(
            F.struct((acc["got"] + s["n"]).alias("got"), s["_tail"].alias("cut"))
        ),
    )["cut"]
    lending = materialise(
        pairs.select(*keys, *path, F.struct("_target", cut.alias("cut")).alias("_pair"))
        .groupBy(*keys, *path).agg(F.collect_list("_pair").alias("_pairs"))
    )
    copies = F.transform(
        F.filter(F.coalesce("_pairs", F.array()), lambda p: F.col("_tail") >= p["cut"]),
        lambda p: F.struct(p["_target"].alias("_target"), F.lit(True).alias("_halo")),
    )
    own = F.array(F.struct(target.alias("_target"), F.lit(False).alias("_halo")))
    tagged = join_null_safe(split.rows, lending, keys + path, "left")
    placed = tagged.withColumn("_place", F.explode(F.concat(own, copies)))
    plain = [c for c in split.rows.columns if c not in path and c != "_tail"]
    return placed.select(
        *plain, *[F.col(f"_place._target.{c}").alias(c) for c in path], F.col("_place._halo").alias("_halo")
    )
