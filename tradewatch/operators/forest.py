"""Isolation forests trained and applied as Spark jobs (Liu, Ting and Zhou, ICDM 2008).

A forest is a table of tree nodes. Training data is at most ``max_rows`` rows per symbol, so one group
holds little; trees are grown in many small tasks. Every random choice is derived from (seed,
symbol, tree, trade_id), so retries and other partitionings give the same forest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.config import ForestConfig
from tradewatch.functions.symbols import normalize_symbol
from tradewatch.functions.timestamps import with_event_time
from tradewatch.operators.asof import as_of_join
from tradewatch.operators.rolling import newest_per_key
from tradewatch.schemas import FOREST_DDL
from tradewatch.session import materialise

DEFAULT_KEY = "_default_"
_SCORE_DDL = "is_if_anomaly boolean, if_anomaly_score double"
_EULER = 0.5772156649015329
GROUP_NODES = 2_000_000  # about 75 MB of arrays
GROUP_ROWS = 200_000


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2.0 * (np.log(safe - 1.0) + _EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _scrambled(ids: np.ndarray, salt: int) -> np.ndarray:
    """A repeatable pseudo-random order key per row id."""
    x = ids.astype(np.uint64) ^ np.uint64(salt & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _uniform(salts: np.ndarray, nodes: np.ndarray, draw: int) -> np.ndarray:
    """A number in [0, 1) for each (tree, node), whatever else is grown beside it."""
    mixed = (salts + nodes * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(draw * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    return (_scrambled(mixed, 0) >> np.uint64(11)) * 2.0**-53


def _begins(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)[:-1]])


def grow_levels(
    points: np.ndarray, rows: np.ndarray, weights: np.ndarray, starts: np.ndarray, usable: np.ndarray, salts: np.ndarray,
    nodes: list | None = None, paths: np.ndarray | None = None,
) -> None:
    """Grow several trees at once, level by level; the rows of a tree, and later of a node, lie side by side.

    Tree t takes ``rows[starts[t]:starts[t + 1]]``, places in ``points``. A row of weight n stands n times in the tree's
    sample; one of weight 0 is no part of it and only runs down the tree. ``nodes`` receives arrays (tree, node, feature,
    split, left, right, size, depth) per level, leaves with feature -1; ``paths`` the path length of every entry of ``rows``.
    """
    flat, width = np.ascontiguousarray(points).ravel(), points.shape[1]
    tree, lengths = np.arange(len(starts) - 1), np.diff(starts)
    limits = np.maximum(1, np.ceil(np.log2(np.maximum(np.add.reduceat(weights, starts[:-1]), 2)))).astype(np.int64)
    heap, number, count = np.ones(len(tree), np.uint64), np.zeros(len(tree), np.int64), np.ones(len(tree), np.int64)
    place, depth, whole = np.arange(len(rows)), 0, bool((weights > 0).all())

    def extent(values: np.ndarray, sampled: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest value of each node's sample."""
        begin = _begins(lengths)
        if not whole:
            values, begin = np.compress(sampled, values), _begins(np.add.reduceat(sampled, begin, dtype=np.int64))
        return np.minimum.reduceat(values, begin), np.maximum.reduceat(values, begin)

    while True:
        size = np.add.reduceat(weights, _begins(lengths))
        parts = (depth < limits[tree]) & (size >= 2)
        feature, split = np.full(len(tree), -1), np.zeros(len(tree))
        inner = np.flatnonzero(parts)
        if len(inner):
            live = slice(None) if parts.all() else np.flatnonzero(np.repeat(parts, lengths))
            below, own, long = rows[live], weights[live] > 0, lengths[inner]
            mine, salt, node = usable[tree[inner]], salts[tree[inner]], heap[inner]
            pick = (_uniform(salt, node, 1) * mine.sum(axis=1)).astype(np.int64)
            chosen = np.argmax(np.cumsum(mine, axis=1) > pick[:, None], axis=1)
            values = flat.take(below * width + np.repeat(chosen, long))
            low, high = extent(values, own, long)
            # Where that feature is constant, the others follow in a random order.
            stuck, tries = np.flatnonzero(low >= high), 1
            if len(stuck):
                keys = np.stack([_uniform(salt[stuck], node[stuck], 8 + j) for j in range(width)], axis=1)
                keys[np.arange(len(stuck)), chosen[stuck]] = 2.0
                order, left_over = np.argsort(np.where(mine[stuck], keys, 3.0), axis=1), mine[stuck].sum(axis=1) - 1
            while len(stuck):
                on = left_over >= tries
                stuck, order, left_over = stuck[on], order[on], left_over[on]
                if len(stuck) == 0:
                    break
                chosen[stuck] = order[:, tries - 1]
                again = np.zeros(len(inner), bool)
                again[stuck] = True
                at = np.flatnonzero(np.repeat(again, long))
                values[at] = flat.take(below[at] * width + np.repeat(chosen[stuck], long[stuck]))
                low[stuck], high[stuck] = extent(values[at], own[at], long[stuck])
                on = low[stuck] >= high[stuck]
                stuck, order, left_over, tries = stuck[on], order[on], left_over[on], tries + 1
            cut = low + _uniform(salt, node, 2) * (high - low)
            cut = np.where(cut >= high, low, cut)  # rounded up: would leave one side empty
            found = low < high
            parts[inner] = found
            feature[inner[found]], split[inner[found]] = chosen[found], cut[found]
        if nodes is not None:
            before = np.concatenate([[0], np.cumsum(parts)])
            left = count[tree] + 2 * (before[:-1] - before[np.searchsorted(tree, tree, side="left")])
            nodes.append((
                tree, number, feature, split, np.where(parts, left, -1), np.where(parts, left + 1, -1), size, np.full(len(tree), depth),
            ))
            np.add.at(count, tree, 2 * parts)
        if paths is not None and not parts.all():
            ended = np.flatnonzero(np.repeat(~parts, lengths))
            paths[place.take(ended)] = np.repeat((depth + expected_path(size))[~parts], lengths[~parts])
        if not parts.any():
            return
        if not found.all():
            values, cut, long = np.compress(np.repeat(found, long), values), cut[found], long[found]
        if not parts.all():
            live = np.flatnonzero(np.repeat(parts, lengths))
            rows, weights = rows.take(live), weights.take(live)
            place = place.take(live) if paths is not None else place
        goes_left = values <= np.repeat(cut, long)
        child = np.arange(2 * len(long), dtype=np.uint16 if 2 * len(long) < 1 << 16 else np.uint64)
        turn = np.argsort(np.repeat(child[::2], long) + ~goes_left, kind="stable")  # short keys sort by radix
        lefts = np.add.reduceat(goes_left, _begins(long), dtype=np.int64)
        rows, weights = rows.take(turn), weights.take(turn)
        place = place.take(turn) if paths is not None else place
        if nodes is not None:
            number = np.stack([left[parts], left[parts] + 1], axis=1).ravel()
        lengths = np.stack([lefts, long - lefts], axis=1).ravel()
        heap = np.stack([2 * heap[parts], 2 * heap[parts] + np.uint64(1)], axis=1).ravel()
        tree, depth = np.repeat(tree[parts], 2), depth + 1


def tree_salt(name: str, tree: int, seed: int) -> int:
    return zlib.crc32(f"{seed}|{name}|{tree}".encode()) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF


def tree_sample(ids: np.ndarray, samples: int, salt: int, replace: bool) -> np.ndarray:
    """How often each row stands in a tree's sample."""
    if replace:
        drawn = (_uniform(np.full(samples, salt, np.uint64), np.arange(samples, dtype=np.uint64), 3) * len(ids)).astype(np.int64)
        return np.bincount(drawn, minlength=len(ids))
    weights = np.zeros(len(ids), np.int64)
    weights[np.argsort(_scrambled(ids, salt), kind="stable")[:samples]] = 1
    return weights


def tree_features(width: int, share: float, salt: int) -> np.ndarray:
    """Which features a tree may split on."""
    order = np.argsort(_uniform(np.full(width, salt, np.uint64), np.arange(width, dtype=np.uint64), 4), kind="stable")
    return np.isin(np.arange(width), order[: max(1, int(share * width))])


def grow_forest(
    points: np.ndarray, ids: np.ndarray, name: str, trees: range, samples: int, seed: int,
    feature_share: float = 1.0, replace: bool = False,
) -> dict[str, np.ndarray]:
    """Node columns of several trees of one forest."""
    salts = [tree_salt(name, tree, seed) for tree in trees]
    weights = [tree_sample(ids, samples, salt, replace) for salt in salts]
    rows = [np.flatnonzero(w) for w in weights]
    levels: list = []
    grow_levels(
        points, np.concatenate(rows), np.concatenate([w[r] for w, r in zip(weights, rows)]),
        np.concatenate([[0], np.cumsum([len(r) for r in rows])]),
        np.stack([tree_features(points.shape[1], feature_share, salt) for salt in salts]), np.array(salts, np.uint64), nodes=levels,
    )
    out = {c: np.concatenate(parts) for c, parts in zip(_NODE_COLUMNS, zip(*levels))}
    out["tree"] = out["tree"] + trees.start
    return out


def path_totals(
    points: np.ndarray, ids: np.ndarray, name: str, trees: range, samples: int, seed: int, feature_share: float, replace: bool,
) -> np.ndarray:
    """Sum of every row's path lengths over trees grown from samples of these rows, without keeping the trees."""
    rows, totals, ends = np.arange(len(points)), np.zeros(len(points)), np.array([0, len(points)])
    for tree in trees:
        salt, paths = tree_salt(name, tree, seed), np.empty(len(points))
        usable = tree_features(points.shape[1], feature_share, salt)[None]
        grow_levels(
            points, rows, tree_sample(ids, samples, salt, replace), ends, usable, np.array([salt], np.uint64), paths=paths
        )
        totals += paths
    return totals


_NODE_COLUMNS = ("tree", "node", "feature", "split", "left", "right", "size", "depth")


class Forest:
    """One symbol's trees as flat arrays, with the path length that ends in each leaf."""

    def __init__(self, columns: dict[str, np.ndarray], psi: int, cut: float | None):
        order = np.lexsort((columns["node"], columns["tree"]))
        tree, node = columns["tree"][order], columns["node"][order]
        starts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
        base = np.repeat(starts, np.diff(np.r_[starts, len(tree)]))
        self.roots = starts
        self.feature = columns["feature"][order]
        self.split = columns["split"][order]
        self.left = columns["left"][order] + base
        self.right = columns["right"][order] + base
        depth = columns["depth"][order]
        self.length = depth + expected_path(columns["size"][order])
        self.depth = int(depth.max(initial=0))
        self.norm = float(max(expected_path(np.array([psi]))[0], 1e-9))
        self.cut = cut

    @classmethod
    def restored(cls, state: dict) -> Forest:
        forest = cls.__new__(cls)
        forest.__dict__.update(state)
        return forest

    def scores(self, points: np.ndarray, rows_at_once: int = 4096) -> np.ndarray:
        """Anomaly score of each point; near 1 is anomalous, well below 0.5 is normal."""
        return 2.0 ** (-self.totals(points, rows_at_once) / len(self.roots) / self.norm)

    def totals(self, points: np.ndarray, rows_at_once: int = 4096) -> np.ndarray:
        """Sum of the path lengths of each point over all trees."""
        out = np.empty(len(points))
        for start in range(0, len(points), rows_at_once):
            part = points[start:start + rows_at_once]
            at = np.tile(self.roots, (len(part), 1))
            which = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                feature = self.feature[at]
                inner = feature >= 0
                left = part[which, np.where(inner, feature, 0)] <= self.split[at]
                at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)
            out[start:start + rows_at_once] = self.length[at].sum(axis=1)
        return out


def _forest(nodes: pa.Table, psi: int, cut: float | None) -> Forest:
    return Forest({c: nodes[c].to_numpy() for c in _NODE_COLUMNS}, psi, cut)


def _points(df_columns: list[np.ndarray]) -> np.ndarray:
    return np.nan_to_num(np.column_stack(df_columns).astype(float), nan=0.0)


def _features(config: ForestConfig) -> list[Column]:
    return [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in config.features]


def training_trades(trades: DataFrame, window: int, config: ForestConfig = ForestConfig()) -> DataFrame:
    """The trades that the training rows and their frames of ``window`` trades consist of.

    Features of these give the same training rows as features of the whole history: the newest ``max_rows`` trades of a
    symbol have full frames here. The rank limit runs before any feature is computed.
    """
    timed = with_event_time(trades).where(F.col("event_time").isNotNull())
    return newest_per_key(timed, ["symbol"], config.max_rows + window - 1)


def training_rows(features: DataFrame, config: ForestConfig = ForestConfig()) -> DataFrame:
    """Newest rows per symbol, for symbols that have enough of them; ``_rows`` is the symbol's count."""
    slim = features.select("symbol", "trade_id", "event_time", *_features(config))
    newest = newest_per_key(slim, ["symbol"], config.max_rows)
    counted = newest.withColumn("_rows", F.count(F.lit(1)).over(W.partitionBy("symbol")))
    return counted.where(F.col("_rows") >= config.min_rows)


def train(features: DataFrame, config: ForestConfig = ForestConfig()) -> tuple[DataFrame, DataFrame]:
    """Fit one forest per symbol; returns the node table and the metadata table."""
    rows = materialise(training_rows(features, config))
    batches = -(-config.n_trees // config.trees_per_task)
    spread = rows.withColumn("_batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    names = list(config.features)

    def grow(group: pa.Table) -> pa.Table:
        group = group.sort_by("trade_id")
        symbol, batch = group["symbol"][0].as_py(), group["_batch"][0].as_py()
        first = batch * config.trees_per_task
        trees = range(first, min(first + config.trees_per_task, config.n_trees))
        columns = grow_forest(
            _points([group[c].to_numpy() for c in names]), group["trade_id"].to_numpy(), symbol, trees,
            min(config.max_samples, group.num_rows), config.seed,
        )
        return pa.Table.from_batches([node_batch(symbol, columns)])

    forest = materialise(spread.groupBy("symbol", "_batch").applyInArrow(grow, FOREST_DDL))
    sizes = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("trained_rows"))
    meta = sizes.select(
        "symbol", F.lit(config.n_trees).alias("n_trees"),
        F.least(F.col("trained_rows"), F.lit(config.max_samples)).cast("int").alias("psi"),
        F.lit(config.contamination).alias("contamination"), "trained_rows",
    )
    uncut = meta.withColumn("score_cut", F.lit(None).cast("double"))
    cuts = score(rows, forest, uncut, config).groupBy("symbol").agg(
        F.percentile("if_anomaly_score", F.lit(1.0 - config.contamination)).alias("score_cut")
    )
    return forest, materialise(meta.join(cuts, "symbol").select(
        "symbol", "n_trees", "psi", "contamination", "score_cut", "trained_rows"
    ))


def node_batch(symbol: str, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Node columns of one symbol as rows of a node table."""
    types = {"split": pa.float64(), "size": pa.int64()}
    arrays = [pa.array(columns[c]).cast(types.get(c, pa.int32())) for c in _NODE_COLUMNS]
    return pa.RecordBatch.from_arrays([pa.array([symbol] * len(arrays[0])), *arrays], ["symbol", *_NODE_COLUMNS])


def resolve_models(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``model_key``: the normalised symbol, its form without slash, the default model, or null."""
    own = keys.select(F.col("symbol").alias("_own"))
    bare = keys.select(F.col("symbol").alias("_bare"))
    default = keys.select(F.max(F.when(F.col("symbol") == DEFAULT_KEY, F.col("symbol")))).scalar()
    name = normalize_symbol(F.col("symbol"))
    return (
        df.withColumn("_name", name)
        .join(own, F.col("_name") == F.col("_own"), "left")
        .join(bare, F.replace("_name", F.lit("/"), F.lit("")) == F.col("_bare"), "left")
        .withColumn("model_key", F.coalesce("_own", "_bare", default))
        .drop("_name", "_own", "_bare")
    )


def score(
    df: DataFrame, forest: DataFrame, meta: DataFrame, config: ForestConfig = ForestConfig(), group_nodes: int = GROUP_NODES,
) -> DataFrame:
    """Add ``is_if_anomaly`` and ``if_anomaly_score``; rows without a model get false and zero.

    Models travel in groups of symbols, each a broadcast of about ``group_nodes`` nodes; a task fetches the groups that
    its rows name. Rows stay where they are, on streams too, and a model set of any size takes the same way.
    """
    groups, place = _model_groups(forest, meta, group_nodes)

    @F.pandas_udf(_SCORE_DDL)
    def apply(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        known: dict[int, dict[str, Forest]] = {}

        def model_of(text: str) -> Forest | None:
            key = next((k for k in (text, text.replace("/", ""), DEFAULT_KEY) if k in place), None)
            if key is None:
                return None
            group = place[key]
            if group not in known:
                known[group] = {name: Forest.restored(state) for name, state in groups[group].value.items()}
            return known[group][key]

        for name, *measures in batches:
            points = _points([m.to_numpy() for m in measures])
            values, flags = np.zeros(len(name)), np.zeros(len(name), dtype=bool)
            for text, rows in name.groupby(name).indices.items():
                model = model_of(text)
                if model is not None:
                    values[rows] = model.scores(points[rows])
                    flags[rows] = values[rows] > (np.inf if model.cut is None else model.cut)
            yield pd.DataFrame({"is_if_anomaly": flags, "if_anomaly_score": values})

    return df.withColumn("_scored", apply(normalize_symbol(F.col("symbol")), *_features(config))).select(
        *df.columns, "_scored.is_if_anomaly", "_scored.if_anomaly_score"
    )


def _model_groups(forest: DataFrame, meta: DataFrame, group_nodes: int) -> tuple[list, dict[str, int]]:
    """Broadcasts of models, and the broadcast of each symbol. The driver holds one group at a time."""
    counts = forest.groupBy("symbol").agg(F.count(F.lit(1)).alias("nodes"))
    facts = counts.join(meta.select("symbol", "psi", "score_cut"), "symbol").orderBy("symbol").collect()
    parts: list[list] = []
    room = 0
    for row in facts:
        if not parts or room < row["nodes"]:
            parts.append([])
            room = group_nodes
        parts[-1].append(row)
        room -= row["nodes"]
    groups, place = [], {}
    for part in parts:
        whole = forest if len(parts) == 1 else forest.where(F.col("symbol").isin([row["symbol"] for row in part]))
        nodes, models = whole.toArrow(), {}
        for row in part:
            place[row["symbol"]] = len(groups)
            # Broadcasts are pickled by reference, so plain arrays travel instead of the class.
            mine = nodes.filter(pc.equal(nodes["symbol"], row["symbol"]))
            models[row["symbol"]] = vars(_forest(mine, row["psi"], row["score_cut"]))
        groups.append(forest.sparkSession.sparkContext.broadcast(models))
    return groups, place


def score_cogrouped(
    df: DataFrame, forest: DataFrame, meta: DataFrame, config: ForestConfig = ForestConfig()
) -> DataFrame:
    """The same as ``score`` for batches, with each symbol's rows and model brought together, so that a task holds one
    model; symbols with many rows are spread over several groups."""
    return _with_own_model(df, resolve_models(df, meta), forest, meta, config)


def score_as_of(
    df: DataFrame, forest: DataFrame, meta: DataFrame, valid_from: DataFrame, config: ForestConfig = ForestConfig()
) -> DataFrame:
    """Scores by the model version that was valid at each row's time, as a replay needs them.

    ``forest`` and ``meta`` have a ``version``; ``valid_from`` (symbol, version, valid_from) tells since when each version
    of a symbol's model holds. Rows before the first version get false and zero.
    """
    name = lambda: F.concat_ws("@", "symbol", F.col("version").cast("string"))
    known = valid_from.select(normalize_symbol(F.col("symbol")).alias("_name"), name().alias("model_key"), "valid_from")
    named = df.withColumn("_name", normalize_symbol(F.col("symbol")))
    resolved = as_of_join(named, known, "_name").drop("_name", "valid_from")
    keyed = [part.withColumn("symbol", name()).drop("version") for part in (forest, meta)]
    return _with_own_model(df, resolved, *keyed, config)


def _with_own_model(df: DataFrame, resolved: DataFrame, forest: DataFrame, meta: DataFrame, config: ForestConfig) -> DataFrame:
    shares = resolved.groupBy("model_key").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(GROUP_ROWS)).cast("int").alias("_shares")
    )
    rows = resolved.join(shares, resolved["model_key"].eqNullSafe(shares["model_key"]), "left").drop(
        shares["model_key"]
    ).withColumn("_share", F.pmod(F.xxhash64(*df.columns), F.col("_shares")).cast("int")).drop("_shares")
    models = (
        forest.join(meta.select("symbol", "psi", "score_cut"), "symbol")
        .withColumnRenamed("symbol", "model_key")
        .join(shares, "model_key")
        .withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))).drop("_shares")
    )
    names, columns = list(config.features), df.columns

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        values, flags = np.zeros(left.num_rows), np.zeros(left.num_rows, dtype=bool)
        if left.num_rows and right.num_rows:
            model = _forest(right, right["psi"][0].as_py(), right["score_cut"][0].as_py())
            values = model.scores(_points([left[c].to_numpy().astype(float) for c in names]))
            flags = values > (np.inf if model.cut is None else model.cut)
        return left.select(columns).append_column("is_if_anomaly", pa.array(flags)).append_column(
            "if_anomaly_score", pa.array(values)
        )

    schema = T.StructType([
        *df.schema.fields, T.StructField("is_if_anomaly", T.BooleanType()), T.StructField("if_anomaly_score", T.DoubleType()),
    ])
    return rows.groupBy("model_key", "_share").cogroup(models.groupBy("model_key", "_share")).applyInArrow(apply, schema)


def forest_model(forest: DataFrame, meta: DataFrame, config: ForestConfig = ForestConfig()):
    """The forest as a model step for the detection flows."""
    return lambda df: score(df, forest, meta, config)


def latest_per_symbol(meta: DataFrame) -> DataFrame:
    """The newest version of each symbol's row in a versioned metadata table."""
    newest = W.partitionBy("symbol").orderBy(F.desc("version"))
    return meta.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def latest_version(path_df: DataFrame) -> DataFrame:
    """Rows of the newest complete model version of a versioned model table."""
    return path_df.where(F.col("version") == path_df.select(F.max("version")).scalar())
