"""Search for forest parameters, the model of the best set, and what each parameter contributes.

Trials run in rounds. The first round is drawn at random; each later one is proposed from all trials before it by Parzen
estimators (Bergstra et al., NIPS 2011): one density over the parameters of the best trials, one over the others, and
the values where their ratio is largest. Every trial of a round is cut into batches of trees and each batch is one task,
so a round is as wide as its trees; all trees of all trials are grown in full.

The rows are the bounded training tail: at most ``SearchConfig.max_rows``, which is checked. A task grows its trees over
these rows in arrays and returns one sum of path lengths per row. Trials are a small table, as long as their number.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.config import ForestConfig
from tradewatch.operators import forest
from tradewatch.operators.evaluation import confusion_matrix

# Ranges of the search.
TUNING_SPACE = {
    "n_estimators": (50, 300),
    "max_samples": (0.1, 1.0),
    "contamination": (0.001, 0.05),
    "max_features": (0.5, 1.0),
}
PARAMETERS = ("n_estimators", "max_samples", "contamination", "max_features", "bootstrap")
TRIALS_DDL = (
    "trial int, n_estimators int, max_samples double, contamination double, max_features double, bootstrap boolean, "
    "tp long, fp long, fn long, tn long, f1 double"
)


@dataclass(frozen=True)
class SearchConfig:
    """Trials and rounds of a search, and how proposals are made."""

    trials: int = 100
    startup: int = 20
    per_round: int = 20
    seed: int = 42
    good_share: float = 0.2
    candidates: int = 24
    trees_per_task: int = 25
    max_rows: int = 100_000

    def __post_init__(self) -> None:
        if min(self.trials, self.startup, self.per_round, self.candidates, self.trees_per_task) < 1:
            raise ValueError("trials, rounds, candidates and trees per task must be positive")
        if not 0.0 < self.good_share < 1.0:
            raise ValueError("good_share must lie in (0, 1)")


# ---- proposals -------------------------------------------------------------------------------

def draw_trials(n: int, seed: int = 42, space: dict = TUNING_SPACE, first: int = 0) -> list[dict]:
    """Random parameter sets, the same for the same seed."""
    rng = random.Random(seed)
    return [
        {
            "trial": i,
            "n_estimators": rng.randint(*space["n_estimators"]),
            "max_samples": rng.uniform(*space["max_samples"]),
            "contamination": rng.uniform(*space["contamination"]),
            "max_features": rng.uniform(*space["max_features"]),
            "bootstrap": rng.random() < 0.5,
        }
        for i in range(first, first + n)
    ]


class Parzen:
    """Density over [low, high]: a normal at each observed value, as wide as the gaps beside it, and a flat part."""

    def __init__(self, values: list[float], low: float, high: float):
        self.low, self.high, self.span = low, high, max(high - low, 1e-12)
        points = sorted(values)
        fences = [low, *points, high]
        least = self.span / min(100, len(points) + 2)
        self.kernels = []
        for left, value, right in zip(fences, points, fences[2:]):
            normal = NormalDist(value, min(max(value - left, right - value, least), self.span))
            inside = max(normal.cdf(high) - normal.cdf(low), 1e-12)
            self.kernels.append((normal, inside))

    def density(self, value: float) -> float:
        return (1.0 / self.span + sum(k.pdf(value) / inside for k, inside in self.kernels)) / (len(self.kernels) + 1)

    def sample(self, rng: random.Random) -> float:
        pick = rng.randrange(len(self.kernels) + 1)
        if pick == len(self.kernels):
            return rng.uniform(self.low, self.high)
        normal, inside = self.kernels[pick]
        share = normal.cdf(self.low) + rng.random() * inside
        return min(max(normal.inv_cdf(min(max(share, 1e-12), 1 - 1e-12)), self.low), self.high)


def propose(done: list[dict], n: int, first: int, config: SearchConfig = SearchConfig(), space: dict = TUNING_SPACE) -> list[dict]:
    """``n`` parameter sets, numbered from ``first``, from the trials ``done``; the same for the same trials and seed.

    Sets proposed earlier in the round count among the others, so that a round spreads out. The switch is drawn by its
    share among the best.
    """
    ranked = sorted(done, key=lambda t: (-t["f1"], t["trial"]))
    cut = max(1, math.ceil(config.good_share * len(ranked)))
    good, rest = ranked[:cut], ranked[cut:]
    fine = {name: Parzen([t[name] for t in good], *map(float, space[name])) for name in space}
    on = (1 + sum(t["bootstrap"] for t in good)) / (2 + len(good))
    made: list[dict] = []
    for trial in range(first, first + n):
        rng, values = random.Random(f"{config.seed}|{trial}"), {"trial": trial}
        for name in space:
            poor = Parzen([t[name] for t in rest + made], *map(float, space[name]))
            candidates = [fine[name].sample(rng) for _ in range(config.candidates)]
            if isinstance(space[name][0], int):
                candidates = [float(round(c)) for c in candidates]
            best = max(candidates, key=lambda c: fine[name].density(c) / poor.density(c))
            values[name] = int(best) if isinstance(space[name][0], int) else best
        values["bootstrap"] = rng.random() < on
        made.append(values)
    return made


# ---- trials ----------------------------------------------------------------------------------

def tail_arrays(labelled: DataFrame, config: ForestConfig, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, points and labels of the training tail in a fixed order; an error if it has more than ``limit`` rows."""
    rows = labelled.select("trade_id", *forest._features(config), F.col("label").cast("int").alias("label"))
    table = rows.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        raise ValueError(f"the training tail has more than {limit} rows")
    table = table.sort_by([(c, "ascending") for c in table.column_names])
    points = forest._points([table[c].to_numpy() for c in config.features]).reshape(table.num_rows, len(config.features))
    return table["trade_id"].to_numpy(), points, table["label"].to_numpy()


def _judged(totals: np.ndarray, labels: np.ndarray, trial: dict, psi: int) -> tuple[int, int, int, int]:
    """tp, fp, fn, tn of the rows above the trial's cut."""
    norm = float(max(forest.expected_path(np.array([psi]))[0], 1e-9))
    values = 2.0 ** (-totals / trial["n_estimators"] / norm)
    flagged = values > np.quantile(values, 1.0 - trial["contamination"])
    truth = labels == 1
    return tuple(int(x.sum()) for x in (truth & flagged, ~truth & flagged, truth & ~flagged, ~truth & ~flagged))


def run_trials(
    session, tail: tuple[np.ndarray, np.ndarray, np.ndarray], trials: list[dict], config: ForestConfig = ForestConfig(),
    trees_per_task: int = SearchConfig.trees_per_task,
) -> list[dict]:
    """The trials with their confusion counts and F1; each batch of trees is a task of its own."""
    jobs = [(t, b) for t in trials for b in range(-(-t["n_estimators"] // trees_per_task))]
    shared, seed = session.sparkContext.broadcast(tail), config.seed
    sizes = {t["trial"]: max(2, int(t["max_samples"] * len(tail[0]))) for t in trials}
    by_trial = {t["trial"]: t for t in trials}

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points, _ = shared.value
        for batch in batches:
            for job in batch.column(0).to_pylist():
                t, b = jobs[job]
                trees = range(b * trees_per_task, min((b + 1) * trees_per_task, t["n_estimators"]))
                totals = forest.path_totals(
                    points, ids, "tuning", trees, sizes[t["trial"]], seed, t["max_features"], t["bootstrap"]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t["trial"]], pa.int32()), pa.array([b], pa.int32()), pa.array([totals.tolist()])],
                    ["trial", "batch", "totals"],
                )

    def judge(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("batch")  # added in one order: equal rows get equal scores
        trial = parts["trial"][0].as_py()
        totals = sum(chunk.values.to_numpy() for chunk in (row for row in parts["totals"]))
        counts = _judged(totals, shared.value[2], by_trial[trial], sizes[trial])
        return pa.table({"trial": pa.array([trial], pa.int32())} | {n: pa.array([c]) for n, c in zip(("tp", "fp", "fn", "tn"), counts)})

    grown = session.range(0, len(jobs), 1, len(jobs)).mapInArrow(grow, "trial int, batch int, totals array<double>")
    counted = {
        r["trial"]: r.asDict()
        for r in grown.groupBy("trial").applyInArrow(judge, "trial int, tp long, fp long, fn long, tn long").collect()
    }
    shared.unpersist()
    done = []
    for t in trials:
        c = counted[t["trial"]]
        hits = 2 * c["tp"] + c["fp"] + c["fn"]
        done.append(t | c | {"f1": 2 * c["tp"] / hits if hits else 0.0})
    return done


def search(
    labelled: DataFrame, config: ForestConfig = ForestConfig(), plan: SearchConfig = SearchConfig(), space: dict = TUNING_SPACE
) -> DataFrame:
    """One row per trial: its parameters, confusion counts against ``label`` and F1. An empty tail has no trial."""
    session = labelled.sparkSession
    tail = tail_arrays(labelled, config, plan.max_rows)
    done: list[dict] = []
    while len(done) < plan.trials and len(tail[0]):
        if not done:
            trials = draw_trials(min(plan.startup, plan.trials), plan.seed, space)
        else:
            trials = propose(done, min(plan.per_round, plan.trials - len(done)), len(done), plan, space)
        done += run_trials(session, tail, trials, config, plan.trees_per_task)
    names = [field.split()[0] for field in TRIALS_DDL.split(", ")]
    return session.createDataFrame([tuple(t[n] for n in names) for t in done], TRIALS_DDL)


# ---- the best set ----------------------------------------------------------------------------

def best_trial(results: DataFrame) -> DataFrame:
    """The parameter set with the highest F1; the earlier trial wins ties."""
    return results.orderBy(F.desc("f1"), "trial").limit(1)


def fit_best(
    labelled: DataFrame, results: DataFrame, config: ForestConfig = ForestConfig(), plan: SearchConfig = SearchConfig()
) -> tuple[DataFrame, DataFrame]:
    """Node and metadata tables of the best set, fitted on the whole tail as the default model of all symbols."""
    best = best_trial(results).first()
    if best is None:
        raise ValueError("no trial to fit")
    session = labelled.sparkSession
    tail = tail_arrays(labelled, config, plan.max_rows)
    psi = max(2, int(best["max_samples"] * len(tail[0])))
    shared, step, params, seed = session.sparkContext.broadcast(tail[:2]), plan.trees_per_task, best.asDict(), config.seed

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = shared.value
        for batch in batches:
            for b in batch.column(0).to_pylist():
                trees = range(b * step, min((b + 1) * step, params["n_estimators"]))
                columns = forest.grow_forest(
                    points, ids, "tuning", trees, psi, seed, params["max_features"], params["bootstrap"]
                )
                yield forest.node_batch(forest.DEFAULT_KEY, columns)

    tasks = -(-params["n_estimators"] // step)
    nodes = forest.materialise(session.range(0, tasks, 1, tasks).mapInArrow(grow, forest.FOREST_DDL))
    meta = session.createDataFrame(
        [(forest.DEFAULT_KEY, params["n_estimators"], psi, params["contamination"], None, len(tail[0]))],
        "symbol string, n_trees int, psi int, contamination double, score_cut double, trained_rows long",
    )
    scored = forest.score(labelled, nodes, meta, config)
    cut = scored.agg(F.percentile("if_anomaly_score", F.lit(1.0 - params["contamination"])).alias("cut")).first()["cut"]
    return nodes, meta.withColumn("score_cut", F.lit(cut).cast("double"))


def model_quality(scored: DataFrame, limit: float) -> DataFrame:
    """Confusion matrix of model flags against the proxy label."""
    return confusion_matrix(
        scored.select((F.abs(F.coalesce("z_score", F.lit(0.0))) > limit).alias("truth"), F.col("is_if_anomaly").alias("predicted"))
    )


# ---- importance ------------------------------------------------------------------------------

def unit_points(trials: list, space: dict) -> np.ndarray:
    """Parameters scaled to [0, 1]; a switch is 0 or 1."""
    out = np.zeros((len(trials), len(PARAMETERS)))
    for j, name in enumerate(PARAMETERS):
        low, high = space.get(name, (0, 1))
        out[:, j] = [(float(t[name]) - low) / ((high - low) or 1) for t in trials]
    return out


def regression_leaves(points: np.ndarray, values: np.ndarray, least: int = 2) -> list[tuple[np.ndarray, float]]:
    """Leaves (box as [low, high] per dimension, mean) of a tree that splits by squared error over the unit cube."""
    leaves, pending = [], [(np.arange(len(values)), np.tile([0.0, 1.0], (points.shape[1], 1)))]
    while pending:
        rows, box = pending.pop()
        best = (1e-15, None)
        own = values[rows]
        for j in range(points.shape[1]):
            order = np.argsort(points[rows, j], kind="stable")
            x, y = points[rows[order], j], own[order]
            n, left = np.arange(1, len(y)), np.cumsum(y)[:-1]
            gain = left**2 / n + (y.sum() - left) ** 2 / (len(y) - n) - y.sum() ** 2 / len(y)
            gain[(x[1:] == x[:-1]) | (n < least) | (len(y) - n < least)] = -1.0
            if len(gain) and gain.max() > best[0]:
                at = int(gain.argmax())
                best = (float(gain[at]), (j, (x[at] + x[at + 1]) / 2))
        if best[1] is None:
            leaves.append((box, float(own.mean())))
            continue
        j, split = best[1]
        lower, upper = box.copy(), box.copy()
        lower[j, 1] = upper[j, 0] = split
        pending += [(rows[points[rows, j] <= split], lower), (rows[points[rows, j] > split], upper)]
    return leaves


def marginal_shares(leaves: list[tuple[np.ndarray, float]]) -> np.ndarray | None:
    """Share of the tree's variance over the unit cube that each dimension's marginal explains; None if it has none."""
    boxes, values = np.stack([b for b, _ in leaves]), np.array([v for _, v in leaves])
    widths = boxes[:, :, 1] - boxes[:, :, 0]
    volumes = widths.prod(axis=1)
    mean = float((volumes * values).sum())
    variance = float((volumes * (values - mean) ** 2).sum())
    if variance <= 1e-18:
        return None
    shares = []
    for j in range(boxes.shape[1]):
        edges = np.unique(boxes[:, j])
        middle = (edges[1:] + edges[:-1]) / 2
        covers = (boxes[:, j, 0][:, None] <= middle) & (middle < boxes[:, j, 1][:, None])
        marginal = (np.divide(volumes * values, widths[:, j])[:, None] * covers).sum(axis=0)
        shares.append(float(((edges[1:] - edges[:-1]) * (marginal - mean) ** 2).sum()) / variance)
    return np.array(shares)


def parameter_importance(results: DataFrame, space: dict = TUNING_SPACE, trees: int = 64, seed: int = 42) -> DataFrame:
    """parameter, variance_share, importance: functional analysis of variance over a stored table of trials.

    A forest of regression trees learns F1 from the parameters; each tree gives the share of its variance that lies in a
    parameter's marginal (Hutter et al., ICML 2014). ``variance_share`` is the mean over the trees, and ``importance``
    scales these to a sum of 1. If F1 never varies, all are 0.
    """
    trials = [r.asDict() for r in results.select("trial", *PARAMETERS, "f1").orderBy("trial").collect()]
    points, values = unit_points(trials, space), np.array([t["f1"] for t in trials])

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                drawn = np.random.default_rng([seed, tree]).integers(0, len(values), len(values)) if len(values) else []
                found = marginal_shares(regression_leaves(points[drawn], values[drawn])) if len(values) else None
                if found is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree] * len(PARAMETERS)), pa.array(PARAMETERS), pa.array(found)], ["tree", "parameter", "share"]
                    )

    session = results.sparkSession
    grown = session.range(trees).mapInArrow(shares, "tree long, parameter string, share double")
    sums = grown.groupBy("parameter").agg(F.aggregate(
        F.array_sort(F.collect_list(F.struct("tree", "share"))), F.lit(0.0), lambda total, t: total + t["share"]
    ).alias("total"), F.count(F.lit(1)).alias("n"))
    named = session.createDataFrame([(name,) for name in PARAMETERS], "name string")
    mean = named.join(sums, F.col("name") == F.col("parameter"), "left").select(
        F.col("name").alias("parameter"), F.coalesce(F.col("total") / F.col("n"), F.lit(0.0)).alias("variance_share")
    )
    whole = mean.agg(F.sum("variance_share").alias("whole"))
    return mean.join(F.broadcast(whole)).select(
        "parameter", "variance_share", F.coalesce(F.try_divide("variance_share", "whole"), F.lit(0.0)).alias("importance")
    )
