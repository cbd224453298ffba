"""Guided parameter search, the best set's model, and parameter importance."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.config import ForestConfig
from tradewatch.operators import evaluation, forest, search

SPACE = {"n_estimators": (4, 10), "max_samples": (0.05, 0.1), "contamination": (0.005, 0.05), "max_features": (0.5, 1.0)}
PLAN = search.SearchConfig(trials=9, startup=4, per_round=3, trees_per_task=3)
CONFIG = ForestConfig()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        far = i % 60 == 59
        z, pct, gap = (rng.normal(12, 1), rng.normal(40, 1), 90.0) if far else rng.normal(0, 1, 3)
        rows.append(("BTC/USDT" if i % 3 else "ETH/USDT", i, float(z), float(pct), None if i % 50 == 0 else float(abs(gap))))
    rows.append(rows[10])  # a repeated row
    df = spark.createDataFrame(rows, "symbol string, trade_id bigint, z_score double, price_change_pct double, time_gap_sec double")
    return evaluation.proxy_labels(df, 5.0).cache()


@pytest.fixture(scope="module")
def trials(labelled):
    return search.search(labelled, CONFIG, PLAN, SPACE).cache()


def test_defaults_are_the_whole_search():
    plan = search.SearchConfig()
    assert plan.trials == 100 and plan.max_rows >= 10_000
    assert search.TUNING_SPACE["n_estimators"] == (50, 300) and search.TUNING_SPACE["max_samples"] == (0.1, 1.0)


def test_trials_are_in_range_and_repeatable(labelled, trials):
    rows = trials.orderBy("trial").collect()
    assert [r["trial"] for r in rows] == list(range(9))
    for r in rows:
        assert all(SPACE[n][0] <= r[n] <= SPACE[n][1] for n in SPACE) and r["tp"] + r["fp"] + r["fn"] + r["tn"] == 901
    again = search.search(labelled.repartition(7), CONFIG, PLAN, SPACE)
    assert again.orderBy("trial").collect() == rows
    assert max(r["f1"] for r in rows) > 0.3
    assert search.best_trial(trials).first()["f1"] == max(r["f1"] for r in rows)


def test_trials_equal_stored_forests(labelled, trials):
    """Counts from path sums in batches equal those of whole forests, scored and cut one by one."""
    ids, points, labels = search.tail_arrays(labelled, CONFIG, 1000)
    for p in trials.collect():
        psi = max(2, int(p["max_samples"] * len(points)))
        nodes = forest.grow_forest(
            points, ids, "tuning", range(p["n_estimators"]), psi, CONFIG.seed, p["max_features"], p["bootstrap"]
        )
        values = forest.Forest(nodes, psi, None).scores(points)
        flagged, truth = values > np.quantile(values, 1.0 - p["contamination"]) + 1e-12, labels == 1
        want = ((truth & flagged).sum(), (~truth & flagged).sum(), (truth & ~flagged).sum(), (~truth & ~flagged).sum())
        assert (p["tp"], p["fp"], p["fn"], p["tn"]) == want


def test_proposals_gather_where_trials_are_good():
    """On a smooth target the guided rounds beat as many random draws, for most seeds."""
    target = lambda t: -((t["contamination"] - 0.02) ** 2) * 1e4 - (t["max_samples"] - 0.3) ** 2 + 0.1 * t["bootstrap"]
    wins = 0
    for seed in range(10):
        plan = search.SearchConfig(seed=seed)
        done = [t | {"f1": target(t)} for t in search.draw_trials(20, seed)]
        while len(done) < 100:
            done += [t | {"f1": target(t)} for t in search.propose(done, 20, len(done), plan)]
        late = np.mean([t["f1"] for t in done[60:]])
        blind = np.mean([target(t) for t in search.draw_trials(40, seed + 100)])
        wins += late > blind and max(t["f1"] for t in done) >= max(target(t) for t in search.draw_trials(100, seed + 200)) - 0.02
        assert all(isinstance(t["n_estimators"], int) and 50 <= t["n_estimators"] <= 300 for t in done)
    assert wins >= 8


def test_parzen_density_is_one_over_the_range():
    density = search.Parzen([0.1, 0.12, 0.9], 0.0, 1.0)
    grid = (np.arange(20_000) + 0.5) / 20_000
    assert np.mean([density.density(x) for x in grid]) == pytest.approx(1.0, abs=1e-3)
    rng = random.Random(1)
    drawn = [density.sample(rng) for _ in range(3000)]
    assert min(drawn) >= 0 and max(drawn) <= 1
    assert np.mean(np.array(drawn) < 0.3) == pytest.approx(np.mean([density.density(x) * (x < 0.3) for x in grid]), abs=0.03)


def test_best_set_is_fitted_and_judged(labelled, trials):
    nodes, meta = search.fit_best(labelled, trials, CONFIG, PLAN)
    best, facts = search.best_trial(trials).first(), meta.first()
    assert (facts["n_trees"], facts["trained_rows"]) == (best["n_estimators"], 901)
    assert nodes.select("tree").distinct().count() == best["n_estimators"]
    quality = search.model_quality(forest.score(labelled, nodes, meta), 5.0).first()
    assert (quality["tp"], quality["fp"], quality["fn"]) == (best["tp"], best["fp"], best["fn"])


def test_limits_of_the_tail(spark, labelled):
    with pytest.raises(ValueError, match="more than 100 rows"):
        search.search(labelled, CONFIG, search.SearchConfig(max_rows=100))
    assert search.search(labelled.limit(0), CONFIG, PLAN).count() == 0
    assert {tuple(r) for r in search.parameter_importance(search.search(labelled.limit(0), CONFIG, PLAN)).collect()} == {
        (name, 0.0, 0.0) for name in search.PARAMETERS
    }


def test_importance_of_known_shares(spark):
    """F1 = 3 a + b over uniform parameters: a explains nine tenths of the variance, b one tenth."""
    rows = []
    for t in search.draw_trials(400, 9):
        a = (t["max_samples"] - 0.1) / 0.9
        b = (t["contamination"] - 0.001) / 0.049
        rows.append((t["trial"], *[t[n] for n in search.PARAMETERS], 0, 0, 0, 0, 3 * a + b))
    found = {r["parameter"]: r for r in search.parameter_importance(spark.createDataFrame(rows, search.TRIALS_DDL)).collect()}
    assert found["max_samples"]["importance"] == pytest.approx(0.9, abs=0.04)
    assert found["contamination"]["importance"] == pytest.approx(0.1, abs=0.04)
    assert sum(r["importance"] for r in found.values()) == pytest.approx(1.0)
    assert found["bootstrap"]["importance"] < 0.01


def test_marginals_of_a_known_tree():
    """A tree that is 1 on the left half of the first dimension and 0 elsewhere has all its variance there."""
    box = lambda low, high: np.array([[low, high], [0.0, 1.0]])
    assert search.marginal_shares([(box(0.0, 0.5), 1.0), (box(0.5, 1.0), 0.0)]).tolist() == [1.0, 0.0]
    corner = [(np.array([[0, 0.5], [0, 0.5]]), 1.0), (np.array([[0, 0.5], [0.5, 1.0]]), 0.0), (box(0.5, 1.0), 0.0)]
    # variance 3/16; each marginal is 1/2 on one half: variance 1/16
    np.testing.assert_allclose(search.marginal_shares(corner), [1 / 3, 1 / 3])
    assert search.marginal_shares([(box(0.0, 1.0), 2.0)]) is None
