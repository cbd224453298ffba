"""Invariants of the isolation forest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.config import ForestConfig, RollingConfig
from tradewatch.operators import evaluation, forest
from tradewatch.operators.rolling import rolling_features

CONFIG = ForestConfig(n_trees=40, max_samples=128, contamination=0.02)


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(3)
    rows = []
    for symbol, n in (("BTC/USDT", 600), ("ETH/USDT", 400), ("FEW/USDT", 60)):
        for i in range(n):
            far = i % 150 == 149
            z, pct, gap = (rng.normal(12, 1), rng.normal(40, 1), 90.0) if far else rng.normal(0, 1, 3)
            rows.append((symbol, len(rows), float(i), float(z), float(pct), float(abs(gap)), far))
    df = spark.createDataFrame(rows, "symbol string, trade_id bigint, s double, z_score double, price_change_pct double, time_gap_sec double, far boolean")
    return df.withColumn("event_time", F.timestamp_seconds("s")).cache()


@pytest.fixture(scope="module")
def model(features):
    return forest.train(features, CONFIG)


def test_expected_path():
    assert forest.expected_path(np.array([0, 1, 2])).tolist() == [0.0, 0.0, 1.0]
    assert forest.expected_path(np.array([256]))[0] == pytest.approx(10.2448, abs=1e-3)


def test_training_trades_give_the_same_training_rows(medium_trades):
    config, rolling = ForestConfig(max_rows=300), RollingConfig(tick_scale=2, window=200)
    cut = forest.training_trades(medium_trades, rolling.window, config)
    assert cut.count() == 5 * 499
    some, every = (
        forest.training_rows(rolling_features(t, rolling), config).orderBy("trade_id").toPandas() for t in (cut, medium_trades)
    )
    assert some["trade_id"].tolist() == every["trade_id"].tolist() and len(some) == 1500
    for name in config.features:
        np.testing.assert_allclose(some[name], every[name], rtol=1e-9, atol=1e-9)


def test_trees_partition_their_sample(model):
    nodes, meta = model
    assert {r["symbol"] for r in meta.collect()} == {"BTC/USDT", "ETH/USDT"}, "too few rows give no model"
    per_tree = nodes.groupBy("symbol", "tree").agg(
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("in_leaves"), F.max("depth").alias("depth"),
        F.count("*").alias("nodes"), F.count_if(F.col("feature") < 0).alias("leaves"),
    )
    for row in per_tree.collect():
        assert row["in_leaves"] == 128 and row["depth"] <= 7 and row["nodes"] == 2 * row["leaves"] - 1
    assert per_tree.count() == 2 * 40


def test_training_is_repeatable_under_repartitioning(features, model):
    again, _ = forest.train(features.repartition(13), CONFIG)
    assert again.exceptAll(model[0]).isEmpty() and model[0].exceptAll(again).isEmpty()


def test_outliers_rank_first_and_flags_match_contamination(features, model):
    scored = forest.score(features, *model, CONFIG).toPandas()
    for symbol, group in scored[scored.symbol != "FEW/USDT"].groupby("symbol"):
        far = group[group.far].if_anomaly_score
        assert far.min() > group[~group.far].if_anomaly_score.quantile(0.99), symbol
        assert group.is_if_anomaly.mean() == pytest.approx(CONFIG.contamination, abs=0.006)
    few = scored[scored.symbol == "FEW/USDT"]
    assert (few.if_anomaly_score == 0).all() and not few.is_if_anomaly.any()


def test_cogrouped_scoring_equals_broadcast(features, model, monkeypatch):
    monkeypatch.setattr(forest, "GROUP_ROWS", 100)
    odd = features.withColumn("z_score", F.when(F.col("trade_id") % 5 != 0, F.col("z_score")))
    a = forest.score(odd, *model, CONFIG).select("trade_id", "is_if_anomaly", F.round("if_anomaly_score", 9).alias("s"))
    b = forest.score_cogrouped(odd, *model, CONFIG).select("trade_id", "is_if_anomaly", F.round("if_anomaly_score", 9).alias("s"))
    assert a.count() == b.count() == 1060
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_model_fallback_in_scoring(spark, features, model):
    nodes, meta = model
    rename = F.when(F.col("symbol") == "BTC/USDT", "_default_").otherwise("ETHUSDT")
    nodes, meta = (df.withColumn("symbol", rename) for df in (nodes, meta))
    spelled = features.withColumn("symbol", F.when(F.col("symbol") == "ETH/USDT", "eth-usdt").otherwise("NEW"))
    scored = forest.score(spelled, nodes, meta, CONFIG)
    assert scored.where("if_anomaly_score = 0").count() == 0


def test_newest_rows_only(features):
    rows = forest.training_rows(features, ForestConfig(max_rows=200))
    assert {tuple(r) for r in rows.groupBy("symbol").count().collect()} == {("BTC/USDT", 200), ("ETH/USDT", 200)}
    assert rows.where("symbol = 'BTC/USDT'").agg(F.min("s") if "s" in rows.columns else F.min("trade_id")).first()[0] == 400


def test_model_groups_change_nothing(spark, features, model, folder):
    """One broadcast per symbol scores as one for all, on a stream too."""
    columns = ["trade_id", "is_if_anomaly", "if_anomaly_score"]
    whole = forest.score(features, *model, CONFIG).select(columns)
    groups, place = forest._model_groups(*model, group_nodes=10)
    assert len(groups) == 2 and sorted(place.values()) == [0, 1]
    apart = forest.score(features, *model, CONFIG, group_nodes=10).select(columns)
    assert whole.exceptAll(apart).isEmpty() and apart.exceptAll(whole).isEmpty()
    features.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(features.schema).parquet(f"{folder}/in")
    scored = forest.score(stream, *model, CONFIG, group_nodes=10).select(columns)
    scored.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(
        availableNow=True
    ).start().awaitTermination()
    again = spark.read.parquet(f"{folder}/out")
    assert again.count() == 1060 and again.exceptAll(whole).isEmpty()


def test_trees_do_not_depend_on_what_grows_beside_them():
    rng = np.random.default_rng(1)
    points, ids = rng.normal(size=(300, 3)), np.arange(300)
    together = forest.grow_forest(points, ids, "x", range(6), 64, 7, 0.7, False)
    apart = [forest.grow_forest(points, ids, "x", range(t, t + 1), 64, 7, 0.7, False) for t in range(6)]
    order = np.lexsort((together["node"], together["tree"]))
    for name in forest._NODE_COLUMNS:
        alone = np.concatenate([one[name][np.argsort(one["node"], kind="stable")] for one in apart])
        np.testing.assert_array_equal(together[name][order], alone)


@pytest.mark.parametrize("replace", [False, True])
def test_nodes_are_a_tree_over_the_sample(replace):
    """A plain walk puts every sampled row into the leaf whose size counts it."""
    rng = np.random.default_rng(2)
    points, ids = np.round(rng.normal(size=(200, 3)), 1), np.arange(200)
    nodes = forest.grow_forest(points, ids, "x", range(4), 90, 5, 1.0, replace)
    for tree in range(4):
        at = {n: i for i, n in enumerate(nodes["node"]) if nodes["tree"][i] == tree}
        weights = forest.tree_sample(ids, 90, forest.tree_salt("x", tree, 5), replace)
        assert weights.sum() == 90 and sorted(at) == list(range(len(at)))
        reached = dict.fromkeys(at, 0)
        for row in np.flatnonzero(weights):
            node = 0
            reached[node] += weights[row]
            while nodes["feature"][at[node]] >= 0:
                i = at[node]
                left = points[row, nodes["feature"][i]] <= nodes["split"][i]
                assert nodes["depth"][at[nodes["left"][i]]] == nodes["depth"][i] + 1
                node = nodes["left"][i] if left else nodes["right"][i]
                reached[node] += weights[row]
        assert all(reached[n] == nodes["size"][at[n]] > 0 for n in at)
        assert nodes["depth"][list(at.values())].max() <= 7


def test_path_totals_equal_scoring_of_stored_trees():
    rng = np.random.default_rng(3)
    points, ids = np.round(rng.normal(size=(400, 3)), 2), np.arange(400)
    for samples, replace in ((2, False), (60, False), (400, False), (400, True)):
        stored = forest.Forest(forest.grow_forest(points, ids, "x", range(8), samples, 1, 0.7, replace), samples, None)
        np.testing.assert_allclose(
            forest.path_totals(points, ids, "x", range(8), samples, 1, 0.7, replace), stored.totals(points), rtol=1e-12
        )


def test_neighbouring_values_part():
    points = np.array([[1.0], [np.nextafter(1.0, 2.0)]])
    for seed in range(20):
        nodes = forest.grow_forest(points, np.arange(2), "x", range(1), 2, seed)
        assert nodes["size"][nodes["feature"] < 0].tolist() == [1, 1]


def test_registered_forests_are_whole(monkeypatch):
    from unittest.mock import MagicMock

    from tradewatch.plans import registry

    configs, tail = [], MagicMock()
    tail.col.return_value.__lt__.return_value = True
    for name in ("trades", "rolling_of", "window_features_of", "rolling", "detection", "F"):
        monkeypatch.setattr(registry, name, tail)
    monkeypatch.setattr(forest, "training_trades", tail)
    monkeypatch.setattr(forest, "score", tail)
    monkeypatch.setattr(forest, "train", lambda rows, config: configs.append(config) or (tail, tail))
    for name in ("iforest_train", "iforest_score", "iforest_flags"):
        registry.QUERIES[name](tail, "")
    assert [(c.n_trees, c.max_samples) for c in configs] == [(100, 256)] * 3


def test_model_tables_round_trip(spark, features, model, folder):
    from tradewatch.sinks.tables import write_models

    write_models(*model, folder, "1")
    write_models(*model, folder, "2")
    nodes = forest.latest_version(spark.read.parquet(f"{folder}/forest"))
    meta = forest.latest_version(spark.read.parquet(f"{folder}/meta"))
    assert nodes.select("version").distinct().first()[0] == 2
    a = forest.score(features, nodes.drop("version"), meta.drop("version"), CONFIG)
    b = forest.score(features, *model, CONFIG)
    columns = ["trade_id", "is_if_anomaly", "if_anomaly_score"]
    assert a.select(columns).exceptAll(b.select(columns)).isEmpty()
