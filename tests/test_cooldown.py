"""Cooldown against a sequential fold."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewatch.operators import cooldown
from tradewatch.operators.cooldown import after, compose, exit_steps, passing, thin


def sequential(times, gap, not_before=None):
    last, out = None, []
    for i, t in enumerate(times):
        if not_before is not None and t < not_before:
            continue
        if last is None or t - last >= gap:
            out.append(i)
            last = t
    return out


sorted_times = st.lists(st.integers(0, 300), min_size=1, max_size=60).map(sorted)


@settings(max_examples=200, deadline=None)
@given(sorted_times, st.integers(1, 80), st.integers(-10, 320))
def test_passing(times, gap, start):
    assert passing(np.array(times), gap, start).tolist() == sequential(times, gap, start)


@settings(max_examples=200, deadline=None)
@given(sorted_times, st.integers(1, 80), st.data())
def test_exit_steps_describe_every_entry(times, gap, data):
    upto, final = exit_steps(np.array(times), gap)
    entry = data.draw(st.integers(times[0] - 5, times[0] + gap))
    passed = sequential(times, gap, entry)
    j = int(np.searchsorted(upto, entry))
    if passed:
        assert final[j] == times[passed[-1]]
    else:
        assert j == len(upto)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=2, max_size=80).map(sorted), st.integers(1, 80), st.data())
def test_composed_steps_equal_one_run(times, gap, data):
    """Composing neighbouring runs, in any bracketing, acts on every possible entry state like the whole run."""
    cuts = sorted(set(data.draw(st.lists(st.integers(1, len(times) - 1), min_size=1, max_size=5))))
    parts = [np.array(times[a:b]) for a, b in zip([0, *cuts], [*cuts, len(times)])]
    runs = [(int(p[0]), *exit_steps(p, gap)) for p in parts]
    entry = data.draw(st.integers(times[0] - 5, times[0] + gap))
    passed = sequential(times, gap, entry)
    want = times[passed[-1]] + gap if passed else entry
    while len(runs) > 1:
        i = data.draw(st.integers(0, len(runs) - 2))
        runs[i : i + 2] = [compose(runs[i], runs[i + 1], gap)]
    assert after(runs[0], entry, gap) == want
    assert after(runs[0], cooldown._NEVER, gap) == times[sequential(times, gap)[-1]] + gap


def events(spark, pattern):
    rng = np.random.default_rng(7)
    if pattern == "dense":
        seconds = np.sort(rng.integers(0, 20_000, 6000))
    elif pattern == "periodic":
        seconds = np.arange(6000) * 7
    elif pattern == "sparse":
        seconds = np.sort(rng.integers(0, 5_000_000, 6000))
    else:  # half the events at one instant
        seconds = np.sort(np.r_[np.full(3000, 9000), rng.integers(0, 20_000, 3000)])
    rows = [(int(i), int(s), None if i % 3 else "B", "z") for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "trade_id bigint, s bigint, symbol string, anomaly_type string").withColumn(
        "event_time", F.timestamp_seconds("s")
    )


@pytest.mark.parametrize("pattern", ["dense", "periodic", "sparse", "hot_instant"])
@pytest.mark.parametrize("block_rows", [100_000, 500])
def test_thin_equals_sequential_pass(spark, pattern, block_rows):
    df = events(spark, pattern).cache()
    pdf = df.toPandas().sort_values(["s", "trade_id"])
    want = set()
    for _, group in pdf.groupby("symbol", dropna=False):
        picked = sequential(group["s"].tolist(), 60)
        want |= set(group["trade_id"].iloc[picked])
    got = [r["trade_id"] for r in thin(df, ["symbol", "anomaly_type"], 60, block_rows=block_rows).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want


def test_gap_counts_from_the_last_that_passed(spark):
    rows = [(1, 0), (2, 40), (3, 61), (4, 100), (5, 121)]
    df = spark.createDataFrame(rows, "trade_id bigint, s bigint").select(
        "trade_id", F.lit("A").alias("symbol"), F.lit("z").alias("anomaly_type"), F.timestamp_seconds("s").alias("event_time")
    )
    assert sorted(r[0] for r in thin(df, ["symbol", "anomaly_type"], 60).collect()) == [1, 3, 5]


def test_null_times_never_pass_and_no_gap_passes_the_rest(spark):
    df = events(spark, "sparse").withColumn("event_time", F.when(F.col("trade_id") % 5 > 0, F.col("event_time")))
    timed = df.where("event_time is not null")
    for block_rows in (100_000, 500):
        a, b = (thin(d, ["symbol"], 60, block_rows=block_rows).select("trade_id") for d in (df, timed))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
        assert thin(df, ["symbol"], 0, block_rows=block_rows).count() == timed.count()
    with pytest.raises(ValueError):
        thin(df, ["symbol"], -1)
    with pytest.raises(ValueError):
        passing(np.array([1, 2]), 0)


def test_empty(spark):
    assert thin(events(spark, "sparse").where("false"), ["symbol"], 60).count() == 0
