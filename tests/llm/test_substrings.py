"""Suffix-array dedup: previous factors, periodic passages, bounded contexts."""

import random
from collections import Counter

import numpy as np
import pytest

from tradewatch.llm import substrings

LENGTH, GRAM = 40, 8


def brute(texts, length, keep_first):
    """Bytes left of each text."""
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    before, left = set(), []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            if (w in before) if keep_first else seen[w] > 1:
                gone[k : k + length] = True
            before.add(w)
        left.append(bytes(np.frombuffer(t, np.uint8)[~gone]))
    return left


def periodic_texts(seed):
    """Texts of runs of short periods, with cuts and copies of each other's parts."""
    rng = random.Random(seed)
    texts = []
    for _ in range(6):
        parts = []
        for _ in range(rng.randint(1, 5)):
            unit = "".join(rng.choice("abc-") for _ in range(rng.choice([1, 1, 2, 3, 7, 11])))
            parts.append((unit * 200)[: rng.randint(1, 160)])
        text = "".join(parts)
        if texts and rng.random() < 0.5:
            donor = rng.choice(texts)
            at = rng.randrange(len(donor))
            text += donor[at : at + rng.randint(1, 120)]
        texts.append(text)
    return texts


@pytest.mark.parametrize("keep_first", [False, True])
def test_periodic_texts_equal_brute_force(spark, keep_first):
    for seed, bucket_rows in ((1, 5000), (2, 5000), (3, 2), (4, 5000)):
        texts = periodic_texts(seed)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = substrings.removed_repeats(df, keep_first, length=LENGTH, gram=GRAM, bucket_rows=bucket_rows, digests=False).collect()
        got = {r["doc_id"]: bytes(r["kept"]) for r in rows}
        assert [got[i] for i in range(len(texts))] == brute([t.encode() for t in texts], LENGTH, keep_first), seed


def test_stretches_of_a_period_are_equal():
    """Every stretch that is folded into a row has the bytes of that row's context."""
    anchors = substrings.Anchors(LENGTH, GRAM)
    for seed in range(60):
        text = "".join(periodic_texts(seed)).encode()
        windows = 0
        for _, low, high, until in zip(*anchors(text)):
            period = high - low
            assert (until - low) % period == 0
            for at in range(low, until, period):
                assert text[at : at + period - 1 + LENGTH] == text[low : high - 1 + LENGTH]
            windows += until - low
        assert windows == max(0, len(text) - LENGTH + 1)


@pytest.mark.parametrize("unit", [b"-", b"-=", b"+--", b"0123456789" * 4])
def test_five_megabytes_of_one_period_stay_small(unit):
    text = unit * (5_000_000 // len(unit))
    gram, low, high, until = substrings.Anchors(400, 50)(text)
    assert until[-1] == len(text) - 399 and len(gram) < 8000
    assert int((high - low + 399).sum()) < 4_000_000


def test_previous_factors_equal_the_stack_method():
    """Against longest previous factors computed in the plain way, for every suffix of a short text."""
    rng = random.Random(5)
    for _ in range(200):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40)))
        least = rng.randint(1, 5)
        starts = np.arange(max(0, len(text) - least + 1))
        if len(starts) == 0:
            continue
        classes = substrings.suffix_classes(text, starts, least)
        order = np.argsort(classes, kind="stable")
        order = order[np.lexsort((np.array([rng.random() for _ in order]), classes[order]))]  # ties in any order
        agree = np.concatenate([[False], classes[order[1:]] == classes[order[:-1]]])
        found = np.zeros(len(starts), bool)
        found[order] = substrings.smaller_place(starts[order], agree)
        for i in starts:
            common = lambda j: next((k for k in range(len(text) - i) if text[i + k] != text[j + k]), len(text) - i)
            longest = max((common(j) for j in range(i)), default=0)
            assert found[i] == (longest >= least)
