"""Adaptive fences of the quality rules."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from tradewatch.llm import quality

DOCS = "doc_id long, text string, lang string, source string"


def prose(rng, n=60, size=5, marks=""):
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(max(1, size + rng.randint(-1, 1)))) for _ in range(n)]
    lines = [" ".join(words[i : i + 10]) for i in range(0, n, 10)]
    return "\n".join(lines) + marks


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng), "en", "web" if i % 2 else "book") for i in range(200)]
    rows += [(200 + i, prose(rng, size=9, marks="#" * (10 + i % 5)), "de", "forum") for i in range(100)]
    line = prose(rng, n=10)
    planted = {
        "symbols": (1000, prose(rng).replace("a", "#").replace("b", "$").replace("c", "%"), "en", "web"),
        "word_length": (1001, prose(rng, size=12), "en", "web"),
        "short_words": (1002, prose(rng, size=1), "en", "book"),
        "dup_lines": (1003, "\n".join([prose(rng, n=40), *[f"{i} same line here" if i % 3 else "again" for i in range(9)]]), "en", "web"),
        "repeats": (1004, prose(rng, n=100) + "\n" + line + " x " + line, "en", "book"),
        "usual_here": (1005, prose(rng, size=9, marks="#" * 12), "de", "forum"),
        "unusual_there": (1006, prose(rng, size=9, marks="#" * 12), "en", "web"),
    }
    return spark.createDataFrame(rows + list(planted.values()), DOCS).cache(), {k: v[0] for k, v in planted.items()}


def test_each_fence_rejects_its_planted_outlier(corpus):
    docs, ids = corpus
    rows = {r["doc_id"]: r for r in quality.document_quality(docs).collect()}
    for name in ("symbols", "word_length", "short_words", "dup_lines", "repeats", "unusual_there"):
        assert not rows[ids[name]]["base_failed"] and not rows[ids[name]]["kept"], name
    assert rows[ids["usual_here"]]["kept"]
    assert sum(r["kept"] for i, r in rows.items() if i < 300) == 300


@pytest.mark.parametrize("ratio", list(quality.RATIOS))
def test_an_outlier_passes_without_its_fence(corpus, monkeypatch, ratio):
    """The planted document goes by its own ratio and no other."""
    docs, ids = corpus
    counted = quality.text_counts(docs)
    limits = quality.fences(quality.sketches(counted))
    row = counted.where(F.col("doc.doc_id") == ids[ratio]).join(
        limits, F.col("doc.lang").eqNullSafe(F.col("fence_lang")) & F.col("doc.source").eqNullSafe(F.col("fence_source"))
    ).select(*[(quality._ratio(name) > F.col(f"{name}_high")).alias(name) for name in quality.RATIOS]).first()
    assert [name for name in quality.RATIOS if row[name]] == [ratio]


def test_fences_differ_by_language_and_source(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = quality.fences(quality.sketches(quality.text_counts(docs.select("doc_id", "lang", "source", "text")))).collect()
    of = lambda name: {(r["fence_lang"], r["fence_source"]): r[f"{name}_high"] for r in rows}
    lengths = of("word_length")
    by_language = {l: {high for (lang, _), high in lengths.items() if lang == l} for l in {lang for lang, _ in lengths}}
    assert len(by_language) == 4 and len(set().union(*by_language.values())) > 4
    assert any(len(highs) > 1 for highs in by_language.values())  # sources of one language differ
    assert len(set(of("dup_lines").values())) > 1 and len(set(of("repeats").values())) > 1


def test_spread_falls_back_to_language_then_corpus_then_resolution(spark):
    sketch = "lang string, source string, ratio string, bucket long, n long"
    rows = [("en", "a", "symbols", 0, 60), ("en", "b", "symbols", 0, 60), ("en", "b", "symbols", 100, 60), ("de", "c", "symbols", 0, 80)]
    found = {(r["fence_lang"], r["fence_source"]): r for r in quality.fences(spark.createDataFrame(rows, sketch)).collect()}
    value = 6  # of bucket 100
    assert found[("en", "b")]["symbols_high"] == value + 5 * value
    assert found[("en", "a")]["symbols_high"] == 0 + 5 * value
    assert found[("de", "c")]["symbols_high"] == quality.UNITS  # all documents have no spread between their quartiles
    assert quality.fences(spark.createDataFrame([], sketch)).count() == 0
