"""Quality rules with adaptive thresholds.

One pass over the texts gives counts per document. Ratios of these counts are sketched per language and source in
log-spaced buckets (relative error ``ACCURACY``); sketches merge by adding counts, so partial sketches combine before
the shuffle and a language's sketch is the sum of its sources'. A document is rejected by the base rules, or if a ratio
lies beyond the fence of its language and source: a quantile of their sketch plus a multiple of the spread between two
quantiles. Ratios that are 0 in most documents take a far quantile, so that the few documents that have lines or passages
twice set the spread. A source without spread takes that of its language, a language without that of all documents; only
if even this is 0 do ``UNITS`` of the sketch's resolution stand in. A source with fewer than ``FEW`` documents takes its
language's quantiles too, a small language those of all documents.

Defined cases: a null text has no words and fails the base rules; null languages and sources are groups of their own;
equal rows are judged alike; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import staged

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

ACCURACY = 0.01
FEW = 20
UNITS = 20
#: Ratio: numerator, denominator, factor, percents of the two quantiles, reach in spreads, whether low values go too.
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 1000, 25, 75, 5, False),
    "word_length": ("word_chars", "n_words", 100, 25, 75, 5, True),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 50, 99, 2, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 50, 99, 2, False),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
STATS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def repeat_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``width`` (a power of 2) words that occur at least twice, exactly: windows of 2, 4, ...
    words are numbered by the pairs of halves that they consist of."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    names = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    half = 1
    while half < width:
        pairs = names[:-half] * (int(names.max()) + 1) + names[half:]
        found, names = np.unique(pairs, return_inverse=True)
        if len(found) == len(pairs):
            return 0
        half *= 2
    often = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += often
    edges[width : n + width] -= often
    return int((np.cumsum(edges) > 0).sum())


def counts_of(texts: pa.Array) -> list[np.ndarray]:
    """COUNTS for an array of UTF-8 texts (null: no words)."""
    n = len(texts)
    out = np.zeros((len(COUNTS), n), np.int64)
    table = np.zeros(256, np.uint8)
    table[np.frombuffer(SYMBOLS, np.uint8)] = 1
    for i, value in enumerate(texts):
        text = value.as_py()
        if not text:
            continue
        words = text.split()  # bytes.split() parts at exactly the six ASCII white space characters
        if not words:
            continue
        data = np.frombuffer(text, np.uint8)
        spaces = int(((data == 32) | ((data >= 9) & (data <= 13))).sum())
        lines = [line for line in text.split(b"\n") if line.strip()]
        out[:, i] = (
            len(words), int(((data & 0xC0) != 0x80).sum()) - spaces, int(table[data].sum()),
            len(lines) - len(set(lines)), len(lines), repeat_words(words),
        )
    return list(out)


def _with_counts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 1000):
            rows = batch.slice(part, 1000)
            counts = counts_of(rows.column(text).cast(pa.binary()))
            stats = pa.StructArray.from_arrays([pa.array(c) for c in counts], list(COUNTS))
            yield pa.RecordBatch.from_arrays([rows.column("doc"), stats], ["doc", "stats"])


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, stats): the other columns of ``docs`` as one struct, and COUNTS of its texts."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*others).alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc"], T.StructField("stats", STATS)])
    return rows.mapInArrow(lambda batches: _with_counts(batches, "text"), schema)


def base_failed(stats: str = "stats"):
    words, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def _ratio(name: str):
    top, bottom, factor, *_ = RATIOS[name]
    return F.expr(f"stats.{top} * {factor} div nullif(stats.{bottom}, 0)")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n): merged sketches of documents that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), _ratio(r).alias("value")) for r in RATIOS])).alias("r")
    rows = rows.where(~base_failed()).select("doc.lang", "doc.source", each).select("lang", "source", "r.*")
    bucket = F.floor(F.log(F.col("value") + 1.0) / F.lit(math.log1p(2 * ACCURACY)))
    return rows.groupBy("lang", "source", "ratio", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def _of_ratio(place: int):
    """The ratio's entry of RATIOS, as a column."""
    return F.expr("CASE ratio " + " ".join(f"WHEN '{name}' THEN {facts[place]}" for name, facts in RATIOS.items()) + " END")


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Per group and ratio: total, and the two quantiles of the ratio, each the first bucket that reaches its share."""
    merged = sketch.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "ratio")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    merged = merged.withColumn("upto", upto).withColumn("total", F.sum("n").over(group))
    value = F.floor(F.exp((F.col("bucket") + 0.5) * F.lit(math.log1p(2 * ACCURACY)))) - 1
    quantile = lambda place: F.min(F.when(F.col("upto") * 100 >= F.col("total") * _of_ratio(place), value))
    return merged.groupBy(*by, "ratio").agg(F.max("total").alias("total"), quantile(3).alias("low"), quantile(4).alias("high"))


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the lowest and highest accepted value of every ratio."""
    own = _quantiles(sketch, ["lang", "source"])
    by_lang = _quantiles(sketch, ["lang"]).select(
        F.col("lang").alias("of_lang"), F.col("ratio").alias("of_ratio"), *[F.col(c).alias(f"lang_{c}") for c in ("total", "low", "high")]
    )
    of_all = _quantiles(sketch, []).select(F.col("ratio").alias("all_ratio"), *[F.col(c).alias(f"all_{c}") for c in ("low", "high")])
    rows = own.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("ratio") == F.col("of_ratio")))
    rows = rows.join(of_all, F.col("ratio") == F.col("all_ratio"))
    many, lang_many = F.col("total") >= FEW, F.col("lang_total") >= FEW
    pick = lambda q: F.when(many, F.col(q)).when(lang_many, F.col(f"lang_{q}")).otherwise(F.col(f"all_{q}"))
    spread = lambda of: F.col(f"{of}high") - F.col(f"{of}low")
    reach = _of_ratio(5) * F.when(many & (spread("") > 0), spread("")).when(
        lang_many & (spread("lang_") > 0), spread("lang_")
    ).when(spread("all_") > 0, spread("all_"))
    rows = rows.select("lang", "source", "ratio", pick("low").alias("low"), pick("high").alias("high"), F.coalesce(reach, F.lit(UNITS)).alias("reach"))
    out = []
    for name in RATIOS:
        here = F.col("ratio") == name
        out += [
            F.max(F.when(here, F.col("low") - F.col("reach"))).alias(f"{name}_low"),
            F.max(F.when(here, F.col("high") + F.col("reach"))).alias(f"{name}_high"),
        ]
    return rows.groupBy(F.col("lang").alias("fence_lang"), F.col("source").alias("fence_source")).agg(*out)


def verdicts(rows: DataFrame) -> DataFrame:
    """``rows`` (doc, stats) with base_failed and kept. Small tables of fences are broadcast by the planner's own check
    of their size; a larger one is joined by language and source."""
    limits = fences(sketches(rows))
    rows = rows.join(
        limits,
        F.col("doc.lang").eqNullSafe(F.col("fence_lang")) & F.col("doc.source").eqNullSafe(F.col("fence_source")), "left",
    )
    beyond = F.lit(False)
    for name, (*_, low) in RATIOS.items():
        beyond = beyond | (_ratio(name) > F.col(f"{name}_high"))
        if low:
            beyond = beyond | (_ratio(name) < F.col(f"{name}_low"))
    kept = ~base_failed() & ~F.coalesce(beyond, F.lit(False))
    return rows.select("doc", "stats", base_failed().alias("base_failed"), kept.alias("kept"))


def document_quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every document."""
    rows = staged(text_counts(docs.select("doc_id", "lang", "source", "text")), "counts")
    rows = verdicts(rows)
    counts = [c for c in COUNTS if c != "n_lines"]
    return rows.select("doc.doc_id", *[f"stats.{c}" for c in counts], "base_failed", "kept")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    columns = docs.columns
    rows = docs.select(*[F.col(f"`{c}`") for c in columns], F.col("text").alias(_spare(columns)))
    rows = staged(text_counts(rows, _spare(columns)), "counts")
    return verdicts(rows).where("kept").select("doc.*")


def _spare(columns: list[str]) -> str:
    name = "_counted"
    while name in columns:
        name = "_" + name
    return name
