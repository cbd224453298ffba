"""The queries of this subpackage, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewatch.llm import (
    bpe, centroids, licences, mixing, near_dups, quality, secrets, sharding, substrings, token_shards, topk, vector_codes, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(operator: Callable[[DataFrame], DataFrame], name: str = "documents") -> Query:
    return lambda spark, folder: operator(spark.read.parquet(f"{folder}/{name}.parquet"))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": _table(mixing.mixture),
    "op2_secret_scan": _table(secrets.secret_spans),
    "op3_warc_salvage": _table(warc.round_trip, "pages"),
    "op4_bpe_chunks": _table(bpe.document_tokens),
    "op5_suffix_dedup": _table(substrings.document_repeats),
    "op6_quality_rules": _table(quality.document_quality),
    "op7_token_shards": _table(token_shards.materialised),
    "op8_exact_topk": _table(topk.top_k, "embeddings"),
    "op10_minhash_near_dups": _table(near_dups.near_duplicates),
    "op9_ring_shards": _table(sharding.document_shards),
    "op11_vector_codes": _table(vector_codes.product_codes, "embeddings"),
    "op12_centroids": _table(centroids.clusters, "embeddings"),
    "op13_licence_scan": _table(licences.document_licences),
}

#: The words of a text, for DuckDB.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source
), w AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s
), rounds AS (
  SELECT 0 AS r, source, source_size, k, weight, cap, false AS full_ FROM w
  UNION ALL
  SELECT r + 1, source, source_size, k, weight, cap, full_ OR weight * rest > cap * sharing
  FROM (
    SELECT *, sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () AS sharing,
      sum(source_size) OVER () - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER () AS rest
    FROM rounds
  ) WHERE r < (SELECT count(*) FROM w)
), level AS (
  SELECT *, sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () AS sharing,
    sum(source_size) OVER () - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER () AS rest
  FROM rounds WHERE r = (SELECT max(r) FROM rounds)
), t AS (
  SELECT source, source_size, k,
    CASE WHEN full_ THEN cap::DOUBLE ELSE (rest::DOUBLE * weight::DOUBLE) / sharing::DOUBLE END AS target
  FROM level
), line AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.k % 3 AS schedule, floor(t.target)::BIGINT AS budget,
    coalesce(sum(d.size) OVER (
      PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '-') || ':' || d.size)
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size END AS epochs,
    CASE WHEN source_size = 0 THEN 0 ELSE budget % source_size END AS rest
  FROM line
)
SELECT doc_id, source, size, source_size, target,
  (epochs * size + least(greatest(rest - start, 0), size))::BIGINT AS taken,
  CASE WHEN size = 0 THEN 0 ELSE epochs + CASE WHEN rest > start THEN 1 ELSE 0 END END::BIGINT AS visits,
  CASE WHEN size = 0 OR (epochs = 0 AND rest <= start) THEN NULL
    WHEN schedule = 0 THEN CASE
      WHEN 5.0 * (start::DOUBLE / budget::DOUBLE) <= 3.0
        THEN 2.0 * (5.0 * (start::DOUBLE / budget::DOUBLE)) / (7.0 + sqrt(49.0 - 8.0 * (5.0 * (start::DOUBLE / budget::DOUBLE))))
      ELSE 0.5 + 2.0 * (5.0 * (start::DOUBLE / budget::DOUBLE) - 3.0) / (5.0 + sqrt(25.0 - 8.0 * (5.0 * (start::DOUBLE / budget::DOUBLE) - 3.0))) END
    WHEN schedule = 1 THEN 2.0 * (2.0 * (start::DOUBLE / budget::DOUBLE)) / (2.0 + sqrt(4.0))
    ELSE CASE
      WHEN start::DOUBLE / budget::DOUBLE <= 0.3125
        THEN 2.0 * (start::DOUBLE / budget::DOUBLE) / (0.25 + sqrt(0.0625 + 3.0 * (start::DOUBLE / budget::DOUBLE)))
      ELSE 0.5 + 2.0 * (start::DOUBLE / budget::DOUBLE - 0.3125) / (1.0 + sqrt(1.0 + 3.0 * (start::DOUBLE / budget::DOUBLE - 0.3125))) END
  END AS position
FROM taken
"""

_OP3 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM m
"""

_OP8 = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r
)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

_OP6 = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents
), g AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS gram
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), f AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT i + j)::BIGINT AS n_repeat_words FROM f, range(8) t(j) GROUP BY r
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), c AS (
  SELECT w.r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c
), v AS (
  SELECT r, lang, source, 'symbols' AS ratio, n_symbols * 1000 // word_chars AS value FROM b WHERE NOT base_failed
  UNION ALL SELECT r, lang, source, 'word_length', word_chars * 100 // n_words FROM b WHERE NOT base_failed
  UNION ALL SELECT r, lang, source, 'dup_lines', n_dup_lines * 1000 // n_lines FROM b WHERE NOT base_failed
  UNION ALL SELECT r, lang, source, 'repeats', n_repeat_words * 1000 // n_words FROM b WHERE NOT base_failed
), sk AS (
  SELECT *, floor(ln(value + 1.0) / ln(1.02))::BIGINT AS bucket FROM v
), q AS (
  SELECT lang, source, ratio, grouping(lang) AS g1, grouping(source) AS g2, count(*) AS total,
    list_sort(list(bucket)) AS bs
  FROM sk GROUP BY GROUPING SETS ((lang, source, ratio), (lang, ratio), (ratio))
), x(ratio, low_, high_, times_) AS (
  VALUES ('symbols', 25, 75, 5), ('word_length', 25, 75, 5), ('dup_lines', 50, 99, 2), ('repeats', 50, 99, 2)
), qq AS (
  SELECT lang, source, ratio, g1, g2, total, times_,
    floor(exp((bs[((total * low_ + 99) // 100)::BIGINT] + 0.5) * ln(1.02))) - 1 AS low,
    floor(exp((bs[((total * high_ + 99) // 100)::BIGINT] + 0.5) * ln(1.02))) - 1 AS high
  FROM q JOIN x USING (ratio)
), fence AS (
  SELECT o.lang, o.source, o.ratio,
    CASE WHEN o.total >= 20 THEN o.low WHEN l.total >= 20 THEN l.low ELSE a.low END - reach AS low,
    CASE WHEN o.total >= 20 THEN o.high WHEN l.total >= 20 THEN l.high ELSE a.high END + reach AS high
  FROM qq o
  JOIN qq l ON l.g1 = 0 AND l.g2 = 1 AND l.ratio = o.ratio AND l.lang IS NOT DISTINCT FROM o.lang
  JOIN qq a ON a.g1 = 1 AND a.g2 = 1 AND a.ratio = o.ratio,
  LATERAL (SELECT CASE WHEN o.total >= 20 AND o.high > o.low THEN o.times_ * (o.high - o.low)
    WHEN l.total >= 20 AND l.high > l.low THEN o.times_ * (l.high - l.low)
    WHEN a.high > a.low THEN o.times_ * (a.high - a.low) ELSE 20 END AS reach)
  WHERE o.g1 = 0 AND o.g2 = 0
), bad AS (
  SELECT DISTINCT v.r FROM v JOIN fence f ON f.ratio = v.ratio AND f.lang IS NOT DISTINCT FROM v.lang
    AND f.source IS NOT DISTINCT FROM v.source
  WHERE v.value > f.high OR (v.ratio = 'word_length' AND v.value < f.low)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept
FROM b
"""

#: Vectors without nulls, infinities and NaN.
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
_SQUARES = "list_sum(list_transform(list_zip({0}.v, {1}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
#: Floor of a sum over a count.
_MEAN = "((s - ((s % n) + n) % n) // n)::BIGINT"


def _op11(rounds: int = 4, entries: int = 256, parts: int = 4) -> str:
    """Lloyd rounds over every part, all distances computed."""
    steps = [f"""
WITH r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v, len(v) // {parts} AS size FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_FINITE}
  )
), p AS MATERIALIZED (
  SELECT r, part, v[part * size + 1:(part + 1) * size] AS v FROM r, range({parts}) t(part)
), e0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, v FROM p WHERE r <= {entries}
)"""]
    for k in range(rounds + 1):
        steps.append(f""", a{k} AS MATERIALIZED (
  SELECT p.r, p.part, min({_SQUARES.format("p", "e")} * {entries} + e.entry) AS m FROM p JOIN e{k} e USING (part) GROUP BY p.r, p.part
)""")
        if k < rounds:
            steps.append(f""", m{k} AS (
  SELECT part, entry, list({_MEAN} ORDER BY i) AS v FROM (
    SELECT part, m % {entries} AS entry, i, sum(v[i]) AS s, count(*) AS n
    FROM (SELECT part, m, v, unnest(range(1, len(v) + 1)) AS i FROM a{k} JOIN p USING (r, part)) GROUP BY ALL
  ) GROUP BY part, entry
), e{k + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, coalesce(m.v, e.v) AS v FROM e{k} e LEFT JOIN m{k} m ON m.part = e.part AND m.entry = e.entry
)""")
    steps.append(f""", books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds}
), c AS (
  SELECT r, string_agg(lower(printf('%02x', m % {entries})), '' ORDER BY part) AS code, sum(m // {entries})::BIGINT AS error
  FROM a{rounds} GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM r JOIN c USING (r), books""")
    return "".join(steps)


def _op12(rounds: int = 3, k: int = 16) -> str:
    steps = [f"""
WITH r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, 'null')), v) AS r, vec_id, v FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE {_FINITE} AND len(embedding) = 64
  )
), c0 AS MATERIALIZED (
  SELECT r - 1 AS cluster, v FROM r WHERE r <= {k}
)"""]
    for n in range(rounds + 1):
        steps.append(f""", a{n} AS MATERIALIZED (
  SELECT r.r, min({_SQUARES.format("r", "c")} * {k} + c.cluster) AS m FROM r, c{n} c GROUP BY r.r
)""")
        if n < rounds:
            steps.append(f""", m{n} AS (
  SELECT cluster, list({_MEAN} ORDER BY i) AS v FROM (
    SELECT m % {k} AS cluster, i, sum(v[i]) AS s, count(*) AS n
    FROM (SELECT m, v, unnest(range(1, 65)) AS i FROM a{n} JOIN r USING (r)) GROUP BY ALL
  ) GROUP BY cluster
), c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON m.cluster = c.cluster
)""")
    steps.append(f""", d AS (
  SELECT r, (m % {k})::INTEGER AS cluster, (m // {k})::BIGINT AS distance FROM a{rounds}
)
SELECT vec_id, d.cluster, distance, (sum(distance) OVER (PARTITION BY d.cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM r JOIN d USING (r) JOIN c{rounds} c ON c.cluster = d.cluster""")
    return "".join(steps)


ORACLE: dict[str, str] = {
    "op1_mix_sources": _OP1, "op3_warc_salvage": _OP3, "op6_quality_rules": _OP6, "op8_exact_topk": _OP8,
    "op11_vector_codes": _op11(), "op12_centroids": _op12(),
}
