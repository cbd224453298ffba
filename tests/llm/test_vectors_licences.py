"""Vector codes, centroid clustering and licence scans against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.llm import centroids, licences, vector_codes, walsh

VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(150):
        width, n, k = int(rng.choice([1, 3, 16, 20, 64])), rng.integers(1, 60), rng.integers(1, 30)
        points, entries = rng.integers(-4, 5, (n, width)), rng.integers(-4, 5, (k, width))
        index, distance = walsh.nearest(walsh.transform(points), walsh.transform(entries))
        every = ((points[:, None] - entries[None]) ** 2).sum(-1)
        assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_transform_keeps_distances_and_is_in_sequency_order():
    rows = np.random.default_rng(1).integers(-9, 9, (2, 16))
    a, b = walsh.transform(rows)
    assert ((a - b) ** 2).sum() == 16 * ((rows[0] - rows[1]) ** 2).sum() and a[0] == rows[0].sum()
    basis = walsh.transform(np.eye(16, dtype=np.int64)).T  # row k: the k-th coefficient's signs
    assert (np.diff((basis[:, 1:] != basis[:, :-1]).sum(axis=1)) == 1).all()


def test_largest_components_stay_exact():
    for width in (1, 16, 64):
        top = walsh.magnitude_limit(width) - 1
        points, entries = np.full((1, width), top), np.full((1, width), -top)
        _, distance = walsh.nearest(walsh.transform(points), walsh.transform(entries))
        assert int(distance[0]) == width * (2 * top) ** 2


def brute_lloyd(rows, first, rounds):
    books = first.astype(object)
    for last in [False] * rounds + [True]:
        distances = ((rows[:, None, :] - books[None].astype(np.int64)) ** 2).sum(-1)
        nearest = distances.argmin(1)
        if last:
            return nearest, distances.min(1), books.astype(np.int64)
        for e in range(len(books)):
            if (nearest == e).any():
                books[e] = [int(s) // int((nearest == e).sum()) for s in rows[nearest == e].sum(0)]


def vector_rows(n, width, seed=2):
    rng = np.random.default_rng(seed)
    made = [(int(i), [float(x) for x in rng.normal(0, 0.3, width)], int(i % 3) if i % 7 else None) for i in range(n)]
    made += [made[5], made[5], (n, [0.0] * width, 0)]  # repeated rows and ties
    odd = [(n + 1, None, 1), (n + 2, [None] * width, 1), (n + 3, [float("nan")] * width, 1), (n + 4, [float("inf")] * width, 1)]
    return made, odd


def test_product_codes_equal_brute_force(spark):
    made, odd = vector_rows(300, 16)
    df = spark.createDataFrame(made + odd, VECTORS).repartition(5).withColumn("v", F.lit(1)).withColumn("id", F.lit("x"))
    got = vector_codes.product_codes(df, entries=20).collect()
    made.sort(key=lambda r: r[0])
    whole = np.floor(1024 * np.array([r[1] for r in made], np.float32).astype(float)).astype(np.int64)
    parts = [brute_lloyd(whole[:, p * 4 : p * 4 + 4], whole[:20, p * 4 : p * 4 + 4], 4) for p in range(4)]
    error = sum(p[1] for p in parts)
    labels = [r[2] for r in made]
    digest = hashlib.sha256(",".join(str(x) for p in parts for x in p[2].ravel()).encode()).hexdigest()
    want = [
        (r[0], "".join(f"{p[0][i]:02x}" for p in parts), int(error[i]), int(sum(e for e, l in zip(error, labels) if l == r[2])), digest)
        for i, r in enumerate(made)
    ]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_clusters_equal_brute_force(spark):
    made, odd = vector_rows(200, 64)
    odd += [(900, [0.5] * 63, 1), (901, [], 1), (None, [0.25] * 64, 1)]
    df = spark.createDataFrame(made + odd, VECTORS).repartition(4).withColumn("cluster", F.lit(1)).withColumn("v", F.lit(1))
    got = centroids.clusters(df).collect()
    made.append(odd[-1])
    text = lambda r: f"1:{'null' if r[0] is None else r[0]}"
    made.sort(key=lambda r: hashlib.sha256(text(r).encode()).hexdigest())
    whole = np.floor(64 * np.array([r[1] for r in made], np.float32).astype(float)).astype(np.int64)
    nearest, distance, books = brute_lloyd(whole, whole[:16], 3)
    key = lambda r: (r[0] is None, r)
    want = [
        (
            r[0], int(c), int(d), int(distance[nearest == c].sum()), int(distance.sum()),
            hashlib.sha256(",".join(map(str, books[c])).encode()).hexdigest(),
        )
        for r, c, d in zip(made, nearest, distance)
    ]
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("operator", [vector_codes.product_codes, centroids.clusters])
def test_vectors_defined_cases(spark, operator):
    empty = spark.createDataFrame([], VECTORS)
    assert operator(empty).collect() == []
    one = spark.createDataFrame([(1, [0.5] * 64, None)], VECTORS)
    assert operator(one).count() == 1
    with pytest.raises(Exception, match="beyond exact 64-bit sums"):
        operator(spark.createDataFrame([(1, [1e30] * 64, 1)], VECTORS)).collect()


def test_short_and_uneven_vectors_are_padded(spark):
    rows = [(1, [0.5, 0.25, 1.0], 1), (2, [], 1), (3, [0.5, 0.25, 1.0, 0.0], 1), (4, [0.0] * 5, 2)]
    got = vector_codes.product_codes(spark.createDataFrame(rows, VECTORS), entries=2, rounds=0).collect()
    found = {r["vec_id"]: (r["code"], r["error"]) for r in got}
    assert found[1] == ("00000000", 0) and found[3] == found[1] and found[2] == found[4] == ("01010000", 0)  # eight places, two a part


def test_codes_do_not_depend_on_partitions(spark):
    made, _ = vector_rows(150, 64)
    df = spark.createDataFrame(made, VECTORS)
    for operator in (vector_codes.product_codes, centroids.clusters):
        a, b = operator(df.repartition(1)), operator(df.repartition(11))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


# ---- licences --------------------------------------------------------------------------------

def brute_runs(template, text, least):
    """(start, end) of the maximal runs of ``text`` that stand in ``template``."""
    stands = lambda run: any(template[j : j + len(run)] == run for j in range(len(template)))
    longest = [max(k for k in range(i + 2) if stands(text[i + 1 - k : i + 1])) for i in range(len(text))] + [0]
    return [(i + 1 - n, i + 1) for i, n in enumerate(longest[:-1]) if n >= least and longest[i + 1] != n + 1]


def brute_coverage(template, text, least, gap):
    groups, last = [[]], None
    for start, end in brute_runs(template, text, least):
        run = text[start:end]
        if last is not None and start - last > gap:
            groups.append([])
            last = None
        cut = start if last is None else max(start, last)
        groups[-1].append([(end - cut, j + len(run)) for j in range(len(template)) if template[j : j + len(run)] == run])
        last = end
    best = 0
    for group in groups:
        chains = {0: 0}  # end in the template: words
        for places in group:
            grown = dict(chains)
            for size, stop in places:
                words = max(w for e, w in chains.items() if e <= stop - size) + size
                grown[stop] = max(grown.get(stop, 0), words)
            chains = grown
        best = max(best, *chains.values())
    return best / len(template)


def test_coverage_equals_brute_force():
    rng = random.Random(4)
    for _ in range(600):
        letters = "abcd"[: rng.randint(2, 4)]
        templates = [[rng.choice(letters) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 4))]
        text = [rng.choice(letters + "z") for _ in range(rng.randint(0, 30))]
        least, gap = rng.randint(1, 3), rng.randint(0, 5)
        scan, at = licences.Scan(licences.Automaton(templates), least, gap), 0
        while at < len(text):
            step = rng.randint(1, 6)
            scan.feed(text[at : at + step])
            at += step
        assert scan.coverage() == [brute_coverage(t, text, least, gap) for t in templates]


def test_words_equal_their_definition():
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased; spaces and capitals beyond ASCII are as others."""
    every = "".join(f"aZ9{chr(c)}b" for c in (*range(0x250), 0x2003, 0x2028, 0x212A, 0x3000, 0xFEFF, 0xFFFF, 0x1F600))
    for text in ("", " ", "\x1c", every, every[::-1], "É\u0085é \u00a0 İK\x00MIT\x1fLicense"):
        lower = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)
        assert licences.words(text) == [w.encode() for w in re.findall("(?:[a-z0-9]|[^\x00-\x7F])+", lower)]


def test_phrases_that_end_alike_are_all_found():
    phrases = tuple((licences.words(p), label) for p, label in (("x license", "a"), ("my x license", "b"), ("license", "c"), ("x end", "d")))
    text = licences.words("license my x License end x license x end")
    found = [(0, "c"), (1, "b"), (2, "a"), (3, "c"), (5, "a"), (6, "c"), (7, "d")]
    assert sorted(licences.phrase_places(text, phrases)) == found
    assert sorted(licences.phrase_places(text, phrases, 3)) == found[1:]


def test_slices_change_nothing():
    automaton = licences._automaton(tuple(t for _, t in licences.TEMPLATES))
    phrases = tuple((licences.words(p), label) for p, label in licences.PHRASES)
    text = "Été MIT  License, x MIT\nLICENSE. " * 3 + licences.TEMPLATES[2][1] + " general-public license " + licences.TEMPLATES[4][1]
    whole = licences.scan_text(text, automaton, phrases, 3, 40)
    assert all(licences.scan_text(text, automaton, phrases, 3, 40, size) == whole for size in (1, 7, 50))
    assert [label for _, label in whole[1]].count("mit") == 6 and whole[0] == len(licences.words(text))


def test_licences_of_texts(spark):
    mit = licences.TEMPLATES[2][1]
    edited = mit.replace("free of charge", "at no cost").replace("merge, ", "")
    rows = [
        (1, None), (2, ""), (3, "a license of mit license and the MIT  License"), (4, "filler words " * 50 + edited),
        (5, "Licensed under CC BY-NC 4.0."), (6, "permission is hereby granted to nobody"), (7, "x" * 3_000_000), (5, "Licensed under CC BY-NC 4.0."),
        (8, "mit license " * 200_000), (None, "Apache license"), (9, "mitte license, mitlicense"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("labels", F.lit("clash")).withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in licences.document_licences(df).collect()}
    base = {k: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for k, r in got.items()}
    assert base[1] == base[2] == (0, 0, None, None, "") and base[3] == (9, 2, 3, 7, "mit") and base[7] == (1, 0, None, None, "")
    assert base[8] == (400_000, 200_000, 0, 399_998, "mit") and base[None] == (2, 1, 0, 0, "apache") and base[9] == (3, 0, None, None, "")
    assert got[4]["labels"] == "mit" and 0.85 <= got[4]["score"] < 1 and got[4]["base_labels"] == ""
    assert got[5]["labels"] == "cc-by-nc" and got[5]["score"] == 1.0
    assert got[6]["labels"] == "" and 0 < got[6]["score"] < 0.5
    assert licences.document_licences(df.limit(0)).collect() == []
