"""Lloyd clustering of integer vectors by progressive search over Walsh-Hadamard coefficients.

Vectors and centroids are transformed exactly; coefficient differences are summed coarse to fine, centroids strictly
worse than a reachable distance go, and the rest are summed over all coefficients (``walsh.nearest``). Tasks report sums
per centroid, the driver holds the centroids: ``k`` x ``width`` numbers.

Defined cases: vectors of another width than ``width``, null ones and those with a null or non-finite component take no
part; a row without an id is hashed under the word null; equal rows are separate rows, and several rows of one id are
ordered by their components; of fewer rows than ``k`` each starts a centroid; an empty table gives an empty result;
other columns are ignored. A component that would overflow exact sums is an error.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import walsh
from tradewatch.llm.common import staged


def _partial_sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    turned, (k, width) = walsh.transform(centroids), centroids.shape
    counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
    for batch in batches:
        rows = walsh.matrix(batch.column(0), width)
        nearest, _ = walsh.nearest(walsh.transform(rows), turned)
        counts += np.bincount(nearest, minlength=k)
        np.add.at(sums, nearest, rows)
    own = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(own.astype(np.int32)), pa.array(counts[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))],
        ["cluster", "n", "sums"],
    )


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    turned = walsh.transform(centroids)
    for batch in batches:
        nearest, distance = walsh.nearest(walsh.transform(walsh.matrix(batch.column(1), centroids.shape[1])), turned)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(nearest.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
        )


def train(vectors: DataFrame, width: int, k: int, rounds: int) -> np.ndarray:
    """The centroids after so many rounds, from the rows whose hashed ids come first."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    first = vectors.orderBy(key, "v").limit(k).collect()
    centroids = np.array([row["v"] for row in first], np.int64).reshape(len(first), width)
    for _ in range(rounds):
        partial = vectors.select("v").mapInArrow(
            lambda b, centroids=centroids: _partial_sums(b, centroids), "cluster int, n long, sums array<long>"
        )
        sums, counts = defaultdict(dict), {}
        for r in walsh.sums_by_place(partial, ["cluster"]):
            counts[r["cluster"]] = r["n"]
            sums[r["cluster"]][r["place"]] = int(r["total"])
        centroids = walsh.means(sums, counts, centroids)
    return centroids


def clusters(
    rows: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, width: int = 64, id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Each vector's cluster and squared distance, the sums of these, and the digest of its centroid."""
    kept = rows.select(F.col(id_col).alias("id"), F.col(vector).alias("x")).where(walsh.finite(F.col("x")) & (F.size("x") == width))
    vectors = staged(kept.select("id", walsh.integers(F.col("x"), scale, walsh.magnitude_limit(width)).alias("v")), "integers")
    centroids = train(vectors, width, k, rounds)
    kind = vectors.schema["id"].dataType.simpleString()
    found = staged(vectors.mapInArrow(
        lambda batches: _assigned(batches, centroids), f"id {kind}, cluster int, distance long"
    ), "assigned")
    inertia = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    facts = rows.sparkSession.createDataFrame(
        [
            (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
            for c, v in enumerate(centroids.tolist()) if c in inertia
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
