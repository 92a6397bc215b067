"""Centroid clustering by a tournament of bisectors, all in whole numbers.

For centroids a < b a vector x is strictly nearer to b where
2 (b - a) . x > |b|^2 - |a|^2. Normals 2 (b - a) and thresholds of all pairs are
computed once a round. A vector starts with centroid 0 and meets 1, 2, ... in
turn; each sign test eliminates one of the two, and zero leaves the smaller
number, so k - 1 tests leave the nearest centroid, the smallest of equally near
ones. Only the distance to that one is computed. Every number is a 64-bit
integer and exact.

Each round is one pass over the vectors: a task sends per cluster one count and
one row of sums, so a cluster with most of the rows costs no more than others.
The driver gets k rows of sums, never vectors.

Defined results: rows whose vector is null, has another number of components or
a null or non-finite one are dropped; repeated rows count as often as they
occur; a null vec_id starts no cluster but is assigned to one; with fewer rows
than k there are so many centroids; no rows, or none with an id, give an empty
result. A component of
more than 2^27 after scaling is an error, since no long holds its distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed, stored
from tidemark.llm.vectors import checked, matrix, usable, whole

#: Rows that a task tests at once.
_SLICE = 1 << 12


@dataclass(frozen=True)
class Clustering:
    """``k`` centroids, how often they are replaced, the components of a vector, and the factor before rounding down."""

    k: int = 16
    rounds: int = 3
    size: int = 64
    scale: int = 64
    salt: str = "1"


class Tournament:
    """The bisectors of all pairs of some centroids."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = checked(centroids)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        squares = (centroids * centroids).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row of ``x``."""
        best = np.zeros(len(x), dtype=np.int64)
        for rival in range(1, len(self.centroids)):
            lost = np.einsum("ij,ij->i", x, self.normals[best, rival]) > self.thresholds[best, rival]
            best[lost] = rival
        return best

    def distances(self, x: np.ndarray, winners: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[winners]
        return np.einsum("ij,ij->i", apart, apart)


def _slices(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    x = checked(matrix(column, size))
    for at in range(0, max(1, len(x)), _SLICE):
        yield x[at : at + _SLICE]


def first_centroids(vectors: DataFrame, ways: Clustering) -> np.ndarray:
    """The vectors with the least digests of their ids; among equal ids the least vectors."""
    digest = F.sha2(F.concat(F.lit(f"{ways.salt}:"), F.col("vec_id").cast("string")), 256)
    least = vectors.filter(F.col("vec_id").isNotNull()).orderBy(digest, "x").limit(ways.k).select("x").collect()
    return np.array([r["x"] for r in least], dtype=np.int64).reshape(-1, ways.size)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid with vectors becomes their mean, rounded down; the others stay."""
    k, size = centroids.shape
    game = Tournament(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, size), dtype=object)
        for batch in batches:
            for x in _slices(batch.column("x"), size):
                winners = game.winners(x)
                order = np.argsort(winners, kind="stable")
                here, starts, n = np.unique(winners[order], return_index=True, return_counts=True)
                counts[here] += n
                sums[here] += np.add.reduceat(x[order], starts, axis=0).astype(object) if len(x) else 0
        met = np.flatnonzero(counts)
        values = pa.array([[str(counts[c]), *map(str, sums[c])] for c in met], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), values], ["cluster", "sums"])

    parts = vectors.select("x").mapInArrow(run, "cluster int, sums array<string>").select("cluster", F.posexplode("sums"))
    rows = parts.groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total")).collect()
    totals = {(r["cluster"], r["pos"]): int(r["total"]) for r in rows}
    found = centroids.copy()
    for c in {c for c, _ in totals}:
        found[c] = [totals[c, 1 + i] // totals[c, 0] for i in range(size)]
    return found


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The columns of ``vectors`` without ``x``, with ``cluster`` and the squared ``distance``."""
    size = centroids.shape[1]
    game = Tournament(centroids)
    carried = [c for c in vectors.columns if c != "x"]
    types = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters, distances = [], []
            for x in _slices(batch.column("x"), size):
                clusters.append(game.winners(x))
                distances.append(game.distances(x, clusters[-1]))
            new = [pa.array(np.concatenate(clusters).astype(np.int32)), pa.array(np.concatenate(distances))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *new], [*carried, "cluster", "distance"])

    return vectors.mapInArrow(run, f"{types}, cluster int, distance long")


def clustered(
    embeddings: DataFrame, ways: Clustering = Clustering(), vec_id: str = "vec_id", vector: str = "embedding", keep: list[str] | None = None
) -> DataFrame:
    """(row, vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): one row per usable vector.

    ``row`` has the columns ``keep`` (all), and is absent for an empty list.
    """
    rows = packed(embeddings, keep, vec_id=vec_id, vector=vector)
    rows = rows.withColumns({"vec_id": F.col("vec_id").cast("long"), "vector": F.col("vector").cast("array<double>")})
    good = rows.filter(usable(F.col("vector"), ways.size))
    vectors = stored(good.withColumn("x", whole(F.col("vector"), ways.scale)).drop("vector"), "cluster-vectors")
    centroids = first_centroids(vectors, ways)
    for _ in range(ways.rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    if not len(centroids):
        # no id to start from: no centroid, no result
        vectors, centroids = vectors.limit(0), np.zeros((1, ways.size), dtype=np.int64)
    found = stored(assigned(vectors, centroids), "cluster-assigned")
    sums = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    longs = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(marks))])
    return found.withColumns(
        {
            "cluster_inertia": longs[F.col("cluster")],
            "inertia": F.lit(sum(sums.values())).cast("long"),
            "centroid_sha256": F.array(*map(F.lit, marks))[F.col("cluster")],
        }
    )
