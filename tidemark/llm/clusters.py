"""Centroid clustering with Ptolemaic pivots.

Lloyd's rounds over whole numbers, so every sum, distance and centroid is exact and no layout changes a
result. A few fixed vectors are the pivots; the distances of every vector to them are computed once and kept
beside it. For points x and c and pivots s and t, Ptolemy's inequality gives

    d(x, c) >= |d(x, s) d(c, t) - d(x, t) d(c, s)| / d(s, t)

so a round needs only the pivot distances of its centroids to bound all distances from below. The bounds are
rounded down by more than the error of their arithmetic; the centroid of the least bound is computed exactly,
and then those others whose bound does not exceed it.

A round is one job: each task hands on one sum for each centroid, and the driver holds the centroids alone.
The vectors are read from a table in the shared folder, which survives lost executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import stored
from tidemark.llm.vectors import matrices, usable

SLACK = 1e-12  # of a bound; far above the rounding of the few operations that make it
LARGEST = 1 << 26  # of a component; a squared distance of 64 such differences fits a long
OUT = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class Clustering:
    """``seed`` comes before the id in the hash that ranks vectors for the first centroids."""

    k: int = 8
    rounds: int = 10
    size: int = 64
    scale: int = 1024
    seed: str = "3"


def first_centroids(vectors: DataFrame, params: Clustering) -> np.ndarray:
    """The ``k`` vectors that come first by hash of their id; ``k`` rows reach the driver. Rows that share an
    id come in the order of their components, rows without an id last."""
    rank = F.sha2(F.concat(F.lit(f"{params.seed}:"), F.col("id").cast("string")), 256)
    chosen = vectors.orderBy(rank.asc_nulls_last(), "x").limit(params.k).collect()
    return whole(np.floor(params.scale * np.array([r["x"] for r in chosen]).reshape(-1, params.size)))


def whole(components: np.ndarray) -> np.ndarray:
    if components.size and np.abs(components).max() >= LARGEST:
        raise ValueError(f"a scaled component is {LARGEST} or more; squared distances would not fit a long")
    return components.astype(np.int64)


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances between two sets of whole-number points, rounded once each."""
    return np.sqrt(np.stack([squared(points, o) for o in others], axis=1).astype(float))


def squared(points: np.ndarray, other: np.ndarray) -> np.ndarray:
    gap = points - other
    return np.einsum("ij,ij->i", gap, gap)


@dataclass(frozen=True)
class Pivots:
    """Fixed pivots; pairs of equal ones bound nothing and are left out."""

    points: np.ndarray
    pairs: tuple[tuple[int, int, float], ...]

    @staticmethod
    def of(points: np.ndarray) -> Pivots:
        between = distances(points, points) if len(points) else np.zeros((0, 0))
        pairs = combinations(range(len(points)), 2)
        return Pivots(points, tuple((s, t, between[s, t]) for s, t in pairs if between[s, t] > 0))

    def lower(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """A bound below the distance of every vector (by its ``cached`` pivot distances) to every centroid,
        as computed from ``centroids``, their pivot distances."""
        bound = np.zeros((len(cached), len(centroids)))
        for s, t, apart in self.pairs:
            a, b = np.outer(cached[:, s], centroids[:, t]), np.outer(cached[:, t], centroids[:, s])
            np.maximum(bound, (np.abs(a - b) - SLACK * (a + b)) / apart, out=bound)
        return bound * (1 - SLACK)


def nearest(vectors: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of every vector (ties: the smaller number), its squared distance, and how many
    distances were computed."""
    bound = pivots.lower(cached, distances(centroids, pivots.points))
    best = bound.argmin(axis=1)
    least = np.einsum("ij,ij->i", vectors - centroids[best], vectors - centroids[best])
    guess, done = best.copy(), len(vectors)
    for c, centroid in enumerate(centroids):
        at = np.flatnonzero((guess != c) & (bound[:, c] ** 2 * (1 - SLACK) <= least))
        found = squared(vectors[at], centroid)
        closer = (found < least[at]) | ((found == least[at]) & (c < best[at]))
        best[at[closer]], least[at[closer]] = c, found[closer]
        done += len(at)
    return best, least, done


def with_pivots(vectors: DataFrame, pivots: Pivots, params: Clustering) -> DataFrame:
    """(id, v, p): components as whole numbers and distances to the pivots, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, components in matrices(batch, params.scale):
                v = whole(components)
                columns = [batch.column("id").take(pa.array(rows)), lists(v.astype(np.int32)), lists(distances(v, pivots.points))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "p"])

    return stored(vectors.mapInArrow(run, "id long, v array<int>, p array<double>"), "pivots")


def lists(matrix: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def columns_of(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    v, p = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in ("v", "p"))
    return v.reshape(-1, size).astype(np.int64), p


def sums_by_cluster(table: DataFrame, centroids: np.ndarray, pivots: Pivots, params: Clustering) -> dict:
    """(count, inertia, component sums) of every centroid that is some vector's nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        counts, inertia, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, params.size), np.int64)
        for batch in batches:
            v, p = columns_of(batch, params.size)
            best, least, _ = nearest(v, p, centroids, pivots)
            counts += np.bincount(best, minlength=k)
            for c in np.unique(best):
                inertia[c] += least[best == c].sum()
                sums[c] += v[best == c].sum(axis=0)
        met = np.flatnonzero(counts)
        values = np.column_stack([counts, inertia, sums])[met]
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), lists(values)], ["cluster", "sums"])

    parts = table.mapInArrow(run, "cluster int, sums array<long>").select("cluster", F.posexplode("sums"))
    total = parts.groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total"))
    found: dict[int, list[int]] = {}
    for r in total.orderBy("cluster", "pos").collect():
        found.setdefault(r["cluster"], []).append(int(r["total"]))
    return {c: (s[0], s[1], s[2:]) for c, s in found.items()}


def clusters(df: DataFrame, id_col: str, vector_col: str, params: Clustering = Clustering()) -> DataFrame:
    """One row for every vector of ``size`` usable components: id, cluster, squared distance to its centroid,
    the sums of it over the cluster and over all vectors, and the sha256 of the centroid.

    Rows whose vector is NULL, of another length, or holds a NULL or non-finite component are left out.
    Repeated rows are vectors of their own. With fewer than ``k`` vectors there are as many centroids; equal
    first centroids keep their numbers, and the larger of them stay empty. An empty table gives no rows.
    A scaled component of 2^26 or more is an error.
    """
    vectors = usable(df, id_col, vector_col).where(F.size("x") == params.size)
    centroids = first_centroids(vectors, params)
    if not len(centroids):
        return df.sparkSession.createDataFrame([], OUT)
    pivots = Pivots.of(centroids.copy())
    table = with_pivots(vectors, pivots, params)
    for _ in range(params.rounds):
        for c, (n, _, sums) in sums_by_cluster(table, centroids, pivots, params).items():
            centroids[c] = [s // n for s in sums]
    inertia = {c: s for c, (_, s, _) in sums_by_cluster(table, centroids, pivots, params).items()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    every = sum(inertia.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, least, _ = nearest(*columns_of(batch, params.size), centroids, pivots)
            columns = [
                batch.column("id"),
                pa.array(best.astype(np.int32)),
                pa.array(least),
                pa.array([inertia[c] for c in best.tolist()], pa.int64()),
                pa.array([every] * len(best), pa.int64()),
                pa.array([digests[c] for c in best.tolist()], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [n.split()[0] for n in OUT.split(", ")])

    return table.mapInArrow(run, OUT)
