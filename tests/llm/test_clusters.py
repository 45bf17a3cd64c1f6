"""Centroid clustering against a plain version, and its bounds against true distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException

from tidemark.llm import clusters as module
from tidemark.llm.clusters import Clustering, Pivots, clusters, distances, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, x int, p string, cluster string"


def plain(rows, params):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == params.size and all(v is not None and math.isfinite(v) for v in e):
            kept.append((i, [math.floor(params.scale * v) for v in e]))
    rank = lambda r: (r[0] is None, hashlib.sha256(f"{params.seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=rank)[: params.k]]

    def assigned():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(params.rounds):
        found = assigned()
        for c in range(len(centroids)):
            mine = [v for (_, v), (a, _) in zip(kept, found) if a == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assigned()
    every = sum(d for _, d in found)
    rows = []
    for (i, _), (c, d) in zip(kept, found):
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        rows.append((i, c, d, sum(e for b, e in found if b == c), every, digest))
    return sorted(rows, key=repr)


def fixture():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(m, 0.2) for m in (i % 5, -(i % 3), 0.5, 0)]) for i in range(300)]
    rows += [(7, [0.25, -0.5, 1.0, 0.0])] * 120 + [(None, [0.0, 0.0, 0.0, 1.0])] * 3 + [(i, [0.1] * 4) for i in range(400, 430)]
    rows += [(500, None), (501, []), (502, [1.0, 2.0]), (503, [1.0, None, 0.0, 0.0]), (504, [math.nan] * 4)]
    return rows + [(505, [math.inf, 0.0, 0.0, 0.0]), (506, [1.0] * 5), (507, [-3.0000001] * 4), (7, [9.0] * 4)]


def run(spark, rows, params):
    docs = spark.createDataFrame([(*r, 1, 2, "p", "c") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in clusters(docs, "vec_id", "embedding", params).collect()), key=repr)


def as_float(rows):
    return [(i, None if e is None else [None if v is None else float(np.float32(v)) for v in e]) for i, e in rows]


@pytest.mark.parametrize("k", [1, 8])
def test_equals_the_plain_version(spark, k):
    params = Clustering(k=k, rounds=4, size=4)
    assert run(spark, fixture(), params) == plain(as_float(fixture()), params)


def test_fewer_vectors_than_centroids_and_equal_ones(spark):
    params = Clustering(size=2)
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [2.0, 0.0])]
    assert run(spark, rows, params) == plain(as_float(rows), params)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert clusters(empty, "vec_id", "embedding").collect() == []
    assert run(spark, [(1, None), (2, [0.0])], Clustering()) == []


def test_components_too_large_are_an_error(spark):
    with pytest.raises((ValueError, PythonException), match="2\\^26|would not fit|is 67108864"):
        run(spark, [(1, [1e6] * 4), (2, [0.0] * 4)], Clustering(size=4, rounds=1))


points = st.lists(st.lists(st.integers(-(2**26) + 1, 2**26 - 1), min_size=3, max_size=3), min_size=1, max_size=12)
narrow = st.lists(st.lists(st.integers(-2, 2), min_size=3, max_size=3), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.one_of(points, narrow), st.one_of(points, narrow), st.one_of(points, narrow))
def test_bounds_never_exceed_the_distance(vectors, centroids, pivots):
    vectors, centroids = np.array(vectors, np.int64), np.array(centroids, np.int64)
    fixed = Pivots.of(np.array(pivots, np.int64))
    cached = distances(vectors, fixed.points)
    bound = fixed.lower(cached, distances(centroids, fixed.points))
    exact = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids.tolist()] for v in vectors.tolist()]
    for row, true in zip(bound, exact):
        assert all(b * b * (1 - module.SLACK) <= t for b, t in zip(row.tolist(), true))
    best, least, _ = nearest(vectors, cached, centroids, fixed)
    assert list(zip(best.tolist(), least.tolist())) == [(t.index(min(t)), min(t)) for t in exact]


def test_the_bounds_spare_distances(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(-900, 900, (8, 64))
    vectors = centres[rng.integers(0, 8, 4000)] + rng.integers(-60, 60, (4000, 64))
    fixed = Pivots.of(vectors[:8])
    _, _, done = nearest(vectors, distances(vectors, fixed.points), vectors[8:16], fixed)
    assert done < 0.7 * 8 * len(vectors)
