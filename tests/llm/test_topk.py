"""Exact top-k against all inner products."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.topk import BallTree, Best, Queries, Shard, TopK, search, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, shard int, id string, rank string"


def plain(rows, asked, k, scale):
    kept = [(i, [math.floor(scale * v) for v in e]) for i, e in rows if e is not None and all(v is not None and math.isfinite(v) for v in e)]
    out = []
    for q, (i, e) in enumerate(kept):
        if i is None or not asked(i):
            continue
        scores = [(-sum(a * b for a, b in zip(e, v)), n is None, n or 0, n) for c, (n, v) in enumerate(kept) if c != q]
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def run(spark, rows, **params):
    df = spark.createDataFrame([(*r, 1, 2, "i", "r") for r in rows], SCHEMA).repartition(6)
    found = top_k(df, "vec_id", "embedding", F.col("vec_id") % 5 == 0, TopK(**params))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def fixture():
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [float(np.float32(c + rng.gauss(0, 0.1))) for c in centres[i % 5]]) for i in range(300)]
    rows += [(400 + i, [0.5] * 6) for i in range(60)]  # many equal vectors
    rows += [(405, [0.5] * 6)] * 8 + [(7, [0.25, 0.0, 0.0, 0.0, 0.0, 0.25])] * 3  # repeated rows, also of a query
    rows += [(None, [2.0] * 6), (None, [0.5] * 6), (500, None), (505, [1.0, None]), (510, [math.nan] * 6), (515, [math.inf])]
    return rows + [(520, []), (525, [1.0, 2.0]), (530, [0.5] * 9), (535, [0.0] * 6), (-5, [-0.5] * 6), (540, [1e4, -1e4, 3.0])]


@pytest.mark.parametrize(
    "params",
    [{}, {"leaf": 4, "shard_rows": 32, "together": 3}, {"leaf": 1, "shard_rows": 5, "shard_bytes": 200, "block_queries": 16, "seed_shards": 1}],
)
def test_equals_all_inner_products(spark, params):
    assert run(spark, fixture(), **params) == plain(fixture(), lambda i: i % 5 == 0, 5, 256)


def test_few_rows(spark):
    rows = [(5, [1.0, 1.0]), (6, [2.0, 0.0])]
    assert run(spark, rows) == [(5, 1, 6, 256 * 512)]
    assert run(spark, rows[:1]) == [] and run(spark, rows[1:]) == []


def test_no_rows(spark):
    assert run(spark, [(5, None)]) == []
    assert top_k(spark.createDataFrame([], SCHEMA), "vec_id", "embedding", F.lit(True)).count() == 0


def shard_of(vectors, ids, leaf):
    tree = BallTree(vectors, leaf)
    ids, v = np.array(ids)[tree.order], vectors[tree.order]
    least = np.array([ids[a:b].min() for a, b, *_ in tree.spans.tolist()])
    norm = float(np.sqrt((v**2).sum(axis=1).max()))
    return Shard(9, ids, np.zeros(len(ids), bool), v, tree.spans, tree.centres, tree.radii, least, norm)


numbers = st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=40)


@settings(max_examples=150, deadline=None)
@given(numbers, numbers, st.integers(1, 5))
def test_branch_and_bound_loses_nothing(vectors, asked, leaf):
    vectors = np.array(vectors, float)
    shard = shard_of(vectors, range(len(vectors)), leaf)
    queries = Queries([(1, q, q, np.array(a, float).tobytes()) for q, a in enumerate(asked)])
    best = Best(len(asked), 3, {})
    search(shard, queries, best, 4, False)
    for q, a in enumerate(asked):
        true = sorted((-int(np.dot(a, v)), i) for i, v in enumerate(vectors.tolist()))[:3]
        got = [(-int(s), int(i)) for s, i in zip(best.score[q], best.id[q]) if s > -np.inf]
        assert got == true


def test_bounds_spare_most_of_a_clustered_shard():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 200, (40, 16))
    vectors = np.floor(centres[rng.integers(0, 40, 8000)] + rng.normal(0, 5, (8000, 16)))
    queries = Queries([(1, i, i, v.tobytes()) for i, v in enumerate(vectors[:200])])
    done = search(shard_of(vectors, range(8000), 64), queries, Best(200, 5, {}), 32, False)
    assert done < 0.25 * 200 * 8000
