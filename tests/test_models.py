import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import models as M


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3)) * [1.0, 50.0, 0.01] + [5.0, -3.0, 0.0]
    y = x @ [2.0, -0.1, 30.0] + rng.normal(size=300) + 7
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double"), x, y


def test_medians(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, *range(9)]), rnd.uniform(0, 1), 7 if i % 3 else i, None) for i in range(501)]
    df = spark.createDataFrame(rows, "a int, b double, hot int, none double")
    got = M.exact_medians(df, ["a", "b", "hot", "none"])
    want = {c: statistics.median(v for r in rows if (v := r[i]) is not None) for i, c in enumerate(["a", "b", "hot"])}
    assert got == want


def test_fill_with(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0)], "a int, b double")
    assert [tuple(r) for r in M.fill_with(df, {"a": 9, "b": 0.5}).collect()] == [(1.0, 0.5), (9.0, 2.0)]


def test_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, constant double")
    out = M.scale(df, M.fit_scale(df, ["a", "constant"]))
    assert [tuple(r) for r in out.collect()] == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_equals_the_closed_form(sample, alpha):
    df, x, y = sample
    model = M.fit_ridge(M.assemble(df, ["a", "b", "c"]), "y", "p", alpha)
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
    want = z @ beta + y.mean()
    got = [r.p for r in model.transform(M.assemble(df, ["a", "b", "c"])).collect()]
    assert np.allclose(sorted(got), sorted(want), rtol=1e-10)


def test_ridge_with_a_constant_feature_and_label(spark):
    df = spark.createDataFrame([(float(i), 1.0, 4.0) for i in range(10)], "a double, k double, y double")
    ready = M.assemble(df, ["a", "k"])
    assert {round(r.p, 9) for r in M.fit_ridge(ready, "y", "p").transform(ready).collect()} == {4.0}


def test_forest_fits(sample):
    df, _, y = sample
    ready = M.assemble(df, ["a", "b", "c"])
    params = M.ForestParams(trees=5)
    model = M.fit_forest(ready, "y", "p", params)
    assert model.getNumTrees == 5 and model.getMaxDepth() == 14 and model.getMinInstancesPerNode() == 2
    scores = M.regression_metrics(model.transform(ready).withColumn("split", F.lit("train")), "y", {"f": "p"}).first()
    assert scores.r2 > 0.6


def test_forest_does_not_depend_on_the_layout(sample, monkeypatch):
    df, _, _ = sample
    ready = M.assemble(df, ["a", "b", "c"])
    monkeypatch.setattr(M, "ROWS_PER_BLOCK", 100)
    monkeypatch.setattr(M.laid_out_by, "__defaults__", (100,))
    sums = set()
    for parts in (1, 4, 7):
        model = M.fit_forest(ready.repartition(parts), "y", "p", M.ForestParams(trees=5), ["a"])
        sums.add(round(sum(sorted(r.p for r in model.transform(ready).collect())), 9))
    assert len(sums) == 1


def test_stock_forest_size():
    assert M.ForestParams() == M.ForestParams(trees=300, depth=14, min_leaf=2, seed=42)


def test_naive_column():
    label = "label_target_x_h_plus_24"
    assert M.naive_column(label, ["target_x", "target_x_lag_24h"]) == "target_x"
    assert M.naive_column(label, ["target_x_lag_24h"]) == "target_x_lag_24h"
    assert M.naive_column(label, ["other"]) is None
    assert M.naive_column("y", ["y"]) is None


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=50) + 3, rng.normal(size=50) + 3
    y[0] = 0.0
    rows = [("test", float(a), float(b)) for a, b in zip(y, p)] + [("test", None, 1.0), ("test", 1.0, None)]
    r = M.regression_metrics(spark.createDataFrame(rows, "split string, y double, p double"), "y", {"m": "p"}).first()
    e = y - p
    assert r.pairs == 50
    assert r.mae == pytest.approx(np.abs(e).mean(), abs=1e-6)
    assert r.rmse == pytest.approx((e**2).mean() ** 0.5, abs=1e-6)
    assert r.r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-6)
    assert r.mape_pct == pytest.approx(np.mean(np.abs(e[1:] / y[1:])) * 100, abs=1e-6)


@pytest.mark.parametrize(
    "rows, r2, mape",
    [([(2.0, 2.0), (2.0, 2.0)], 1.0, 0.0), ([(2.0, 3.0), (2.0, 3.0)], 0.0, 50.0), ([(0.0, 1.0)], None, None)],
)
def test_metrics_of_constant_or_single_actuals(spark, rows, r2, mape):
    df = spark.createDataFrame([("test", *r) for r in rows], "split string, y double, p double")
    got = M.regression_metrics(df, "y", {"m": "p"}).first()
    assert (got.r2, got.mape_pct) == (r2, mape)
