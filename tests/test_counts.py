"""Distinct counts by bitmaps, and order statistics without ordering."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bitmaps, quantiles
from tidemark.operators.bitmaps import distinct_by_grain, member_bitmaps
from tidemark.operators.quantiles import exact_quantiles, values_at


def visits():
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 30, 22)
    rows = [(start + dt.timedelta(minutes=rng.randrange(6000)), rng.choice(["a", "b", None, "d"]), rng.randrange(400)) for _ in range(3000)]
    return rows + [(None, "a", 1), (None, None, None), (dt.datetime(2025, 1, 1), None, None)]


@pytest.mark.parametrize(("bits", "broadcast"), [(32_768, 10**6), (10, 0)])
def test_distinct_counts_of_every_grain(spark, monkeypatch, bits, broadcast):
    monkeypatch.setattr(bitmaps, "BITS", bits)
    monkeypatch.setattr(bitmaps, "BROADCAST_MEMBERS", broadcast)
    df = spark.createDataFrame(visits(), "t timestamp_ntz, who string, number long").repartition(5)
    want = set()
    for grain in ("hour", "day", "month"):
        parts = df.groupBy(F.date_trunc(grain, "t").cast("timestamp_ntz").alias("p"))
        for r in parts.agg(F.count_distinct("who").alias("a"), F.count_distinct("number").alias("b")).collect():
            want.add((grain, r.p, r.a, r.b))
    got = distinct_by_grain(df, "t", ["who", "number"])
    assert got.columns == ["grain", "period", "who", "number"]
    assert {tuple(r) for r in got.collect()} == want


def test_members_beyond_one_bitmap(spark):
    df = spark.range(100_000).select(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("t"), F.col("id").cast("string").alias("m"))
    got = distinct_by_grain(df.union(df), "t", ["m"], ["day", "year"])
    assert sorted((r.grain, r.m) for r in got.collect()) == [("day", 100_000), ("year", 100_000)]


def test_facts_are_shuffled_once(spark):
    df = spark.createDataFrame(visits(), "t timestamp_ntz, who string, number long")
    plan = member_bitmaps(df, F.date_trunc("hour", "t"), ["who", "number"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan


def test_no_visits(spark):
    empty = spark.createDataFrame([], "t timestamp_ntz, who string")
    assert distinct_by_grain(empty, "t", ["who"]).collect() == []


def plain(rows, columns, probabilities):
    out = set()
    for key in {r[0] for r in rows}:
        for i, c in enumerate(columns, 1):
            v = sorted(float(r[i]) for r in rows if r[0] == key and r[i] is not None)
            for p in probabilities if v else ():
                at = p * (len(v) - 1)
                low, high = v[math.floor(at)], v[math.ceil(at)]
                out.add((key, c, p, len(v), low, high, low if low == high else low + (high - low) * (at - math.floor(at))))
    return out


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_quantiles_of_groups_and_columns(spark, accuracy):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None]), rng.randrange(50), rng.gauss(0, 1e6)) for _ in range(4000)]
    rows += [("x", 7, None)] * 3000 + [("z", None, 1.5), ("w", None, None)]
    df = spark.createDataFrame(rows, "k string, a int, b double").repartition(6)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["a", "b"], ps, by=["k"], accuracy=accuracy)
    assert {tuple(r) for r in got.collect()} == plain(rows, ["a", "b"], ps)
    assert exact_quantiles(df.limit(0), ["a"], ps).collect() == []


def test_positions_in_an_order(spark):
    rng = random.Random(8)
    values = sorted([rng.randrange(10**6) for _ in range(20_000)] + [5] * 9000)
    df = spark.createDataFrame([(v,) for v in rng.sample(values, len(values))], "v long")
    places = [0, 3, 4500, 8999, 14_000, len(values) - 1, len(values), -1]
    got = values_at(df, "v", lambda n: [p if p != len(values) else n for p in places], accuracy=200)
    assert got[-2:] == [None, None]
    assert got[:-2] == [(values[p], p - values.index(values[p])) for p in places[:-2]]
    assert values_at(df.limit(0), "v", lambda n: [n // 2]) == [None]


def test_no_row_is_ranged(spark):
    df = spark.range(50_000).select((F.col("id") % 977).alias("a"))
    plan = exact_quantiles(df, ["a"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and quantiles.ACCURACY == 10_000


def test_brackets_of_few_groups_are_sent_to_the_facts(spark):
    """Else all facts are sorted in as many tasks as there are groups and columns."""
    df = spark.range(50_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 977).alias("a"))
    found = exact_quantiles(df, ["a"], [0.1, 0.5], by=["k"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and all("strategy=broadcast" in line for line in joins)


def test_many_groups_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SENT_ROWS", 10)
    rows = [(i % 40, i) for i in range(4000)]
    got = exact_quantiles(spark.createDataFrame(rows, "k int, a int"), ["a"], [0.5], by=["k"]).collect()
    assert {tuple(r) for r in got} == plain(rows, ["a"], [0.5])
