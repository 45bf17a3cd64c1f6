import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.operators.ordering import (
    Boundary,
    boundaries,
    keys_at,
    latest_rows,
    neighbour_gaps,
    row_position,
    sorts_before,
)


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of the rows share one time."""
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=50 if i % 3 == 0 else rnd.randrange(100)), i) for i in range(3000)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "t timestamp_ntz, id long").repartition(5), sorted(rows)


@pytest.mark.parametrize("blocks", [1, 4, 16, None])
def test_positions_are_the_sorted_order(crowded, blocks):
    df, rows = crowded
    got = row_position(df, ["t", "id"], blocks=blocks).orderBy("position").collect()
    assert [(r.t, r.id) for r in got] == rows
    assert [r.position for r in got] == list(range(len(rows)))


def test_keys_at_positions(crowded):
    df, rows = crowded
    found = keys_at(df, ["t", "id"], lambda n: [0, n // 2, n - 1, n, -1])
    assert [None if b is None else tuple(b.key) for b in found] == [rows[0], rows[1500], rows[-1], None, None]
    assert [b.inside for b in found[:3]] == [0, 0, 0]


@pytest.mark.parametrize("blocks", [1, 5])
def test_keys_at_counts_rows_of_the_key_before_the_position(crowded, blocks):
    df, rows = crowded
    places = list(range(0, 3000, 250))
    for p, b in zip(places, keys_at(df, ["t"], lambda n: places, blocks)):
        t = rows[p][0]
        assert (b.key.t, b.inside) == (t, p - [r[0] for r in rows].index(t))


def test_boundaries_refine_only_the_tied_rows(crowded):
    df, rows = crowded
    for p, b in zip((10, 1500), boundaries(df, ["t"], lambda n: [10, 1500])):
        assert df.where(sorts_before(df, b)).count() == p


def test_sorts_before_with_null_tie_break(spark):
    rows = [(1, None), (1, "a"), (1, "b"), (2, None)]
    df = spark.createDataFrame(rows, "a int, b string")
    for i, key in enumerate(df.collect()):
        assert df.where(sorts_before(df, Boundary(("a", "b"), key, 0))).count() == i


@pytest.mark.parametrize("n", [1, 700, 1500, 2999, 3000, 5000])
def test_latest_rows_are_exactly_the_last(crowded, n):
    df, rows = crowded
    assert sorted(map(tuple, latest_rows(df, n, ["t", "id"]).collect())) == rows[-n:]
    # Ties on the given order fall back on the other columns.
    assert sorted(map(tuple, latest_rows(df, n, ["t"]).collect())) == rows[-n:]


def test_latest_rows_with_equal_rows_and_nulls(spark):
    rows = [(1, 5), (1, 3), (1, 9), (0, 1), (None, 4), (2, 7), (2, 7), (2, 7), (2, 7), (2, None)]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    ordered = sorted(rows, key=key)
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "k int, v int").repartition(parts)
        for n in range(12):
            got = latest_rows(df, n, ["k"]).collect()
            assert sorted(map(tuple, got), key=key) == (ordered[-n:] if n else [])


def test_positions_do_not_depend_on_the_layout(spark):
    """Rows tied on the order, and rows equal in all columns, get the same numbers in every run."""
    rows = [(i % 5 if i % 11 else None, i % 40, f"x{i % 3}") for i in range(600)]
    seen = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "a int, b int, c string").repartition(parts)
        got = row_position(df, ["a"]).orderBy("position").collect()
        assert [r.position for r in got] == list(range(600))
        assert [r.a is not None and r.a for r in got] == sorted(r[0] is not None and r[0] for r in rows)
        seen.add(tuple(map(tuple, got)))
    assert len(seen) == 1


def test_positions_pin_the_order_columns_only(spark, monkeypatch):
    pinned = []
    keep = ordering.pin
    monkeypatch.setattr(ordering, "pin", lambda df: pinned.append(df.columns) or keep(df))
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 10).alias("wide"), F.col("id").alias("other"))
    assert row_position(df, ["id"]).count() == 100
    assert pinned[0] == ["_o0", "_g", "_rows", "_block"]


def test_small_ranges_are_merged_in_order(spark):
    """Many ranges of few bytes become few blocks, and a table of many bytes keeps many."""
    settings = {
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        for rows, few in ((100, True), (100_000, False)):
            df = spark.range(rows).select((F.col("id") * 7919 % rows).alias("v"))
            blocked = ordering.ordered_blocks(df, ["v"])
            ranges = blocked.groupBy("_block").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_block").collect()
            assert (len(ranges) < 3) if few else (10 < len(ranges) <= 50)
            assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
            out = row_position(df, ["v"])
            assert out.where("position != v").count() == 0 and out.count() == rows
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_empty_table(spark):
    df = spark.createDataFrame([], "t timestamp_ntz, id long")
    assert row_position(df, ["t"]).count() == 0
    assert keys_at(df, ["t"], lambda n: [0]) == [None]
    blocked = ordering.ordered_blocks(df.groupBy("id").count(), ["id"])
    assert neighbour_gaps(blocked, "id", "count").count() == 0


@pytest.mark.parametrize("blocks", [1, 3, 20])
def test_gaps_against_brute_force(spark, blocks):
    rnd = random.Random(5)
    values = [rnd.randrange(60) for _ in range(200)] + [500, 1000, 1000]
    want = {}
    ordered = sorted(values)
    for a, b in zip(ordered, ordered[1:]):
        want[b - a] = want.get(b - a, 0) + 1
    counts = spark.createDataFrame([(v,) for v in [*values, None, None]], "v long").groupBy("v").count()
    got = neighbour_gaps(ordering.ordered_blocks(counts, ["v"], blocks), "v", "count")
    assert {r.gap: r.pairs for r in got.collect()} == want


def test_a_crowded_stretch_is_split(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("t"), "id")
    out = row_position(df, ["t"], blocks=8)
    assert [r.t for r in out.orderBy("position").collect()] == sorted(r.t for r in df.collect())
    assert out.select("position").distinct().count() == 20_000
    keys = df.groupBy("t", F.xxhash64("t", "id").alias("h")).count()
    sizes = [r["count"] for r in ordering.ordered_blocks(keys, ["t", "h"], 8).groupBy("_block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
