import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as Q

START = dt.datetime(2024, 1, 1)


def times(spark, ts):
    return spark.createDataFrame([(t,) for t in ts], "event_ts timestamp_ntz")


def test_null_profile_counts_nan_and_orders(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, None), (2, None, None), (3, 1.0, None)], "a int, b double, `c.d` string")
    got = [tuple(r) for r in Q.null_profile(df).collect()]
    assert got == [("c.d", 3, 100.0), ("b", 2, 66.67), ("a", 0, 0.0)]
    assert Q.null_profile(df, top=1).count() == 1


def test_granularity_of_an_hourly_series(spark):
    ts = [START + dt.timedelta(hours=i) for i in range(48) if i not in (5, 6)] + [START]
    r = Q.granularity(times(spark, ts), "event_ts").first()
    assert (r.min_timestamp, r.max_timestamp) == (START, START + dt.timedelta(hours=47))
    assert (r.row_count, r.distinct_timestamps, r.duplicate_timestamps) == (47, 46, 1)
    assert (r.expected_frequency_minutes, r.missing_timestamp_count) == (60.0, 2)


@pytest.mark.parametrize(
    "minutes, step, missing",
    [([0], 60.0, 0), ([0, 0, 0, 15], 60.0, 0), ([0, 10, 20, 50, 80], 10.0, 4), ([0, 30, 45], 15.0, 1)],
)
def test_granularity_step(spark, minutes, step, missing):
    """One time, mostly repeats, a clear winner, and a tie that the smaller step wins."""
    r = Q.granularity(times(spark, [START + dt.timedelta(minutes=m) for m in minutes]), "event_ts").first()
    assert (r.expected_frequency_minutes, r.missing_timestamp_count) == (step, missing)


def test_granularity_without_times(spark):
    assert Q.granularity(times(spark, [None]), "event_ts").count() == 0


@pytest.mark.parametrize("validation, test", [(0, 0.1), (0.1, 0), (0.5, 0.5), (-0.1, 0.2), (0.9, 0.2)])
def test_split_sizes_are_checked(validation, test):
    with pytest.raises(ValueError):
        Q.check_split_sizes(validation, test)


@pytest.mark.parametrize("n, validation, test", [(1, 0.15, 0.15), (7, 0.15, 0.15), (100, 0.2, 0.3), (1000, 0.15, 0.15)])
def test_split_is_chronological_complete_and_exact(spark, n, validation, test):
    ts = [START + dt.timedelta(hours=i) for i in range(n)]
    random.Random(1).shuffle(ts)
    out = Q.temporal_split(times(spark, ts), ["event_ts"], validation, test).orderBy("event_ts").collect()
    a, b = math.floor(n * (1 - validation - test)), math.floor(n * (1 - test))
    assert [r.split for r in out] == ["train"] * a + ["validation"] * (b - a) + ["test"] * (n - b)


def test_split_cuts_through_equal_times(spark):
    """All rows at one time: the other columns decide, and the sizes stay exact."""
    df = spark.range(1000).select(F.lit(START).cast("timestamp_ntz").alias("event_ts"), "id")
    out = Q.temporal_split(df, ["event_ts"])
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {
        "train": 700, "validation": 150, "test": 150,
    }


def test_split_summary_lists_empty_splits(spark):
    df = Q.temporal_split(times(spark, [START]), ["event_ts"])
    got = {r["split"]: tuple(r)[1:] for r in Q.split_summary(df, "event_ts").collect()}
    assert got == {"train": (0, None, None), "validation": (0, None, None), "test": (1, START, START)}


def test_split_means(spark):
    df = spark.createDataFrame([("train", 1.0), ("train", 2.0), ("test", None)], "split string, x double")
    assert {r["split"]: r["x"] for r in Q.split_means(df, ["x"]).collect()} == {"train": 1.5, "test": None}


def test_monthly_changes_skip_absent_and_zero_months(spark):
    rows = [("2024-01-05", 10.0), ("2024-01-06", 20.0), ("2024-03-01", 30.0), ("2024-04-01", 0.0), ("2024-05-01", 5.0),
            ("2024-06-01", None), ("2024-07-01", 4.0)]
    df = spark.createDataFrame(rows, "d string, x double").withColumn("t", F.to_date("d"))
    monthly = Q.monthly_means(df, "t", ["x"])
    got = [tuple(r) for r in Q.largest_changes(Q.monthly_changes(monthly, ["x"])).collect()]
    # March follows January; May follows a zero mean; June and July lack a mean on one side.
    assert got == [("2024-03", "x", 30.0, 15.0, 100.0, 100.0), ("2024-04", "x", 0.0, 30.0, -100.0, 100.0)]
    assert [r.event_month for r in Q.latest_months(monthly, ["x"], 2).collect()] == ["2024-07", "2024-06"]


def test_audit_input(spark):
    nan = float("nan")
    rows = [("2024-01-01 00:00:00", 1.0, 1.0), ("x", 1.0, 1.0), ("2024-01-03", nan, 1.0), ("2024-01-02", 2.0, None)]
    df = spark.createDataFrame(rows, "event_ts string, label_a double, label_b double")
    out = Q.audit_input(df, "event_ts", "label_a")
    assert out.columns == ["event_ts", "label_a"]
    assert [r.label_a for r in out.orderBy("event_ts").collect()] == [1.0, 2.0]
    assert [r.label_a for r in Q.audit_input(df, "event_ts", "label_a", latest=1).collect()] == [2.0]


def test_feature_columns(spark):
    schema = "t timestamp_ntz, a int, label_x double, label_y double, s string, b boolean"
    df = spark.createDataFrame([(START, 1, 1.0, 2.0, "x", True)], schema)
    assert Q.feature_columns(df, "label_x") == ["a"]
    with pytest.raises(ValueError):
        Q.feature_columns(df.select("t", "label_x"), "label_x")
    assert Q.present(df, ["a", "zz", "a"]) == ["a"]
