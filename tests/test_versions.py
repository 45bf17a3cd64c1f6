import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numeric import version_rank
from tidemark.operators.versions import VERSION_PRIORITY, LatestTable, latest_version


def versions(spark, rows, columns="k string, version string, v int"):
    return spark.createDataFrame(rows, columns)


def test_s1_rank_order_and_unknown_codes(spark):
    rows = [("txr", 9), ("TXF", 8), ("TX7", 7), ("Tx1", 1), ("TX0", 0), ("ZZ", 0), (None, 0)]
    df = spark.createDataFrame(rows, "version string, want int")
    got = df.select("want", version_rank("version", VERSION_PRIORITY).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)


def test_s1_best_version_wins_whatever_its_case(spark):
    df = versions(spark, [("a", "TX1", 1), ("a", "txr", 2), ("a", "TXF", 3), ("a", "ZZ", 4), ("a", None, 5)])
    assert latest_version(df, ["k"]).collect() == [("a", "txr", 2)]


def test_s1_priority_is_a_parameter(spark):
    df = versions(spark, [("a", "draft", 1), ("a", "final", 2)])
    assert latest_version(df, ["k"], priority=("draft", "final")).first()["v"] == 1


def test_s2_tie_breaks(spark):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = "k string, version string, processed_at timestamp, source_file string, v int"
    df = spark.createDataFrame(
        [
            ("a", "TX1", old, "z", 1),
            ("a", "TX1", new, "a", 2),
            ("a", "TX1", new, "b", 3),
            ("a", "TX1", None, "c", 4),
            ("a", "TX1", new, None, 5),
            ("b", "YY", new, "f", 6),
            ("b", "zz", new, "f", 7),
            ("b", None, new, "f", 8),
        ],
        schema,
    )
    got = {r["k"]: r["v"] for r in latest_version(df, ["k"]).collect()}
    assert got == {"a": 3, "b": 7}


def test_s2_processing_time_as_text(spark):
    rows = [("a", "TX1", "2024-01-01 9:00:00", 1), ("a", "TX1", "2024-01-01 10:00:00", 2), ("a", "TX1", "never", 3)]
    df = spark.createDataFrame(rows, "k string, version string, processed_at string, v int")
    assert latest_version(df, ["k"]).first()["v"] == 2


def test_s2_caller_tie_break_makes_it_deterministic(spark):
    df = versions(spark, [("a", "TX1", n) for n in range(50)]).repartition(7)
    assert latest_version(df, ["k"], tie_break=["v"]).first()["v"] == 0


def test_s3_missing_keys(spark):
    df = versions(spark, [("a", "TX1", 1), ("a", "TX2", 2)])
    with pytest.warns(UserWarning, match="gone"):
        assert latest_version(df, ["k", "gone"]).count() == 1
    assert latest_version(df, ["gone"]).count() == 2
    assert latest_version(df.drop("version"), ["k"]).count() == 2


def test_null_keys_form_one_group(spark):
    df = versions(spark, [(None, "TX1", 1), (None, "TX2", 2)])
    assert [r["v"] for r in latest_version(df, ["k"]).collect()] == [2]


def test_one_row_per_key_with_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"),
        F.concat(F.lit("TX"), F.col("id") % 8).alias("version"),
        "id",
    )
    out = latest_version(df, ["k"], tie_break=["id"])
    assert out.count() == df.select("k").distinct().count() == out.select("k").distinct().count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Rows of a key are cut down before the shuffle as well as after it.
    assert plan.count("WindowGroupLimit") == 2


def exchange_free_side(df):
    """The plan from the join down to the table's scan; a shuffle there is an error."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("SortMergeJoin") :]
    plan = plan[: plan.index("PartitionFilters")]
    assert "FileScan" in plan and "Exchange" not in plan
    return plan


def test_drops_taken_into_a_bucketed_table_equal_one_run_over_all(spark, tmp_path):
    rng = random.Random(3)
    keys = [("a", 1)] * 300 + [(rng.choice("abcd"), rng.randrange(12)) for _ in range(200)] + [(None, 1), ("a", None), (None, None)] * 5
    rng.shuffle(keys)
    rows = [(*k, rng.choice(["TX1", "txr", "TXF", "ZZ", None]), rng.choice(["f1", "f2", None]), n) for n, k in enumerate(keys)]
    df = versions(spark, rows, "k string, j int, version string, source_file string, v long")
    table = LatestTable("latest_in_buckets", ("k", "j"), 4, tie_break=("v",))
    want = sorted(latest_version(df, ["k", "j"], tie_break=("v",)).collect(), key=repr)
    table.create(df.where("v < 200"), str(tmp_path / "0"))
    old = table.take(df.where("v between 200 and 399").select("v", "version", "source_file", "j", "k"), str(tmp_path / "1"))
    assert old.endswith("/0") and not (tmp_path / "1" / "_temporary").exists()
    after = table.with_drop(df.where("v >= 400"))
    assert sorted(after.collect(), key=repr) == want
    assert sorted(table.with_drop(df).collect(), key=repr) == want  # taking rows again changes nothing
    assert table.with_drop(df.limit(0)).count() == spark.table(table.table).count()
    # the table's scan is bucketed and reaches the join without a shuffle
    plan = exchange_free_side(after)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    with pytest.raises(ValueError, match="extra"):
        table.with_drop(df.withColumn("extra", F.lit(1)))
