"""Summaries of partitions, brought up to date from those that changed, against the whole table."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.operators.maintained import granularity_of, means_of, moments, of_partitions, stretches, update_summary
from tidemark.sources.tables import read_gold, write_partitioned

SCHEMA = "t timestamp_ntz, v double, w double, year int, month int"


def rows(seed, months=(1, 2, 3)):
    rng = random.Random(seed)
    out = []
    for m in months:
        for _ in range(300):
            t = dt.datetime(2024, m, 1) + dt.timedelta(hours=rng.randrange(28 * 24), microseconds=rng.choice([0, 0, 0, 7]))
            out.append((t, rng.choice([None, rng.randrange(-1000, 1000) / 100]), 2.5, 2024, m))
    return out + [(None, 1.0, None, 2024, months[0])]


def same_granularity(days, df):
    got, want = granularity_of(days).collect(), Q.granularity(df, "t").collect()
    drop = lambda r: {k: v for k, v in r.asDict().items() if k not in ("row_count",)}
    assert [drop(r) for r in got] == [drop(r) for r in want]
    assert [r["row_count"] for r in got] == [df.where("t IS NOT NULL").count()] * len(got)


def test_granularity_after_a_partition_changed(spark, tmp_path):
    data, summary = str(tmp_path / "t"), str(tmp_path / "s")
    write_partitioned(spark.createDataFrame(rows(1), SCHEMA), data)
    update_summary(stretches(read_gold(spark, data), "t"), summary)
    same_granularity(read_gold(spark, summary), read_gold(spark, data).where("t IS NOT NULL"))
    february = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("month=1/*.parquet")}
    write_partitioned(spark.createDataFrame(rows(2, (2,)), SCHEMA), data)
    changed = of_partitions(read_gold(spark, data), [(2024, 2)])
    assert {r.month for r in changed.select("month").distinct().collect()} == {2}
    update_summary(stretches(changed, "t"), summary)
    same_granularity(read_gold(spark, summary), read_gold(spark, data).where("t IS NOT NULL"))
    assert february and all(p.stat().st_mtime_ns == at for p, at in february.items())


def test_only_touched_partitions_are_scanned(spark, tmp_path):
    write_partitioned(spark.createDataFrame(rows(1), SCHEMA), str(tmp_path))
    plan = of_partitions(read_gold(spark, str(tmp_path)), [(2024, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PartitionFilters: []" not in plan


@pytest.mark.parametrize("one", [[], [(dt.datetime(2024, 1, 1), 1.0, None, 2024, 1)]])
def test_few_rows(spark, one):
    df = spark.createDataFrame(one, SCHEMA)
    assert len(granularity_of(stretches(df, "t")).collect()) == len(one)
    same_granularity(stretches(df, "t"), df)


def test_means_after_a_partition_changed(spark, tmp_path):
    data, summary = str(tmp_path / "t"), str(tmp_path / "s")
    for seed, months in ((1, (1, 2, 3)), (2, (2,))):
        write_partitioned(spark.createDataFrame(rows(seed, months), SCHEMA), data)
        changed = of_partitions(read_gold(spark, data), [(2024, m) for m in months])
        update_summary(moments(changed, ["v", "w"], "decimal(18,2)", groups=[F.dayofmonth("t").alias("d")]), summary)
    got = {(r.month, r.column): r for r in means_of(read_gold(spark, summary), ["month"]).collect()}
    whole = read_gold(spark, data).collect()
    for (month, column), r in got.items():
        values = [x[column] for x in whole if x.month == month]
        there = [v for v in values if v is not None]
        assert (r.n, r.nulls) == (len(there), len(values) - len(there))
        assert r.mean == pytest.approx(statistics.mean(there)) and r.stddev == pytest.approx(statistics.stdev(there))
    assert len(got) == 6
