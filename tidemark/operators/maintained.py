"""Summaries of a partitioned table that are kept beside it and brought up to date from the partitions that changed.

A summary has a few rows for each partition and can be merged, so what an audit states of the whole table is made
from them without reading it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.time import MICROS_PER_HOUR, wall_micros
from tidemark.sources.tables import PARTITIONS, write_partitioned


def of_partitions(df: DataFrame, touched: Sequence[tuple] | None, by: Sequence[str] = PARTITIONS) -> DataFrame:
    """The rows of ``touched`` partitions (values of ``by``), or all."""
    if touched is None:
        return df
    same = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, values)]) for values in touched]
    return df.where(reduce(or_, same, F.lit(False)))


def stretches(df: DataFrame, time: str, by: Sequence[str] = PARTITIONS) -> DataFrame:
    """A row for each day of each partition: (*by, day, first, last, rows, times, gaps), where ``gaps`` counts the steps
    between neighbouring times inside the day. Rows without a time have no part in it. A partition must hold whole
    days, as those of a year and month do."""
    times = df.where(F.col(time).isNotNull()).groupBy(*by, F.col(time).alias("_t")).agg(F.count(F.lit(1)).alias("_rows"))
    day = F.to_date("_t").alias("day")
    within = Window.partitionBy(*by, "day").orderBy("_us")
    steps = times.select(*by, day, wall_micros("_t").alias("_us"), "_rows").withColumn("_gap", F.col("_us") - F.lag("_us").over(within))
    repeats = F.struct(F.lit(0).cast("long").alias("gap"), (F.col("_rows") - 1).alias("pairs"))
    own = F.struct(F.col("_gap").alias("gap"), F.lit(1).cast("long").alias("pairs"))
    pairs = steps.select(*by, "day", F.inline(F.array(own, repeats))).where("gap IS NOT NULL AND pairs > 0")
    pairs = pairs.groupBy(*by, "day", "gap").agg(F.sum("pairs").alias("pairs"))
    gaps = pairs.groupBy(*by, "day").agg(F.collect_list(F.struct("gap", "pairs")).alias("gaps"))
    facts = steps.groupBy(*by, "day").agg(
        F.min("_us").alias("first"), F.max("_us").alias("last"), F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("times")
    )
    keys = [*by, "day"]
    theirs = gaps.toDF(*[f"_{k}" for k in keys], "gaps")
    return facts.join(theirs, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left").select(
        *facts.columns, "gaps"
    )


def granularity_of(days: DataFrame) -> DataFrame:
    """What ``quality.granularity`` says of a table, from the ``stretches`` of its partitions: a row per day comes in,
    and the step between two days is that between the last time of one and the first of the next."""
    one = days.groupBy("day").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"), F.sum("times").alias("times")
    )
    # Days are some hundreds a year, whatever the rows.
    between = one.select((F.col("first") - F.lag("last").over(Window.orderBy("first"))).alias("gap"), F.lit(1).cast("long").alias("pairs"))
    pairs = days.select(F.inline("gaps")).unionByName(between.where("gap IS NOT NULL")).groupBy("gap").agg(F.sum("pairs").alias("pairs"))
    top = pairs.orderBy(F.desc("pairs"), F.asc("gap")).limit(1).collect()
    step = top[0]["gap"] if top and top[0]["gap"] > 0 else MICROS_PER_HOUR
    facts = one.agg(
        F.min("first").alias("lo"), F.max("last").alias("hi"), F.sum("rows").alias("row_count"), F.sum("times").alias("distinct_timestamps")
    ).where("lo IS NOT NULL")
    at = lambda us: (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(us.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")))
    return facts.select(
        at(F.col("lo")).alias("min_timestamp"),
        at(F.col("hi")).alias("max_timestamp"),
        "row_count",
        "distinct_timestamps",
        (F.col("row_count") - F.col("distinct_timestamps")).alias("duplicate_timestamps"),
        F.lit(round(step / 60_000_000, 2)).alias("expected_frequency_minutes"),
        F.greatest(F.floor((F.col("hi") - F.col("lo")) / step) + 1 - F.col("distinct_timestamps"), F.lit(0)).cast("long").alias("missing_timestamp_count"),
    )


def moments(df: DataFrame, columns: Sequence[str], exact: str, by: Sequence[str] = PARTITIONS, groups: Sequence[Column | str] = ()) -> DataFrame:
    """(*by, *groups, column, rows, n, total, squares): of each column the rows, the values that are there, and their exact
    sum and sum of squares as ``exact``, a decimal type."""
    places = int(exact.rstrip(")").split(",")[1])
    value = lambda c: F.col(c).cast(exact)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.count(value(c)).alias("n"), F.sum(value(c)).cast(f"decimal(38,{places})").alias("total"),
                 F.sum((value(c) * value(c)).cast(f"decimal(38,{2 * places})")).cast(f"decimal(38,{2 * places})").alias("squares"))
        for c in columns
    ])
    grouped = df.groupBy(*by, *groups).agg(F.count(F.lit(1)).alias("rows"), cells.alias("_cells"))
    return grouped.select("*", F.inline("_cells")).drop("_cells")


def means_of(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(*groups, column, n, nulls, mean, stddev) from merged ``moments``; NULL where there is no value (or only one)."""
    sums = parts.groupBy(*groups, "column").agg(*[F.sum(c).alias(c) for c in ("rows", "n", "total", "squares")])
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    spread = F.greatest(F.col("squares").cast("double") - total * total / n, F.lit(0.0)) / (n - 1)
    return sums.select(
        *groups, "column", "n", (F.col("rows") - F.col("n")).alias("nulls"), F.when(n > 0, total / n).alias("mean"),
        F.when(n > 1, F.sqrt(spread)).alias("stddev"),
    )


def update_summary(summary: DataFrame, path: str) -> int:
    """Put the summary of some partitions in the place of what is at ``path`` for them; returns its rows."""
    return write_partitioned(summary, path, rebalance=False)
