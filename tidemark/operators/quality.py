"""Data-quality summaries. Each result is section-sized (columns, months or splits), never row-sized."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.naming import drop_other_labels, label_columns
from tidemark.functions.numeric import nan_to_null, numeric_columns, round_even
from tidemark.functions.time import MICROS_PER_HOUR, to_wall_clock, wall_micros
from tidemark.operators.ordering import boundaries, latest_rows, neighbour_gaps, ordered_blocks, sorts_before

SPLITS = ("train", "validation", "test")


def audit_input(df: DataFrame, time: str, label: str, latest: int = 0) -> DataFrame:
    """The rows an audit looks at: parseable time, label present, other labels gone, NaN as NULL, and
    only the ``latest`` rows if that is above 0."""
    clean = nan_to_null(drop_other_labels(df, label))
    clean = clean.withColumn(time, to_wall_clock(time)).dropna(subset=[time, label])
    return latest_rows(clean, latest, [time]) if latest > 0 else clean


def feature_columns(df: DataFrame, label: str) -> list[str]:
    """Numeric columns that are not labels."""
    names = [c for c in numeric_columns(df) if c != label and c not in label_columns(df.columns)]
    if not names:
        raise ValueError("no numeric feature columns are left")
    return names


def null_counts(df: DataFrame) -> Column:
    """Aggregate: an array of (column, null_count), NaNs counted as NULLs."""
    counts = []
    for f in df.schema:
        gone = F.col(f"`{f.name}`").isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            gone = gone | F.isnan(f"`{f.name}`")
        counts.append(F.struct(F.lit(f.name).alias("column"), F.count_if(gone).alias("null_count")))
    return F.array(*counts)


def ranked_nulls(counts: DataFrame, top: int | None = None) -> DataFrame:
    """From one row (_rows, _nulls: see ``null_counts``), a row per column, most affected first."""
    share = F.try_divide(F.col("null_count").cast("double"), F.col("_rows").cast("double"))
    profile = counts.select("_rows", F.inline("_nulls")).select(
        "column", "null_count", round_even(share * 100, 2).alias("null_pct")
    )
    # one row comes in, so its columns are one partition and need no shuffle to be sorted
    ranked = profile.coalesce(1).sortWithinPartitions(F.desc("null_pct"), F.desc("null_count"), "column")
    return ranked.limit(top) if top else ranked


def null_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """NULLs (and NaNs) per column with their percentage, most affected first. One pass, one row per
    task to merge."""
    return ranked_nulls(df.agg(F.count(F.lit(1)).alias("_rows"), null_counts(df).alias("_nulls")), top)


def granularity(df: DataFrame, time: str) -> DataFrame:
    """One row: range, distinct and duplicate timestamps, the most common step and how many steps of the
    range are missing. The step is one hour when there is no positive most common one."""
    # The table is read once; everything else works on its distinct times.
    counts = df.groupBy(time).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_us", wall_micros(time))
    per_time = ordered_blocks(counts, ["_us"])
    top = neighbour_gaps(per_time, "_us", "_copies").orderBy(F.desc("pairs"), F.asc("gap")).limit(1).collect()
    step = top[0]["gap"] if top and top[0]["gap"] > 0 else MICROS_PER_HOUR

    facts = per_time.agg(
        F.min(time).alias("min_timestamp"),
        F.max(time).alias("max_timestamp"),
        F.sum("_copies").alias("row_count"),
        F.count(time).alias("distinct_timestamps"),
        F.sum(F.when(F.col(time).isNotNull(), F.col("_copies") - 1)).alias("duplicate_timestamps"),
    ).where("min_timestamp IS NOT NULL")
    span = wall_micros("max_timestamp") - wall_micros("min_timestamp")
    expected = F.floor(span / F.lit(step)) + 1
    return facts.withColumns({
        "expected_frequency_minutes": F.lit(round(step / 60_000_000, 2)),
        "missing_timestamp_count": F.greatest(expected - F.col("distinct_timestamps"), F.lit(0)).cast("long"),
    })


def check_split_sizes(validation: float, test: float) -> None:
    if validation <= 0 or test <= 0:
        raise ValueError("validation and test shares must be above 0")
    if validation + test >= 1:
        raise ValueError("validation and test shares must add up to less than 1")


def temporal_split(
    df: DataFrame, order: Sequence[str], validation: float = 0.15, test: float = 0.15, alias: str = "split"
) -> DataFrame:
    """Tag rows train / validation / test by position in ``order`` (a time column that is not NULL, then
    any tie-breaks).

    Only the two boundary keys are looked up; the rows themselves are tagged where they are, by
    comparison with those keys, so the table is neither sorted nor shuffled.
    """
    check_split_sizes(validation, test)

    def cuts(rows: int) -> list[int]:
        return [math.floor(rows * (1 - validation - test)), math.floor(rows * (1 - test))]

    found = boundaries(df, order, cuts)
    # A cut always lies inside a table that has rows, because both shares are above 0.
    if None in found:
        return df.withColumn(alias, F.lit(SPLITS[0]))
    first, second = (sorts_before(df, b) for b in found)
    return df.withColumn(alias, F.when(first, SPLITS[0]).when(second, SPLITS[1]).otherwise(SPLITS[2]))


def split_facts(time: str, split: str = "split") -> Column:
    """Aggregate: an array of rows, start and end per split."""
    facts = []
    for name in SPLITS:
        mine = F.col(split) == name
        facts.append(
            F.struct(
                F.lit(name).alias(split),
                F.count_if(mine).alias("rows"),
                F.min(F.when(mine, F.col(time))).alias("start"),
                F.max(F.when(mine, F.col(time))).alias("end"),
            )
        )
    return F.array(*facts)


def split_summary(df: DataFrame, time: str, split: str = "split") -> DataFrame:
    """Rows, start and end of each split; a split without rows is listed with 0."""
    return df.agg(split_facts(time, split).alias("_splits")).select(F.inline("_splits"))


def means_by_split(columns: Sequence[str], split: str = "split") -> Column:
    """Aggregate: an array of the columns' means per split that has rows."""
    means = []
    for name in SPLITS:
        mine = F.col(split) == name
        of = [F.round(F.avg(F.when(mine, F.col(c))), 6).alias(c) for c in columns]
        means.append(F.struct(F.lit(name).alias(split), *of, F.count_if(mine).alias("_n")))
    return F.filter(F.array(*means), lambda m: m["_n"] > 0)


def split_means(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(*[F.round(F.avg(c), 6).alias(c) for c in columns])


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in dict.fromkeys(wanted) if c in df.columns]


def monthly_means(df: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each column per calendar month ``yyyy-MM``."""
    return df.groupBy(F.date_format(time, "yyyy-MM").alias("event_month")).agg(*[F.avg(c).alias(c) for c in columns])


def latest_months(monthly: DataFrame, columns: Sequence[str], months: int = 12) -> DataFrame:
    rounded = monthly.select("event_month", *[F.round(c, 6).alias(c) for c in columns])
    return rounded.orderBy(F.desc("event_month")).limit(months)


def monthly_changes(monthly: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per metric and month: the mean, the mean of the previous month that has rows, and the change in
    percent (absent when that mean is 0 or NULL). Months bound the size of every window partition."""
    long = monthly.unpivot("event_month", list(columns), "metric", "current_mean")
    by_metric = Window.partitionBy("metric").orderBy("event_month")
    change = F.try_divide(F.col("current_mean") - F.col("previous_mean"), F.col("previous_mean")) * 100
    return (
        long.withColumn("previous_mean", F.lag("current_mean").over(by_metric))
        .withColumn("change_pct", change)
        .withColumn("abs_change_pct", F.abs("change_pct"))
        .dropna(subset=["change_pct"])
    )


def largest_changes(changes: DataFrame, top: int = 10) -> DataFrame:
    ranked = changes.orderBy(F.desc("abs_change_pct"), "metric", "event_month").limit(top)
    numbers = ["current_mean", "previous_mean", "change_pct", "abs_change_pct"]
    return ranked.select("event_month", "metric", *[F.round(c, 6).alias(c) for c in numbers])
