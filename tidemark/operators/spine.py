"""A dense time index, so that gaps become rows and row offsets mean hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


CHUNK_STEPS = 1024


def dense_spine(
    df: DataFrame,
    time: str = "event_ts",
    step: str = "1 hour",
    series_keys: Sequence[str] = (),
) -> DataFrame:
    """Every step between the first and last ``time``, per series when ``series_keys`` are given.

    Lazy: the bounds are a min/max aggregate with a map-side combine, not values fetched to the driver.
    No rows in, no rows out. The range is cut into chunks that are spread over tasks before they are
    expanded, so neither the spine nor what is joined to it sits in one partition. ``step`` is a fixed
    length of time (weeks down to microseconds).
    """
    one = F.expr(f"INTERVAL {step}")
    bounds = df.groupBy(*series_keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    chunks = bounds.where("_first IS NOT NULL").select(
        *series_keys, "_last", F.explode(F.sequence("_first", "_last", one * CHUNK_STEPS)).alias("_from")
    )
    upto = F.least(F.col("_from") + one * (CHUNK_STEPS - 1), F.col("_last"))
    steps = F.explode(F.sequence(F.col("_from"), upto, one))
    return chunks.repartition(*series_keys, "_from").select(*series_keys, steps.alias(time))


def on_spine(
    df: DataFrame,
    time: str = "event_ts",
    step: str = "1 hour",
    series_keys: Sequence[str] = (),
    bounds_of: DataFrame | None = None,
) -> DataFrame:
    """``df`` with a row for every missing step; ``df`` must hold one row per (series, time).

    ``bounds_of`` may name a cheaper frame with the same first and last times, such as the raw rows that
    ``df`` was aggregated from.
    """
    spine = dense_spine(df if bounds_of is None else bounds_of, time, step, series_keys)
    return spine.join(df, [*series_keys, time], "left")
