"""Left joins that widen a spine. Every right side holds one row per key, so row counts never grow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_fold(spine: DataFrame, others: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Join each of ``others`` on the same keys; one hash partitioning serves the whole chain. No
    broadcast is forced: Spark takes it only where the measured size of a side is under its threshold."""
    return reduce(lambda left, right: left.join(right, list(keys), "left"), others, spine)


def attach_daily(
    hourly: DataFrame, dailies: Sequence[DataFrame], time: str = "event_ts", lag_days: int = 0
) -> DataFrame:
    """Give each hour the figures of its day (keyed ``event_date``), or of ``lag_days`` earlier."""
    day = F.date_sub(F.to_date(time), lag_days) if lag_days else F.to_date(time)
    return left_fold(hourly.withColumn("event_date", day), dailies, ["event_date"]).drop("event_date")
