"""Wall-clock time expressions on ``timestamp_ntz``.

All of them avoid the session time zone, so a series has no daylight-saving gaps or repeats. Bad text
becomes NULL instead of failing the job, with ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000

# A time of day followed by Z, UTC, an offset or a region.
OFFSET = r"(?i):\d{2}(\.\d*)?\s*(z|(utc|gmt|ut)([+-]\d{1,2}(:?\d{2}){0,2})?|[+-]\d{1,2}(:?\d{2}){0,2}|[a-z_]+/[a-z_/]+)\s*$"


def to_wall_clock(column: str | Column) -> Column:
    """Timestamp (any kind) or text -> ``timestamp_ntz``; NULL where the text is not a timestamp.

    Text without an offset is the wall clock as written. Text with one is an instant, given as UTC. Only a
    column of type TIMESTAMP, an instant already, is shown as the session's zone shows it.
    """
    c = F.col(column) if isinstance(column, str) else column
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.unix_micros(c.try_cast("timestamp"))
    rest = F.pmod(micros, F.lit(86_400_000_000))
    day = ((micros - rest) / 86_400_000_000).cast("int")
    seconds = (rest.cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    utc = epoch + F.make_dt_interval(day, F.lit(0), F.lit(0), seconds)
    text = F.when(c.cast("string").rlike(OFFSET), utc).otherwise(c.try_cast("timestamp_ntz"))
    # The test on the type is a constant to the optimizer.
    return F.when(F.typeof(c) == "string", text).otherwise(c.try_cast("timestamp_ntz"))


def to_day(column: str | Column) -> Column:
    """Date, timestamp or text -> ``date``; NULL where the text is not a date."""
    c = F.col(column) if isinstance(column, str) else column
    return c.try_cast("date")


def hour_floor(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(c))


def wall_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the same wall clock."""
    c = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    second = F.date_part(F.lit("SECOND"), c)
    return (
        days * F.lit(24 * MICROS_PER_HOUR)
        + F.hour(c).cast("long") * F.lit(MICROS_PER_HOUR)
        + F.minute(c).cast("long") * F.lit(60_000_000)
        + (second * F.lit(1_000_000)).cast("long")
    )


def hour_index(ts: str | Column) -> Column:
    """Whole hours since 1970-01-01 00:00 on the same wall clock."""
    c = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return days * F.lit(24) + F.hour(c)


def calendar_fields(ts: str = "event_ts") -> dict[str, Column]:
    """Calendar columns of an hourly row. Sunday is day 1, weeks are ISO weeks."""
    day = F.to_date(ts)

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return {
        "event_date": day,
        "event_hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "day_of_month": F.dayofmonth(ts),
        "day_of_year": F.dayofyear(ts),
        "week_of_year": F.weekofyear(ts),
        "month_of_year": F.month(ts),
        "is_weekend": flag(F.dayofweek(ts).isin(1, 7)),
        "is_month_start": flag(F.dayofmonth(ts) == 1),
        "is_month_end": flag(day == F.last_day(day)),
    }
