"""Lags, leads and rolling statistics over a dense series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType
from pyspark.sql.window import Window, WindowSpec

from tidemark.functions.time import MICROS_PER_HOUR, hour_index


@dataclass(frozen=True)
class Shift:
    """``column`` as it was ``hours`` earlier; a negative number looks ahead."""

    column: str
    hours: int
    alias: str

    reach = property(lambda self: (max(self.hours, 0), max(-self.hours, 0)))

    def over(self, order: WindowSpec, exact: str | None = None) -> Column:
        return F.lag(self.column, self.hours).over(order)


@dataclass(frozen=True)
class Rolling:
    """Mean or sample standard deviation of the ``hours`` rows before this one, this one excluded.
    NULLs are skipped and a window cut short by the start of the series still counts."""

    column: str
    stat: str
    hours: int
    alias: str

    reach = property(lambda self: (self.hours, 0))

    def over(self, order: WindowSpec, exact: str | None = None) -> Column:
        frame = order.rowsBetween(-self.hours, -1)
        if exact is None:
            function = {"mean": F.avg, "stddev": F.stddev_samp}[self.stat]
            return function(self.column).over(frame)
        unit, scale = whole_units(self.column, exact)
        return statistic(self.stat, F.count(unit).over(frame), F.sum(unit).over(frame), F.sum(square(unit)).over(frame), scale)


def whole_units(column: str, exact: str) -> tuple[Column, int]:
    """A column as whole numbers of its last decimal place, and how many places ``exact`` (a decimal type) has."""
    places = int(exact.rstrip(")").split(",")[1])
    return (F.col(column).cast(exact) * F.lit(10**places)).cast("decimal(18,0)"), places


def square(unit: Column) -> Column:
    return (unit * unit).cast("decimal(28,0)")


def statistic(stat: str, n: Column, total: Column, squares: Column, places: int) -> Column:
    """Mean or sample standard deviation from the count, sum and sum of squares of whole units, rounded in the last
    step only: n * squares - total^2 is exact. Sums beyond 10^18 units, or squares beyond 10^27, are an error."""
    if stat == "mean":
        return F.try_divide(total.cast("double"), n.cast("double")) / F.lit(float(10**places))
    spread = n.cast("decimal(10,0)") * squares.cast("decimal(27,0)") - total.cast("decimal(18,0)") * total.cast("decimal(18,0)")
    pairs = n.cast("double") * (n.cast("double") - 1)
    variance = spread.cast("double") / pairs / F.lit(float(10 ** (2 * places)))
    return F.when(n > 1, F.sqrt(variance))


def lag_columns(
    df: DataFrame,
    features: Sequence[Shift | Rolling],
    time: str = "event_ts",
    series_keys: Sequence[str] = (),
    block_hours: int | None = 2016,
    on_spine: bool = False,
    exact: str | None = None,
) -> DataFrame:
    """Add ``features``. ``df`` must be dense and hourly within each series (see ``dense_spine``); a gap or
    a repeated hour is an error while the plan runs. ``on_spine`` says that ``df`` was just joined to such a
    spine, which spares the count per series.

    A window over the whole series would put it all in one task. Instead time is cut into blocks of
    ``block_hours``; each row is also copied to the neighbouring blocks that can see it, windows run per
    block, and only each block's own rows are kept. The copies amount to (look-back + look-ahead) /
    block length. ``block_hours=None`` uses the plain window per series, for short series. With ``exact``, a decimal
    type, rolling statistics are made from exact sums and do not depend on the order of additions.
    """
    if not features:
        return df
    hour = _running_hour(df, time)
    if not on_spine:
        df = _of_full_span(df, hour, series_keys)
    if block_hours is None:
        order = Window.partitionBy(*series_keys).orderBy(time)
        added = {f.alias: f.over(order, exact) for f in features} | {"_step": _step(hour, time, order)}
        return df.withColumns(added).where("_step").drop("_step")

    # One day of slack covers a clock change in a zoned timestamp column.
    back = max(f.reach[0] for f in features) + 24
    ahead = max(f.reach[1] for f in features) + 24
    wall = hour_index(time)

    def block_of(h: Column) -> Column:
        return F.floor(h / F.lit(block_hours)).cast("long")

    seen_by = F.sequence(block_of(wall - F.lit(ahead)), block_of(wall + F.lit(back)))
    copies = df.withColumns({"_own": block_of(wall), "_block": F.explode(seen_by)})
    order = Window.partitionBy(*series_keys, "_block").orderBy(time)
    windowed = copies.withColumns({f.alias: f.over(order, exact) for f in features} | {"_step": _step(hour, time, order)})
    return windowed.where("_own = _block AND _step").drop("_own", "_block", "_step")


def _running_hour(df: DataFrame, time: str) -> Column:
    """Whole hours, without jumps where a zoned column changes its clock."""
    zoned = isinstance(df.schema[time].dataType, TimestampType)
    return F.floor(F.unix_micros(time) / MICROS_PER_HOUR) if zoned else hour_index(time)


def _step(hour: Column, time: str, order: WindowSpec) -> Column:
    """True; an error where a row is not one hour after the row before it."""
    text = F.concat(F.lit("not one row per hour at "), F.col(time).cast("string"))
    fine = F.coalesce(hour - F.lag(hour).over(order) == 1, F.lit(True))
    return F.when(fine, True).otherwise(F.raise_error(text).cast("boolean"))


def _of_full_span(df: DataFrame, hour: Column, series_keys: Sequence[str]) -> DataFrame:
    """``df``; an error where a series has fewer rows than hours. This sees gaps that are longer than what
    neighbouring blocks share; ``_step`` sees all others, and repeats."""
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(series_keys)]
    spans = df.groupBy(*keys).agg((F.max(hour) - F.min(hour) + 1 - F.count(F.lit(1))).alias("_missing"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(series_keys)]
    joined = df.join(spans, reduce(and_, same)) if same else df.crossJoin(F.broadcast(spans))  # one row
    whole = F.when(F.coalesce("_missing", F.lit(0)) == 0, True)
    checked = joined.where(whole.otherwise(F.raise_error("not one row per hour in every series").cast("boolean")))
    return checked.select(*df.columns)


def rolling_by_prefix(
    df: DataFrame,
    features: Sequence[Rolling],
    exact: str,
    time: str = "event_ts",
    series_keys: Sequence[str] = (),
    block_hours: int = 2016,
) -> DataFrame:
    """Add rolling statistics whose cost does not grow with their frames, for frames of thousands of hours. ``df`` as
    for ``lag_columns``; values are added up as ``exact``, a decimal type.

    Count, sum and sum of squares of all rows before a row are kept beside it; a frame is the difference of those at
    its two ends. They are added up per block of time, and blocks by their totals, a row for each block. The far end
    meets the row by a join on its hour, one for each length of frame.
    """
    hour = _running_hour(df, time)
    dense = _of_full_span(df, hour, series_keys).withColumns({"_hour": hour, "_block": F.floor(hour / F.lit(block_hours))})
    columns = list(dict.fromkeys(f.column for f in features))
    sums = {}
    for i, c in enumerate(columns):
        unit, _ = whole_units(c, exact)
        for kind, of in (("n", F.when(unit.isNotNull(), F.lit(1)).cast("decimal(18,0)")), ("s", unit), ("q", square(unit))):
            sums[f"_{kind}{i}"] = F.coalesce(of, F.lit(0).cast("decimal(28,0)"))
    dense = dense.withColumns(sums)

    before = lambda order, kind: {c: F.coalesce(F.sum(c).over(order), F.lit(0)).cast(kind) for c in sums}
    kind = "decimal(28,0)"
    keys = [*series_keys, "_block"]
    within = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, -1)
    totals = dense.groupBy(*keys).agg(*[F.sum(c).cast(kind).alias(c) for c in sums])
    # a row per series and block
    earlier = Window.partitionBy(*series_keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumns(before(earlier, kind)).select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(c).alias(f"_b{c}") for c in sums])
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys))
    step = _step(F.col("_hour"), time, Window.partitionBy(*keys).orderBy(time))
    rows = dense.withColumns(before(within, kind) | {"_one": step}).where("_one").join(starts, same)
    rows = rows.select(*df.columns, "_hour", *[(F.col(c) + F.col(f"_b{c}")).cast(kind).alias(c) for c in sums])

    ends = rows.select(*series_keys, "_hour", *sums)
    out = rows
    for length in dict.fromkeys(f.hours for f in features):
        names = [f"_k{i}" for i in range(len(series_keys))]
        far = ends.select(
            *[F.col(k).alias(n) for k, n in zip(series_keys, names)],
            (F.col("_hour") + length).alias("_at"),
            *[F.col(c).alias(f"_far{c}") for c in sums],
        )
        met = reduce(and_, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(series_keys, names)), F.col("_hour") == F.col("_at"))
        out = out.join(far, met, "left")
        frame = lambda c: (F.col(c) - F.coalesce(F.col(f"_far{c}"), F.lit(0))).cast(kind)
        added = {}
        for f in features:
            if f.hours == length:
                i, places = columns.index(f.column), whole_units(f.column, exact)[1]
                added[f.alias] = statistic(f.stat, frame(f"_n{i}").cast("long"), frame(f"_s{i}"), frame(f"_q{i}"), places)
        out = out.withColumns(added).drop(*names, "_at", *[f"_far{c}" for c in sums])
    return out.drop("_hour", *sums)
