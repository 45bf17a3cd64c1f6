"""Row positions and neighbours over a total order, without sorting the table in one task.

Rows are range-partitioned by the order columns (Spark samples the bounds, so a crowded stretch of time
gets more partitions) and pinned, because the bounds must not be drawn again between passes. What has to
cross blocks is one small row per block.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.time import wall_micros
from tidemark.operators.quantiles import values_at
from tidemark.session import pin


def ordered_blocks(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """``df`` with ``_block``: all rows of block i sort before all rows of block i+1. Runs a job.

    Equal keys share a block, so ``df`` should hold each key once.
    """
    return pin(_ranged(df, [F.col(c).asc() for c in order], blocks).withColumn("_block", F.spark_partition_id()))


def _ranged(df: DataFrame, keys: Sequence[Column], blocks: int | None) -> DataFrame:
    # Without a number, adaptive execution merges neighbouring ranges that turn out small, in order.
    return df.repartitionByRange(blocks, *keys) if blocks else df.repartitionByRange(*keys)


def with_block_value(blocked: DataFrame, values: Sequence[int | None], alias: str) -> DataFrame:
    """Add one number per block. The broadcast side has one row per block, so its size is the number of
    shuffle partitions and not that of the data."""
    small = blocked.sparkSession.createDataFrame(list(enumerate(values)), f"_block int, {alias} long")
    return blocked.join(F.broadcast(small), "_block", "left")


def block_starts(blocked: DataFrame, size: Column | None = None) -> tuple[list[int], int]:
    """Rows before each block, and rows in all. Fetches one number per block."""
    sized = blocked.groupBy("_block").agg((F.count(F.lit(1)) if size is None else size).alias("_size"))
    sizes = {r["_block"]: r["_size"] for r in sized.collect()}
    starts = [0, *accumulate(sizes.get(b, 0) for b in range(max(sizes, default=-1) + 1))]
    return starts[:-1], starts[-1]


def row_position(df: DataFrame, order: Sequence[str], alias: str = "position", blocks: int | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, … in ``order``. Rows equal on ``order`` are told apart by a hash of all
    columns that Spark can compare, so every run gives the same numbers; rows equal in all of them are
    interchangeable and get consecutive numbers.

    Rows are counted per key (order columns and hash) and only those keys are ranged and pinned; the rows
    themselves move once, to meet the number of their key.
    """
    own = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    keyed = df.withColumn("_h", F.xxhash64(*[F.col(c) for c in (*order, *tie_columns(df, order))]))
    names = [f"_o{i}" for i in range(len(order))] + ["_g"]
    counts = keyed.groupBy(*own, F.col("_h").alias("_g")).agg(F.count(F.lit(1)).alias("_rows"))
    blocked = ordered_blocks(counts, names, blocks)
    starts, _ = block_starts(blocked, F.sum("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy("_block").orderBy(*names))
    first = with_block_value(blocked.withColumn("_upto", upto), starts, "_start")
    first = first.withColumn("_first", F.col("_start") + F.col("_upto") - F.col("_rows"))
    same = reduce(and_, (keyed[c].eqNullSafe(first[f"_o{i}"]) for i, c in enumerate(order)), keyed["_h"] == first["_g"])
    met = keyed.join(first, same)
    single = met.where("_rows = 1").select(*df.columns, F.col("_first").alias(alias))
    return single.union(_numbered_repeats(met.where("_rows > 1").select(*df.columns, "_first"), df.columns, alias))


def _numbered_repeats(repeats: DataFrame, columns: Sequence[str], alias: str) -> DataFrame:
    """Rows that share ``_first``, the number of the first of them, numbered from it. They are pinned where
    they lie and numbered within each part, after the rows of the parts before it; a key's rows never meet
    in one task."""
    laid = pin(repeats.withColumn("_part", F.spark_partition_id()))
    per_part = laid.groupBy("_first", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_first").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_first", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = laid.join(offsets, ["_first", "_part"])
    within = F.row_number().over(Window.partitionBy("_first", "_part").orderBy("_part")) - 1
    return placed.withColumn("_within", within).select(
        *columns, (F.col("_first") + F.col("_before") + F.col("_within")).alias(alias)
    )


@dataclass(frozen=True)
class Boundary:
    """The key at a row position, and how many rows with that same key lie before the position."""

    order: tuple[str, ...]
    key: Row
    inside: int


def keys_at(
    df: DataFrame,
    order: Sequence[str],
    positions_of: Callable[[int], Sequence[int]],
    blocks: int | None = None,
) -> list[Boundary | None]:
    """The keys at the 0-based positions ``positions_of(row count)``; None for one outside the table.

    Exact. A first column of whole numbers or times is bracketed by a sketch and never ordered (``values_at``), and
    further columns are looked at among the rows of its key only. For others, rows are first counted per key, so only distinct keys are ranged and pinned and a key shared by a
    third of all rows is one row.
    """
    if _as_number(df, order[0]) is not None:
        return [_with_rest(df, order, b) for b in _keys_by_number(df, order[0], positions_of)]
    counts = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_rows"))
    blocked = ordered_blocks(counts, order, blocks)
    starts, total = block_starts(blocked, F.sum("_rows"))
    positions = list(positions_of(total))
    places = [(bisect_right(starts, p) - 1, p) if 0 <= p < total else None for p in positions]
    wanted = [p for p in places if p]
    if not wanted:
        return [None] * len(positions)

    upto = F.sum("_rows").over(Window.partitionBy("_block").orderBy(*order))
    hit = F.lit(False)
    for block, p in wanted:
        nth = p - starts[block]
        hit = hit | ((F.col("_block") == block) & (F.col("_upto") > nth) & (F.col("_upto") - F.col("_rows") <= nth))
    found = blocked.where(F.col("_block").isin([b for b, _ in wanted])).withColumn("_upto", upto).where(hit).collect()

    def boundary(place) -> Boundary | None:
        if place is None:
            return None
        block, p = place
        nth = p - starts[block]
        row = next(r for r in found if r["_block"] == block and r["_upto"] - r["_rows"] <= nth < r["_upto"])
        return Boundary(tuple(order), Row(**{c: row[c] for c in order}), nth - (row["_upto"] - row["_rows"]))

    return [boundary(p) for p in places]


def _as_number(df: DataFrame, column: str) -> Column | None:
    """The column as a long in the same order, where its type has one."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return wall_micros(column) if isinstance(kind, T.TimestampNTZType) else F.unix_micros(c)
    return None


def _keys_by_number(df: DataFrame, column: str, positions_of: Callable[[int], Sequence[int]]) -> list[Boundary | None]:
    number = _as_number(df, column)
    missing = df.where(F.col(column).isNull()).count()  # they come first
    asked: list[int] = []

    def among(rows: int) -> list[int]:
        asked.extend(positions_of(rows + missing))
        return [p - missing for p in asked]

    def boundary(position: int, found: tuple | None) -> Boundary | None:
        if found is None:
            return Boundary((column,), Row(**{column: None}), position) if 0 <= position < missing else None
        value, inside = found
        kind = df.schema[column].dataType
        if isinstance(kind, T.TimestampNTZType):
            value = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=value)
        elif isinstance(kind, T.TimestampType):
            value = dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(microseconds=value)
        return Boundary((column,), Row(**{column: value}), inside)

    found = values_at(df.where(F.col(column).isNotNull()), number, among)
    return [boundary(p, f) for p, f in zip(asked, found)]


def _with_rest(df: DataFrame, order: Sequence[str], found: Boundary | None) -> Boundary | None:
    if found is None or len(order) == 1:
        return found
    [rest] = keys_at(df.where(_equals(df, order[:1], found.key)), order[1:], lambda _: [found.inside])
    return Boundary(tuple(order), Row(**found.key.asDict(), **rest.key.asDict()), rest.inside)


def refined(df: DataFrame, found: Boundary | None) -> Boundary | None:
    """Where rows with the boundary's key lie on both sides of it, rank just those rows by the remaining
    columns. Only rows equal in every comparable column then stay together."""
    if found is None or not found.inside or not (more := tie_columns(df, found.order)):
        return found
    tied = df.where(_equals(df, found.order, found.key)).select(*more)
    [tie] = keys_at(tied, more, lambda _: [found.inside])
    key = Row(**found.key.asDict(), **tie.key.asDict())
    return Boundary((*found.order, *more), key, tie.inside)


def _bound(value, data_type: T.DataType) -> Column:
    # As text, so that the Python process's own time zone plays no part.
    plain = value.isoformat(sep=" ") if isinstance(data_type, T.TimestampNTZType) else value
    return F.lit(plain).cast(data_type)


def _literals(df: DataFrame, columns: Sequence[str], key: Row) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema}
    return [(F.lit(None) if key[c] is None else _bound(key[c], types[c])).cast(types[c]).alias(c) for c in columns]


def _equals(df: DataFrame, columns: Sequence[str], key: Row) -> Column:
    return reduce(and_, (F.col(c).eqNullSafe(v) for c, v in zip(columns, _literals(df, columns, key))))


def sorts_before(df: DataFrame, found: Boundary) -> Column:
    """True for rows whose order columns come strictly before the boundary's key; NULL comes first."""
    first, rest = found.order[0], found.order[1:]
    [bound] = _literals(df, [first], found.key)
    if found.key[first] is None:
        before, same = F.lit(False), F.col(first).isNull()
    else:
        before = F.coalesce(F.col(first) < bound, F.lit(True))
        same = F.coalesce(F.col(first) == bound, F.lit(False))
    if not rest:
        return before
    theirs = F.struct(*_literals(df, rest, found.key))
    return before | (same & (F.struct(*rest) < theirs))


def tie_columns(df: DataFrame, order: Sequence[str]) -> list[str]:
    """The remaining columns that Spark can compare."""
    simple = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema if f.name not in order and isinstance(f.dataType, simple)]


def boundaries(
    df: DataFrame, order: Sequence[str], positions_of: Callable[[int], Sequence[int]]
) -> list[Boundary | None]:
    """``keys_at``, refined where equal keys lie on both sides of a position."""
    return [refined(df, b) for b in keys_at(df, order, positions_of)]


def latest_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last ``n`` rows in ``order``, exactly, NULLs first; all rows where there are no more. Rows equal
    on ``order`` are told apart by the other columns that Spark can compare.

    The key at the n-th last position is looked up and rows are compared with it where they are. Only rows
    equal to that key in every comparable column, of which a part may be wanted, are numbered.
    """
    if n <= 0:
        return df.limit(0)
    [found] = boundaries(df, order, lambda rows: [rows - n])
    if found is None:
        return df
    if not found.inside:
        return df.where(~sorts_before(df, found))
    tied = _equals(df, found.order, found.key)
    numbered = _numbered_repeats(df.where(tied).withColumn("_first", F.lit(0).cast("long")), df.columns, "_number")
    wanted = numbered.where(F.col("_number") >= found.inside).drop("_number")
    return df.where(~sorts_before(df, found) & ~tied).union(wanted)


def neighbour_gaps(blocked: DataFrame, value: str, copies: str) -> DataFrame:
    """``gap`` (difference to the previous row when sorted by the whole-number column ``value``) and how
    many neighbouring ``pairs`` have it.

    ``blocked`` holds each value once (see ``ordered_blocks``) with the number of its ``copies``; repeats
    make gaps of 0, and NULL values are skipped.
    """
    blocked = blocked.where(F.col(value).isNotNull())
    lasts = {r["_block"]: r["_last"] for r in blocked.groupBy("_block").agg(F.max(value).alias("_last")).collect()}
    before, edges = None, []
    for block in range(max(lasts, default=-1) + 1):
        edges.append(before)
        before = lasts.get(block, before)
    in_block = Window.partitionBy("_block").orderBy(value)
    previous = F.coalesce(F.lag(value).over(in_block), F.col("_edge"))
    gap = with_block_value(blocked, edges, "_edge").withColumn("_gap", F.col(value) - previous)
    pairs = F.array(
        F.struct(F.col("_gap").alias("gap"), F.lit(1).cast("long").alias("pairs")),
        F.struct(F.lit(0).cast("long").alias("gap"), (F.col(copies) - 1).alias("pairs")),
    )
    counted = gap.select(F.inline(pairs)).where("gap IS NOT NULL AND pairs > 0")
    return counted.groupBy("gap").agg(F.sum("pairs").alias("pairs"))
