"""Exact distinct counts that can be added up over time: one bitmap of members per period.

Members get numbers from a dictionary, and each fact sets its member's bit in the bitmap of its finest period.
Bitmaps of coarser periods are the union of finer ones, so hours, days and months come from one aggregate over the
facts, which is shuffled once; nothing is counted again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import with_block_value
from tidemark.session import pin

BITS = 32_768  # members of one of Spark's bitmaps
BROADCAST_MEMBERS = 1_000_000
_ROW_BITS = 33  # of monotonically_increasing_id, for the row within its partition


def numbered(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The distinct values of ``column`` as (_member, _number), numbered from 1 without gaps, and how many there
    are. Numbers follow where Spark's partitions put the values; counts do not depend on them."""
    values = df.select(F.col(column).alias("_member")).where("_member IS NOT NULL").distinct()
    values = pin(values.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = {r["p"]: r["n"] for r in values.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for p in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(p, 0)
    placed = with_block_value(values.withColumn("_block", part.cast("int")), starts, "_start")
    number = F.col("_start") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1) + 1
    return placed.select("_member", number.alias("_number")), before


def with_numbers(df: DataFrame, period: Column, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """(period, _n0, _n1, …): the numbers of the members in ``columns``, NULL where there is none, and the size of the
    largest dictionary. Dictionaries of more than ``BROADCAST_MEMBERS`` meet the facts by a shuffle."""
    facts = df.select(period.alias("period"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    largest = 0
    for i, c in enumerate(columns):
        dictionary, size = numbered(df, c)
        dictionary = dictionary.toDF(f"_m{i}", f"_n{i}")
        side = F.broadcast(dictionary) if size <= BROADCAST_MEMBERS else dictionary
        facts = facts.join(side, F.col(f"_v{i}") == F.col(f"_m{i}"), "left").drop(f"_m{i}", f"_v{i}")
        largest = max(largest, size)
    return facts, largest


def member_bitmaps(df: DataFrame, period: Column, columns: Sequence[str]) -> DataFrame:
    """(period, bucket, b0, b1, …): for every period the members of each column as bitmaps. A row per period where
    all dictionaries fit one bitmap; else one for each bucket of numbers that occurs. A period without members has
    a row as well."""
    facts, largest = with_numbers(df, period, columns)
    numbers = [f"_n{i}" for i in range(len(columns))]
    if largest <= BITS:
        bits = [F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias(f"b{i}") for i, n in enumerate(numbers)]
        return facts.groupBy("period", F.lit(1).cast("long").alias("bucket")).agg(*bits)
    # one row for each column: their buckets differ
    cells = [F.struct(F.lit(i).alias("_c"), F.col(n).alias("_n")) for i, n in enumerate(numbers)]
    long = facts.select("period", F.inline(F.array(*cells)))
    long = long.groupBy("period", "_c", F.bitmap_bucket_number("_n").alias("bucket"))
    long = long.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("_b"))
    own = [F.when(F.col("_c") == i, F.col("_b")).alias(f"b{i}") for i in range(len(columns))]
    return long.select("period", "bucket", *own)


def coarser(bitmaps: DataFrame, period: Column) -> DataFrame:
    """The bitmaps of longer periods: ``period`` says which one a row's belongs to."""
    names = [c for c in bitmaps.columns if c not in ("period", "bucket")]
    joined = bitmaps.select(period.alias("period"), "bucket", *names).groupBy("period", "bucket")
    return joined.agg(*[F.bitmap_or_agg(b).alias(b) for b in names])


def counted(bitmaps: DataFrame, aliases: Sequence[str]) -> DataFrame:
    """(period, *aliases): distinct members of each period."""
    sums = [F.coalesce(F.sum(F.bitmap_count(f"b{i}")), F.lit(0)).alias(a) for i, a in enumerate(aliases)]
    return bitmaps.groupBy("period").agg(*sums)


def distinct_by_grain(df: DataFrame, time: str, columns: Sequence[str], grains: Sequence[str] = ("hour", "day", "month")) -> DataFrame:
    """(grain, period, *columns): exact distinct members of each column per hour, day, month or whatever
    ``date_trunc`` knows, finest first; each grain must be made of whole periods of the one before. NULL members are
    not counted; rows without a time are one period, NULL."""
    kind = df.schema[time].dataType
    cut = lambda c, grain: F.date_trunc(grain, c).cast(kind)
    level, out = None, None
    for grain in grains:
        level = pin(member_bitmaps(df, cut(F.col(time), grain), columns)) if level is None else coarser(level, cut(F.col("period"), grain))
        counts = counted(level, columns).select(F.lit(grain).alias("grain"), "period", *columns)
        out = counts if out is None else out.unionByName(counts)
    return out
