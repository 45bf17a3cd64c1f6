"""Fold facts to one row per period: sums, distinct counts and pivots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.naming import pivot_names, unique_names
from tidemark.functions.numeric import measure
from tidemark.session import pin


@dataclass(frozen=True)
class Total:
    column: str
    alias: str


@dataclass(frozen=True)
class DistinctCount:
    """Exact distinct values of ``column``, counting only rows where the SQL predicate ``where`` holds."""

    column: str
    alias: str
    where: str | None = None

    def counted(self) -> Column:
        c = F.col(self.column)
        return F.when(F.expr(self.where), c) if self.where else c


@dataclass(frozen=True)
class PivotTotal:
    """``sum(column)`` per value of ``category``, one column each, named ``<prefix>_<category>``.

    Without ``values`` the categories are looked up among the sums, which runs a job.
    """

    column: str
    category: str
    prefix: str
    values: tuple | None = None


@dataclass(frozen=True)
class PivotRows:
    """Distinct combinations of ``columns`` per value of ``category`` (one of ``columns``)."""

    columns: tuple[str, ...]
    category: str
    prefix: str
    values: tuple | None = None


def categories(df: DataFrame, column: str) -> list:
    """Distinct values in order, NULL first. Only up to ``spark.sql.pivotMaxValues`` of them come to the
    driver; more is an error, as it would be for any pivot."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = df.select(column).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values; pass the wanted ones")
    return sorted((r[0] for r in rows), key=lambda v: (v is not None, v if v is not None else 0))


BLOCK = 200  # pivot columns in a row, about, where a pivot is read back as rows


def named_cells(found: DataFrame, prefix: str, taken: Sequence[str]) -> DataFrame:
    """``found`` (_category, _order) with ``_name``, which ``pivot_names`` would give; only names that clash are worked
    out in groups. The categories stay where they are."""
    spelled = F.udf(lambda c: pivot_names(prefix, [c], ())[0])
    given = pin(found.withColumn("_given", spelled("_category")))
    clash = given.groupBy("_given").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("_given").isin(list(taken)))
    clash = clash.select("_given")
    base = F.regexp_replace("_given", "_[0-9]+$", "")
    numbered = given.where(base != F.col("_given")).select(base.alias("_base"), F.col("_given").alias("_other"))
    numbered = clash.join(numbered, F.col("_given") == F.col("_base")).groupBy("_given").agg(F.collect_set("_other").alias("_others"))
    order = Window.partitionBy("_given").orderBy(F.col("_order").asc_nulls_first())
    repeats = given.join(clash, "_given", "left_semi").withColumn("_at", F.row_number().over(order))
    repeats = repeats.join(numbered, "_given", "left")

    def tell_apart(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_at")
        others = part["_others"].iloc[0]
        return part[["_given", "_at"]].assign(_name=unique_names(part["_given"], [*taken, *(() if others is None else others)]))

    named = repeats.select("_given", "_at", "_others").groupBy("_given").applyInPandas(tell_apart, "_given string, _at int, _name string")
    repeats = repeats.select("_category", "_given", "_at").join(named, ["_given", "_at"]).select("_category", "_name")
    alone = given.join(clash, "_given", "left_anti").select("_category", F.col("_given").alias("_name"))
    return alone.union(repeats)


def pivot_rows(out: DataFrame, facts: DataFrame, by: Sequence[str], pivot: PivotTotal, amount: Column, names: tuple[str, str]) -> DataFrame:
    """``out`` (one row per period) times the categories of ``facts`` (*by, _category): the name and value of each cell
    of the pivot, in ``names``. The pivot is made of blocks of about ``BLOCK`` columns side by side, so there may be any number
    of categories, and they do not come to the driver."""
    if pivot.values is None:
        found = facts.select("_category").distinct().withColumn("_order", F.col("_category"))
    else:
        rows = [(v, i) for i, v in enumerate(pivot.values)]
        kind = T.StructType([T.StructField("_category", facts.schema["_category"].dataType), T.StructField("_order", T.LongType())])
        found = facts.sparkSession.createDataFrame(rows, kind)
    found = named_cells(found, pivot.prefix, out.columns)
    blocks = max(1, -(-found.count() // BLOCK))
    found = found.withColumn("_block", F.pmod(F.xxhash64("_category"), F.lit(blocks)))
    place = F.row_number().over(Window.partitionBy("_block").orderBy("_name")) - 1
    found = pin(found.withColumn("_place", place))
    width = (found.agg(F.max("_place")).first()[0] or 0) + 1
    sums = facts.groupBy(*by, F.col("_category").alias("_of")).agg(F.sum(amount).cast("double").alias("_sum"))
    placed = sums.join(found.select("_category", "_block", "_place"), F.col("_of").eqNullSafe(F.col("_category")))
    wide = placed.groupBy(*by, "_block").pivot("_place", list(range(width))).agg(F.first("_sum"))
    keys = [f"_k{i}" for i in range(len(by))]
    wide = wide.toDF(*keys, "_b", *(f"_{i}" for i in range(width)))
    every = out.crossJoin(found.select("_block").distinct())
    same = [F.col(b).eqNullSafe(F.col(k)) for b, k in zip([*by, "_block"], [*keys, "_b"])]
    row = F.array(*(f"_{i}" for i in range(width)))
    cells = every.join(wide, reduce(and_, same), "left").select(*out.columns, "_block", F.posexplode(row).alias("_place", "_value"))
    cells = cells.join(found.select("_block", "_place", "_name"), ["_block", "_place"])
    return cells.select(*out.columns, F.col("_name").alias(names[0]), F.col("_value").alias(names[1]))


def rollup(
    df: DataFrame,
    by: Sequence[str],
    totals: Sequence[Total] = (),
    distincts: Sequence[DistinctCount] = (),
    pivot: PivotTotal | None = None,
    exact: str | None = None,
    as_rows: tuple[str, str] | None = None,
) -> DataFrame:
    """Totals, distinct counts and pivoted sums of one source, which is read once.

    Without a pivot this is one aggregate. With one, facts are first added up per period, category and
    counted member; totals, counts and pivot all come from those sums, so what a fact costs does not depend
    on how many categories there are. Sums that no one named the categories of are pinned, and the
    categories are read off them. Every step has a map-side combine; a hot period shrinks to its members
    before it moves. A cell without rows is NULL, not 0.

    A frame has room for some thousands of columns. With ``as_rows`` (a column for the cell's name, one for its
    value) there is one row per period and cell, and any number of categories.
    """
    # Each measure is converted once per row, however many cells add it up.
    columns = dict.fromkeys([t.column for t in totals] + ([pivot.column] if pivot else []))
    names = {c: f"_measure_{i}" for i, c in enumerate(columns)}
    facts = df.withColumns({n: measure(c, exact) for c, n in names.items()}) if names else df
    counted = {f"_member_{i}": d.counted() for i, d in enumerate(distincts)}

    if pivot:
        groups = [*by, F.col(pivot.category).alias("_category"), *(c.alias(n) for n, c in counted.items())]
        facts = facts.groupBy(*groups).agg(*(F.sum(n).alias(n) for n in names.values()))
        if pivot.values is None:
            facts = pin(facts)
        counted = {n: F.col(n) for n in counted}

    aggregates = [F.sum(names[t.column]).cast("double").alias(t.alias) for t in totals]
    aggregates += [F.count_distinct(c).alias(d.alias) for d, c in zip(distincts, counted.values())]
    if not pivot:
        return facts.groupBy(*by).agg(*aggregates)

    taken = [*by, *(t.alias for t in totals), *(d.alias for d in distincts)]
    if as_rows:
        out = facts.groupBy(*by).agg(*aggregates or [F.count(F.lit(1)).alias("_rows")]).select(*taken)
        return pivot_rows(out, facts, by, pivot, F.col(names[pivot.column]), as_rows)
    values = categories(facts, "_category") if pivot.values is None else list(pivot.values)
    cells = dict(zip(values, pivot_names(pivot.prefix, values, taken)))
    amount = F.col(names[pivot.column])
    if None in cells:  # the built-in pivot has no column for NULL
        aggregates.append(F.sum(F.when(F.col("_category").isNull(), amount)).cast("double").alias("_null_cell"))
    out = facts.groupBy(*by).agg(*aggregates or [F.count(F.lit(1)).alias("_rows")])
    named = [v for v in values if v is not None]
    if named:
        wide = facts.groupBy(*by, "_category").agg(F.sum(amount).alias("_sum")).where("_category IS NOT NULL")
        wide = wide.groupBy(*by).pivot("_category", named).agg(F.first("_sum").cast("double"))
        keys = [f"_k{i}" for i in range(len(by))]
        wide = wide.toDF(*keys, *(cells[v] for v in named))
        same = [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys)]
        out = out.join(wide, reduce(and_, same), "left")
    chosen = [F.col("_null_cell").alias(n) if v is None else F.col(f"`{n}`") for v, n in cells.items()]
    return out.select(*taken, *chosen)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).dropDuplicates()


def rollup_with_row_pivot(
    df: DataFrame, by: Sequence[str], distincts: Sequence[DistinctCount], pivot: PivotRows
) -> DataFrame:
    """Distinct counts beside a count of distinct rows per category, where a NULL member is a row too.

    One pass and no join: each fact is tagged once per count and once for the pivot, whatever the number
    of categories; the tagged members are made distinct (with a map-side combine, and spread by member,
    so a hot period is spread too) and then counted per period. Members keep their types, each in a column
    that is NULL for the other tags. Categories that are not given are read off the pinned members.
    """
    others = [c for c in pivot.columns if c != pivot.category]
    rows = len(distincts)
    fields = {f"_m{i}": d.counted() for i, d in enumerate(distincts)}
    own = {"_category": F.col(pivot.category)} | {f"_r{i}": F.col(c) for i, c in enumerate(others)}
    types = dict(df.select(*(c.alias(n) for n, c in (fields | own).items())).dtypes)

    def tag(number: int, filled: dict[str, Column]) -> Column:
        columns = [filled[n] if n in filled else F.lit(None) for n in types]
        return F.struct(F.lit(number).alias("_tag"), *(c.cast(types[n]).alias(n) for n, c in zip(types, columns)))

    tags = [tag(i, {n: c}) for i, (n, c) in enumerate(fields.items())] + [tag(rows, own)]
    present = F.col("_tag") == rows
    for i, n in enumerate(fields):
        present = present | ((F.col("_tag") == i) & F.col(n).isNotNull())
    members = df.select(*by, F.inline(F.array(*tags))).where(present).distinct()
    if pivot.values is None:
        members = pin(members)
        values = categories(members.where(F.col("_tag") == rows), "_category")
    else:
        values = list(pivot.values)
    names = pivot_names(pivot.prefix, values, [*by, *(d.alias for d in distincts)])
    counts = [F.count_if(F.col("_tag") == i).alias(d.alias) for i, d in enumerate(distincts)]
    for value, name in zip(values, names):
        hit = (F.col("_tag") == rows) & F.col("_category").eqNullSafe(F.lit(value))
        counts.append(F.nullif(F.count_if(hit), F.lit(0)).alias(name))
    return members.groupBy(*by).agg(*counts)
