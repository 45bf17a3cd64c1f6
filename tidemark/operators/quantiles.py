"""Exact order statistics of many columns and groups, without ordering the rows.

A quantile sketch gives two values that the wanted one lies between. A second pass counts the rows below the first
of them and the values between the two, a few in ten thousand of all; the wanted value is read off those. Rows are
neither ranged nor kept: each pass is one aggregate with a combine in the map tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import pin

ACCURACY = 10_000  # of the sketch: a value's rank is off by at most a ten-thousandth of the rows
GRID = 1_000
SENT_ROWS = 100_000  # brackets that are sent to the facts


def cells(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(*by, name, value): the values of ``columns`` as doubles, NULLs left out."""
    each = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    return df.select(*by, F.inline(each)).where("value IS NOT NULL")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """(*by, column, probability, n, lower, upper, value): for each group, column and probability p the values at the
    ranks floor(p (n - 1)) and ceil(p (n - 1)), counted from 0, and the value between them in proportion.

    NULLs are skipped, NaN is the largest value, NULL keys are a group, and a group without values has no row. Values
    are compared as doubles. Facts are shuffled only where there are over ``SENT_ROWS`` groups and probabilities; with
    ``by``, the sketch is run at once to learn how many. Ties cost one row for each value. What is ordered per group and probability is about
    4 / ``accuracy`` of its distinct values; raise it for groups of more than some ten thousand million rows.
    """
    facts = cells(df, columns, by)
    keys, slack = [*by, "name"], 2 / accuracy
    ends = [p for q in probabilities for p in (max(q - slack, 0.0), min(q + slack, 1.0))]
    sketch = facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("value", F.array(*map(F.lit, ends)), accuracy).alias("ends")
    )
    # In groups of few rows the ranks of a sketch are not apart; all their values are between.
    bound = lambda i: F.when(F.col("n") > accuracy, F.get("ends", F.lit(i)))
    wanted = F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), bound(2 * i).alias("low"), bound(2 * i + 1).alias("high"))
        for i, p in enumerate(probabilities)
    ])
    brackets = sketch.select(*keys, "n", F.inline(wanted))
    at = F.col("probability") * (F.col("n") - 1)
    brackets = brackets.withColumns({"ranks": F.array(F.floor(at), F.ceil(at))})
    if by:
        brackets = pin(brackets)
    small = not by or brackets.limit(SENT_ROWS + 1).count() <= SENT_ROWS
    found = selected(facts, brackets, keys, ["probability"], small)
    share = F.col("probability") * (F.col("n") - 1) - F.floor(F.col("probability") * (F.col("n") - 1))
    lower, upper = F.get("values", F.lit(0)), F.get("values", F.lit(1))
    value = F.when(lower == upper, lower).otherwise(lower + (upper - lower) * share)
    return found.select(
        *by, F.col("name").alias("column"), "probability", "n", lower.alias("lower"), upper.alias("upper"), value.alias("value")
    )


def selected(facts: DataFrame, brackets: DataFrame, keys: Sequence[str], own: Sequence[str], small: bool) -> DataFrame:
    """``brackets`` (*keys, *own, low, high, ranks) with ``values``, those at the ranks among the rows of ``facts``
    (*keys, value) with the same keys; each must lie between low and high (NULL: no bound). ``small`` brackets, a few
    rows, are sent to the facts. A rank that is not between them is an error."""
    mine = brackets.select(*[F.col(k).alias(f"_{k}") for k in keys], *own, "low", "high")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    met = facts.join(F.broadcast(mine) if small else mine, same)
    met = met.where(F.coalesce(F.col("value") <= F.col("high"), F.lit(True)))
    below = F.coalesce(F.col("value") < F.col("low"), F.lit(False))
    counts = met.groupBy(*keys, *own, F.when(~below, F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy(*keys, *own).orderBy(F.col("value").asc_nulls_first())
    upto = counts.withColumn("upto", F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    names = [*keys, *own]
    theirs = brackets.select(*[F.col(k).alias(f"_{k}") for k in names], F.posexplode("ranks").alias("_i", "rank"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in names))
    hit = upto.join(F.broadcast(theirs) if small else theirs, same)
    hit = hit.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("rows")) & F.col("value").isNotNull())
    inside = F.col("rank") - (F.col("upto") - F.col("rows"))
    picked = hit.groupBy(*[F.col(k).alias(f"_{k}") for k in names]).agg(
        F.array_sort(F.collect_list(F.struct("_i", "value", inside.alias("inside")))).alias("_picked")
    )
    same = reduce(and_, (brackets[k].eqNullSafe(picked[f"_{k}"]) for k in names))
    out = brackets.join(picked, same, "left").select(brackets["*"], "_picked")
    whole = F.size("_picked") == F.size("ranks")
    checked = F.when(F.coalesce(whole, F.lit(False)), F.col("_picked")).otherwise(F.raise_error("a rank is outside its bracket"))
    return out.withColumn("_picked", checked).select(
        brackets["*"],
        F.transform("_picked", lambda x: x["value"]).alias("values"),
        F.transform("_picked", lambda x: x["inside"]).alias("inside"),
    )


def values_at(df: DataFrame, column: str | Column, positions_of: Callable[[int], Sequence[int]], accuracy: int = ACCURACY) -> list[tuple | None]:
    """(value, rows with the same value before) at each 0-based position ``positions_of(rows)`` in order of a numeric
    ``column`` without NULLs; None for a position outside. Reads ``df`` twice."""
    facts = df.select(F.lit(0).alias("name"), (F.col(column) if isinstance(column, str) else column).alias("value"))
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    row = facts.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", grid, accuracy).alias("grid")).first()
    n, positions = row["n"], list(positions_of(row["n"]))
    kind = facts.schema["value"].dataType
    brackets = []
    for i, p in enumerate(positions):
        if 0 <= p < n:
            at = p * GRID // n
            ends = (row["grid"][max(at - 1, 0)], row["grid"][min(at + 2, GRID)]) if n > accuracy else (None, None)
            brackets.append((0, i, *ends, [p]))
    if not brackets:
        return [None] * len(positions)
    schema = f"name int, number int, low {kind.simpleString()}, high {kind.simpleString()}, ranks array<long>"
    table = df.sparkSession.createDataFrame(brackets, schema)
    found = {r["number"]: (r["values"][0], r["inside"][0]) for r in selected(facts, table, ["name"], ["number"], True).collect()}
    return [found.get(i) for i in range(len(positions))]
