"""Guarded arithmetic that behaves the same with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def guarded_ratio(numerator: str, denominator: str) -> Column:
    """NULL when the denominator is NULL or zero."""
    return F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))


def round_even(column: Column, digits: int) -> Column:
    """Round ties to the even neighbour after scaling, as array libraries do."""
    factor = F.lit(float(10**digits))
    return F.rint(column * factor) / factor


def measure(column: str | Column, exact: str | None = None) -> Column:
    """A summand: double, or with ``exact`` (e.g. ``decimal(18,2)``) a decimal, whose sums do not depend
    on how rows are spread over tasks. A value that is not a number becomes NULL; a number too large for
    the decimal is an error. Decimals beyond the scale are rounded off each value."""
    c = F.col(column) if isinstance(column, str) else column
    number = c.try_cast("double")
    if not exact:
        return number
    fitted = c.try_cast(exact)
    too_large = fitted.isNull() & number.isNotNull() & ~F.isnan(number)
    text = F.concat(F.lit("number out of range for "), F.lit(exact), F.lit(": "), c.cast("string"))
    return F.when(too_large, F.raise_error(text).cast(exact)).otherwise(fitted)


def version_rank(column: str | Column, priority: tuple[str, ...]) -> Column:
    """Rank of a version code, highest first in ``priority``; unknown or NULL codes rank 0."""
    c = F.col(column) if isinstance(column, str) else column
    lowest_first = F.array(*[F.lit(v.upper()) for v in reversed(priority)])
    return F.coalesce(F.array_position(lowest_first, F.upper(c.cast("string"))), F.lit(0)).cast("int")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns counts as missing everywhere in the audit and the models."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
