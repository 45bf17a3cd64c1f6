"""Vectors in a column as matrices of whole numbers."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import small_batches


def usable(df: DataFrame, id_col: str, vector_col: str, **more: Column) -> DataFrame:
    """``id``, ``x`` (array of double) and ``more`` of the rows whose vector is there and has no NULL, NaN or
    infinite component."""
    x = df[vector_col].cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    picked = small_batches(df).where(finite)
    return picked.select(df[id_col].cast("long").alias("id"), x.alias("x"), *[c.alias(n) for n, c in more.items()])


def matrices(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the batch and their components ``floor(scale * x)``, for each length of vector that occurs."""
    column = batch.column("x")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
    ends = np.cumsum(sizes)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        at = (ends[rows] - size)[:, None] + np.arange(size)
        yield rows, flat[at]
