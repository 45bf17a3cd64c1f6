"""Parquet tables partitioned by year and month: silver datasets and gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITIONS = ("year", "month")


def dataset_path(root: str, slug: str) -> str:
    return f"{root.rstrip('/')}/{slug}"


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what lies directly under ``path``, without hidden names; empty if it is no
    folder. One listing call."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
        return []
    listed = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(at)]
    return sorted((n, d) for n, d in listed if not n.startswith(("_", ".")))


def read_union(spark: SparkSession, path: str) -> DataFrame:
    """All rows under ``path`` with every column that any file has. Folders named ``key=value`` are
    partitions and become columns; plain subfolders are read as well, each with partitions of its own."""
    reader = spark.read.option("mergeSchema", True)
    plain = [n for n, folder in children(spark, path) if folder and "=" not in n]
    if not plain:
        return reader.parquet(path)
    own = [f"{path}/{n}" for n, folder in children(spark, path) if not folder or "=" in n]
    parts = [reader.option("basePath", path).parquet(*own)] if own else []
    parts += [read_union(spark, f"{path}/{n}") for n in plain]
    out = parts[0]
    for part in parts[1:]:
        out = _same_types(out, part).unionByName(_same_types(part, out), allowMissingColumns=True)
    return out


def _same_types(df: DataFrame, other: DataFrame) -> DataFrame:
    theirs = {f.name: f.dataType for f in other.schema}
    casts = {}
    for f in df.schema:
        if f.name in theirs and (wide := wider(f.dataType, theirs[f.name])) not in (None, f.dataType):
            casts[f.name] = F.col(f"`{f.name}`").cast(wide)
    return df.withColumns(casts) if casts else df


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both, or None. Whole numbers grow with their size; a whole number
    and a fraction are a double."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, whole) and isinstance(b, whole):
        return a if whole.index(type(a)) > whole.index(type(b)) else b
    if isinstance(a, (*whole, T.FloatType, T.DoubleType)) and isinstance(b, (*whole, T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return None


def read_silver(spark: SparkSession, root: str, slug: str) -> DataFrame:
    return read_union(spark, dataset_path(root, slug))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder of Parquet; partition folders become columns."""
    return read_union(spark, path)


def fitted_to(df: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` with its columns in the types that the table at ``path`` has, so that the files stay one table.

    Fewer columns than the table has, or more, are fine. A column that does not fit, because the table's type
    does not hold its values, is an error that names it: nothing has been written then.
    """
    spark = df.sparkSession
    if not children(spark, path):
        return df
    there = {f.name.lower(): f.dataType for f in read_union(spark, path).schema}
    casts, bad = {}, []
    for f in df.schema:
        wanted = there.get(f.name.lower())
        if wanted is None or wanted == f.dataType or f.name in keep:
            continue
        if wider(f.dataType, wanted) == wanted or isinstance(f.dataType, T.NullType):
            casts[f.name] = F.col(f"`{f.name}`").cast(wanted)
        else:
            bad.append(f"{f.name}: {f.dataType.simpleString()} into {wanted.simpleString()}")
    if bad:
        raise TypeError(f"columns that do not fit the table at {path}: {', '.join(bad)}; declare a schema for it")
    return df.withColumns(casts) if casts else df


def whole_numbers_as_double(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Inferred whole numbers as doubles: the next run may find fractions in the same column."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast("double")
        for f in df.schema
        if isinstance(f.dataType, (T.IntegerType, T.LongType)) and f.name not in keep
    }
    return df.withColumns(casts) if casts else df


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str] = PARTITIONS, rebalance: bool = True, append: bool = False
) -> int:
    """Write Parquet, replacing only the partitions ``df`` has rows for (or adding to them with ``append``), and
    return the rows written.

    ``rebalance`` gathers each partition's rows into files of a good size; a partition that is much
    larger than the rest is split over several tasks at run time. Without it, every task writes its own
    file into every partition it meets. Rows are counted while they are written, after that shuffle, so
    nothing is read twice and a retried task is not counted twice.
    """
    laid_out = df.hint("rebalance", *partition_by) if rebalance else df
    written = Observation()
    (
        laid_out.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("append" if append else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return written.get["rows"]


def write_report(sections: Mapping[str, DataFrame], path: str, csv: Sequence[str] = ("null_summary",)) -> None:
    """One folder per section: JSON, or CSV with a header for the sections named in ``csv``. Sections are
    a few rows each, so one file is right; they are written side by side."""

    def write(name: str) -> None:
        writer = sections[name].coalesce(1).write.mode("overwrite")
        target = f"{path.rstrip('/')}/{name}"
        if name in csv:
            writer.option("header", True).csv(target)
        else:
            writer.option("ignoreNullFields", False).json(target)

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, sections))
