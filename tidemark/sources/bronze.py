"""Bronze: multi-line JSON files under ``<root>/YYYY/MM/<slug>-<start>_<end>.json``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.naming import with_clean_names
from tidemark.functions.paths import BRONZE_GLOB_DAY, BRONZE_GLOB_DIR, bronze_path_fields

# The text of a document that is not what the schema says; NULL in all other rows.
_RAW_CORRUPT = "_tidemark_corrupt"
CORRUPT_COLUMN = "tidemark_corrupt"
METADATA_COLUMNS = ("source_file", "dataset_slug", "year", "month", "period_start", "period_end", "processed_at")


def bronze_files(spark: SparkSession, root: str, slugs: Iterable[str] = (), *more: str) -> DataFrame:
    """One row per bronze file with what its path says (and ``more`` of what Spark's ``binaryFile`` tells of it);
    other files are skipped. ``slugs`` empty means all datasets. Only paths are read, not contents. Spark's file index holds the list of paths on the
    driver, here and for every reader of these files: some hundreds of bytes for each drop."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(f"{root.rstrip('/')}/{BRONZE_GLOB_DIR}")
        .select("path", "length", *more)
        .withColumns(bronze_path_fields("path"))
        .where("dataset_slug IS NOT NULL")
    )
    wanted = sorted(set(slugs))
    return found.where(F.col("dataset_slug").isin(wanted)) if wanted else found


def bronze_datasets(files: DataFrame) -> DataFrame:
    """Files, bytes and covered period of each dataset."""
    return files.groupBy("dataset_slug").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.min("period_start").alias("first_day"),
        F.max("period_end").alias("last_day"),
    )


def bronze_slugs(spark: SparkSession, root: str, slugs: Iterable[str] = ()) -> list[str]:
    """Slugs with at least one file, in order. Finding none is an error. The driver gets one row per
    dataset, never the list of files."""
    slugs = tuple(slugs)
    try:
        rows = bronze_files(spark, root, slugs).select("dataset_slug").distinct().collect()
    except AnalysisException as error:  # an empty root matches no path at all
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    if not rows:
        raise FileNotFoundError(f"no bronze JSON under {root} for datasets: {', '.join(sorted(slugs)) or 'all'}")
    return sorted(r[0] for r in rows)


def bronze_glob(root: str, slug: str) -> str:
    """All drops of a dataset, and none of a longer slug that starts with it."""
    return f"{root.rstrip('/')}/{BRONZE_GLOB_DIR}/{slug}-{BRONZE_GLOB_DAY}_{BRONZE_GLOB_DAY}.json"


def read_bronze(
    spark: SparkSession,
    root: str,
    slug: str,
    schema: StructType | None = None,
    corrupt: bool = False,
    paths: Sequence[str] = (),
) -> DataFrame:
    """All files of one dataset (or those of ``paths``), with clean names and provenance columns.

    Files are found by a glob whose fixed-width dates keep a slug apart from longer slugs that start
    with it. Pass ``schema`` to spare the extra pass over all files that inference costs, and to get the
    same columns from every run. A document that cannot be read has no rows; with ``corrupt`` it is one
    row, whose text is in ``CORRUPT_COLUMN``.
    """
    drops = list(paths) or bronze_glob(root, slug)
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", _RAW_CORRUPT)
    if schema is None:
        schema = reader.json(drops).schema
    fields = [f for f in schema.fields if f.name != _RAW_CORRUPT]
    raw = reader.schema(StructType([*fields, StructField(_RAW_CORRUPT, StringType())])).json(drops)
    df = with_provenance(raw.select("*", raw.metadataColumn("_metadata").getField("file_path")), slug)
    return df if corrupt else readable(df)


def readable(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def with_provenance(raw: DataFrame, slug: str) -> DataFrame:
    """Clean the names and add ``METADATA_COLUMNS``; a raw column of such a name becomes ``raw_<name>``. The
    last column of ``raw`` is the path of the row's drop."""
    clean = with_clean_names(raw, reserved=METADATA_COLUMNS)
    names, path = clean.columns[:-1], "_tidemark_path"
    df = clean.toDF(*names, path)
    fields = bronze_path_fields(path)
    fields["dataset_slug"] = F.lit(slug)
    metadata = {"source_file": F.col(path), **fields, "processed_at": F.current_timestamp()}
    return df.select(*[f"`{n}`" for n in names], *[metadata[c].alias(c) for c in METADATA_COLUMNS])
