"""Bronze JSON -> one partitioned Parquet table per dataset."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import removed
from tidemark.sources.bronze import CORRUPT_COLUMN, METADATA_COLUMNS, bronze_slugs, read_bronze
from tidemark.sources.tables import PARTITIONS, dataset_path, fitted_to, whole_numbers_as_double, write_partitioned
from tidemark.sources.variant import stage_bronze, staged_rows

# Where documents that cannot be read are kept, beside the tables; no table and no catalog entry of its own.
CORRUPT_FOLDER = "_corrupt"


def bronze_to_silver(
    spark: SparkSession,
    source: str,
    target: str,
    slugs: Iterable[str] = (),
    schemas: Mapping[str, StructType] | None = None,
    rebalance: bool = True,
    at_once: int = 1,
    widen: bool = False,
) -> dict[str, int]:
    """Refresh the silver table of every dataset found (or of ``slugs``); returns rows per dataset.

    ``schemas`` declares datasets; for the others each run finds the columns while it parses. Columns take the types that the table
    already has; one whose values those do not hold is an error that names it, before anything is
    written. ``widen`` writes inferred whole numbers as doubles, for columns that may bring fractions later.

    Documents that cannot be read are counted while the rows are written; where there are any, they are
    kept under ``_corrupt/<slug>`` (see ``corrupt_documents``) and a warning says how many.

    Each dataset is its own distributed job, taken in slug order; ``at_once`` lets small ones overlap.
    A partition that a rerun no longer has rows for keeps its old rows.
    """
    schemas = schemas or {}

    def refresh(slug: str) -> int:
        path = dataset_path(target, slug)
        with parsed_drops(spark, source, slug, schemas.get(slug)) as rows:
            return write_good(rows, path, widen and slug not in schemas, lambda df: write_partitioned(df, path, rebalance=rebalance))

    found = bronze_slugs(spark, source, slugs)
    with ThreadPoolExecutor(max_workers=max(at_once, 1)) as pool:
        return dict(zip(found, pool.map(refresh, found)))


@contextmanager
def parsed_drops(
    spark: SparkSession, source: str, slug: str, schema: StructType | None, paths: Sequence[str] = ()
) -> Iterator[DataFrame]:
    """Rows of a dataset's drops with ``CORRUPT_COLUMN``. Without a schema the drops are parsed once into the shared
    folder, and what was parsed is deleted in the end."""
    if schema is not None:
        yield read_bronze(spark, source, slug, schema, corrupt=True, paths=paths)
        return
    folder, found = stage_bronze(spark, source, slug, paths)
    try:
        yield staged_rows(spark, folder, slug, found)
    finally:
        removed(spark, folder)


def write_good(rows: DataFrame, path: str, widen: bool, write: Callable[[DataFrame], int]) -> int:
    """Hand the rows that could be read to ``write``, in the types of the table at ``path``. Documents that could not
    be are counted on the way and kept under ``_corrupt``."""
    seen = Observation()
    counted = rows.observe(seen, F.count(CORRUPT_COLUMN).alias("corrupt"))
    good = counted.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    if widen:
        good = whole_numbers_as_double(good, keep=METADATA_COLUMNS)
    written = write(fitted_to(good, path, keep=PARTITIONS))
    if bad := seen.get["corrupt"]:
        target, slug = path.rsplit("/", 1)
        logging.getLogger(__name__).warning("%s: %d documents could not be read", slug, bad)
        texts = rows.where(F.col(CORRUPT_COLUMN).isNotNull())
        parsed = F.to_json(F.struct(*(c for c in rows.columns if c not in (CORRUPT_COLUMN, *METADATA_COLUMNS))))
        texts = texts.select(
            "source_file", "dataset_slug", F.col(CORRUPT_COLUMN).alias("text"), parsed.alias("parsed"), "processed_at"
        )
        texts.write.mode("overwrite").parquet(f"{dataset_path(target, CORRUPT_FOLDER)}/{slug}")
    return written


def corrupt_documents(spark: SparkSession, target: str, slug: str) -> DataFrame:
    """Documents of the last run of ``slug`` that had any that could not be read: source_file,
    dataset_slug, text, parsed (what could be read of it, as JSON), processed_at."""
    return spark.read.parquet(f"{dataset_path(target, CORRUPT_FOLDER)}/{slug}")
