"""Silver kept up to date: only drops that are new or changed are read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.silver import parsed_drops, write_good
from tidemark.session import exists, removed, scratch_path
from tidemark.sources.bronze import bronze_slugs
from tidemark.sources.ledger import Ledger, drop_key
from tidemark.sources.tables import dataset_path, read_silver, write_partitioned


@dataclass(frozen=True)
class Refreshed:
    """Drops that were read, those of them that replace rows, and the rows written."""

    drops: int
    changed: int
    rows: int


def refresh_silver(
    spark: SparkSession,
    source: str,
    target: str,
    slugs: Iterable[str] = (),
    schemas: Mapping[str, StructType] | None = None,
    widen: bool = False,
    at_once: int = 1,
) -> dict[str, Refreshed]:
    """Take into silver what came under ``source`` since the last refresh; the tables are those of
    ``bronze_to_silver`` over all drops.

    New drops are added to their partitions. Where a drop changed (its length or time), or the run before was cut
    short, the partitions of the drops are written again: rows of other drops as they are, and those of the
    drop anew. Rows of a drop that is gone stay. The paths of what is due reach the driver, unless the table is
    new; contents of other drops are not read. One refresh of a table runs at a time; ``at_once`` lets those of several
    tables overlap, so that a table of few drops leaves no cores idle.
    """
    schemas = schemas or {}
    found = bronze_slugs(spark, source, slugs)
    with ThreadPoolExecutor(max_workers=max(at_once, 1)) as pool:
        return dict(zip(found, pool.map(lambda slug: _refresh(spark, source, target, slug, schemas.get(slug), widen), found)))


def _refresh(spark: SparkSession, source: str, target: str, slug: str, schema: StructType | None, widen: bool) -> Refreshed:
    ledger, path = Ledger(spark, target, slug), dataset_path(target, slug)
    fresh, repeat = ledger.is_new(), ledger.was_cut_short()
    due = ledger.note(ledger.due(source))
    counts = due.agg(F.count(F.lit(1)).alias("drops"), F.count_if("known").alias("changed")).first()
    if not counts["drops"]:
        ledger.close()
        return Refreshed(0, 0, 0)
    paths = [] if fresh and not repeat else [r["path"] for r in due.select("path").collect()]
    with parsed_drops(spark, source, slug, schema, paths) as rows:
        if fresh and not repeat:
            written = write_good(rows, path, widen, lambda df: write_partitioned(df, path))
        elif not counts["changed"] and not repeat:
            written = write_good(rows, path, widen, lambda df: write_partitioned(df, path, append=True))
        else:
            written = write_good(rows, path, widen, lambda df: _replace(df, due, target, slug))
    ledger.close()
    return Refreshed(counts["drops"], counts["changed"], written)


def _replace(rows: DataFrame, due: DataFrame, target: str, slug: str) -> int:
    """Write the partitions of the drops that are ``due`` again, without those drops' old rows."""
    spark = rows.sparkSession
    if not exists(spark, dataset_path(target, slug)):  # the first run was cut short before it wrote
        return write_partitioned(rows, dataset_path(target, slug))
    months = [(r["year"], r["month"]) for r in due.select("year", "month").distinct().collect()]
    touched = reduce(or_, [(F.col("year") == y) & (F.col("month") == m) for y, m in months])
    old = read_silver(spark, target, slug).where(touched)
    kept = old.join(due.select(F.col("drop").alias("_drop")), drop_key(old["source_file"]) == F.col("_drop"), "left_anti")
    # Partitions cannot be read while they are replaced.
    folder = scratch_path(spark, "kept")
    kept.write.parquet(folder)
    both = rows.unionByName(spark.read.schema(kept.schema).parquet(folder), allowMissingColumns=True)
    try:
        return write_partitioned(both, dataset_path(target, slug))
    finally:
        removed(spark, folder)
