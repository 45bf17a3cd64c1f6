"""Keep the latest published version of each fact."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numeric import version_rank

# Version codes of the published data, most final first.
VERSION_PRIORITY = ("TXR", "TXF", "TX7", "TX6", "TX5", "TX4", "TX3", "TX2", "TX1")


def _order(
    columns: Sequence[str], version: str, priority: tuple[str, ...], recency: Iterable[str], tie_break: Iterable[str], prefix: str = ""
) -> list[tuple[Column, bool]]:
    """What versions are ordered by, best first: (value, larger is better). NULLs are worst."""

    def newest(column: str) -> Column:
        # A processing time kept as text still has to sort as a time.
        c = F.col(prefix + column)
        return c.try_cast("timestamp") if column == "processed_at" else c

    order = [(version_rank(prefix + version, priority), True)]
    order += [(newest(c), True) for c in recency if c in columns]
    order.append((F.upper(F.col(prefix + version).cast("string")), True))
    return order + [(F.col(prefix + c), False) for c in tie_break]


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "version",
    priority: tuple[str, ...] = VERSION_PRIORITY,
    recency: Iterable[str] = ("processed_at", "source_file"),
    tie_break: Iterable[str] = (),
) -> DataFrame:
    """One row per key: best version rank, then latest ``recency`` columns, then version text, then
    ``tie_break`` (ascending). NULLs come last.

    Spark plans the ``row_number() = 1`` filter as a window group limit, which keeps one row per key in
    each map task *before* the shuffle. A key with any number of copies therefore sends at most one row
    per map task to its reducer.
    """
    present = [k for k in keys if k in df.columns]
    lost = [k for k in keys if k not in df.columns]
    if version not in df.columns or not present:
        return df
    if lost:
        warnings.warn(f"key columns {lost} are absent; facts that differ only there are merged", stacklevel=2)

    order = [
        c.desc_nulls_last() if larger else c.asc_nulls_last()
        for c, larger in _order(df.columns, version, priority, recency, tie_break)
    ]
    newest_first = Window.partitionBy(*present).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(newest_first)).where("_nth = 1").drop("_nth")


@dataclass(frozen=True)
class LatestTable:
    """The latest version of each fact, kept in a table that is bucketed by key.

    A drop is reduced to its own latest versions, laid out like the table, and joined to it bucket by bucket: the
    table is read where it lies and not shuffled, however large it is. The answer is ``latest_version`` over all
    rows that were ever taken, since the best of two bests is the best of all; of full equals the table's row stays.
    Facts with a NULL in a key, which a join does not match, are compared apart, and only they are shuffled.
    Give each bucket about as many bytes as a task sorts well; a drop may lack columns of the table but has no others.
    """

    table: str
    keys: tuple[str, ...]
    buckets: int
    version: str = "version"
    priority: tuple[str, ...] = VERSION_PRIORITY
    recency: tuple[str, ...] = ("processed_at", "source_file")
    tie_break: tuple[str, ...] = ()

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_version(rows, self.keys, self.version, self.priority, self.recency, self.tie_break)

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        # Reduced first: a key with any number of copies sends one row per map task.
        return self._latest(rows).repartition(self.buckets, *self.keys)

    def _write(self, rows: DataFrame, table: str, path: str) -> None:
        rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", path).saveAsTable(table)

    def create(self, rows: DataFrame, path: str) -> None:
        """Make the table from a first set of rows, at a new ``path``."""
        self._write(self._laid_out(rows), self.table, path)

    def with_drop(self, drop: DataFrame) -> DataFrame:
        """The table's rows as they are after ``drop``."""
        base = drop.sparkSession.table(self.table)
        if unknown := set(drop.columns) - set(base.columns):
            raise ValueError(f"columns that {self.table} does not have: {sorted(unknown)}")
        there = {f.name: f.dataType for f in base.schema}
        fitted = drop.select(*[F.col(c).cast(there[c]) if c in drop.columns else F.lit(None).cast(there[c]).alias(c) for c in there])
        whole = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
        loose = self._latest(base.where(~whole).union(fitted.where(~whole)))

        new = self._laid_out(fitted.where(whole)).select([F.col(c).alias(f"_new_{c}") for c in there])
        met = reduce(and_, [F.col(k) == F.col(f"_new_{k}") for k in self.keys])
        better = F.col(self.keys[0]).isNull() | (F.col(f"_new_{self.keys[0]}").isNotNull() & self._better(base.columns))
        merged = base.where(whole).join(new, met, "full_outer")
        return merged.select([F.when(better, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in there]).union(loose)

    def _better(self, columns: Sequence[str]) -> Column:
        """Whether the new row of a pair comes before the old one."""
        how = (columns, self.version, self.priority, self.recency, self.tie_break)
        wins = F.lit(False)
        for (old, larger), (new, _) in reversed(list(zip(_order(*how), _order(*how, prefix="_new_")))):
            ahead = new.isNotNull() & (old.isNull() | (new > old if larger else new < old))
            wins = F.when(new.eqNullSafe(old), wins).otherwise(ahead)
        return wins

    def take(self, drop: DataFrame, path: str) -> str:
        """Take ``drop`` into the table. Rows are written to the new ``path``, then the table points there: it is
        never gone or half written, and a run that is cut short leaves it as it was. Returns the folder that it
        pointed to, which may be deleted when nobody reads it any more."""
        spark = drop.sparkSession
        staged, old = f"{self.table}_{uuid.uuid4().hex}", location_of(spark, self.table)
        self._write(self.with_drop(drop), staged, path)
        spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{location_of(spark, staged)}'")
        spark.sql(f"DROP TABLE {staged}")  # external: only the entry goes
        spark.catalog.refreshTable(self.table)
        return old


def location_of(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]
