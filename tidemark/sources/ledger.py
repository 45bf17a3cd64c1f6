"""Which bronze drops a silver table already holds: their place, length and time of change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import exists, removed
from tidemark.sources.bronze import bronze_files
from tidemark.sources.tables import dataset_path

LEDGER_FOLDER = "_ledger"
SCHEMA = "drop string, length long, modified timestamp, taken_at timestamp"


def drop_key(path: str | Column) -> Column:
    """A drop by its place below the root, ``YYYY/MM/<name>``, however the rest of the path is spelled."""
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, "([^/]+/[^/]+/[^/]+)$", 1)


class Ledger:
    """The ledger of one dataset. Drops that are about to be taken are noted as pending first: after a run that was
    cut short, some of them may be in the table, and none counts as taken."""

    def __init__(self, spark: SparkSession, target: str, slug: str):
        self.spark, self.slug = spark, slug
        self.path = f"{dataset_path(target, LEDGER_FOLDER)}/{slug}/taken"
        self.pending = f"{dataset_path(target, LEDGER_FOLDER)}/{slug}/pending"

    def is_new(self) -> bool:
        return not exists(self.spark, self.path)

    def was_cut_short(self) -> bool:
        return exists(self.spark, self.pending)

    def taken(self) -> DataFrame:
        """The latest entry of every drop."""
        if self.is_new():
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        last = rows.groupBy("drop").agg(F.max_by(F.struct("length", "modified", "taken_at"), "taken_at").alias("last"))
        return last.select("drop", "last.*")

    def due(self, source: str) -> DataFrame:
        """Drops under ``source`` that the table does not hold as they are now; ``known`` ones it holds in another
        form. Only paths, lengths and times are read."""
        found = bronze_files(self.spark, source, [self.slug], "modificationTime").withColumn("drop", drop_key("path"))
        held = self.taken().select("drop", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
        joined = found.join(held, "drop", "left").withColumnRenamed("modificationTime", "modified")
        same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
        due = joined.where(~F.coalesce(same, F.lit(False)))
        return due.select("drop", "path", "year", "month", "length", "modified", F.col("_length").isNotNull().alias("known"))

    def note(self, due: DataFrame) -> DataFrame:
        """Keep what is due, before anything of it is written; the drops as they were then."""
        due.write.mode("overwrite").parquet(self.pending)
        return self.spark.read.schema(due.schema).parquet(self.pending)

    def close(self) -> None:
        """Count the pending drops as taken."""
        noted = self.spark.read.parquet(self.pending).withColumn("taken_at", F.current_timestamp())
        noted.select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.mode("append").parquet(self.path)
        removed(self.spark, self.pending)
