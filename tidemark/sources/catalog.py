"""One catalog table per dataset folder."""

from __future__ import annotations

import logging
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from tidemark.functions.naming import snake_name
from tidemark.sources.tables import children, dataset_path

PLAN_SCHEMA = "table string, path string, action string"
ROOT_PROPERTY = "tidemark.root"
MISSING_PROPERTY = "tidemark.deprecated"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
AT_ONCE = 1_000  # partitions of one statement


def dataset_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly under ``root``: one listing call, one name per dataset."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def register_tables(
    spark: SparkSession, root: str, database: str, location: str | None = None, dry_run: bool = False
) -> DataFrame:
    """Make the catalog follow the dataset folders under ``root`` and return what was (to be) done.

    create: folder without a table. update: new columns are added to the table. replace: a column has
    another type now, and the table takes it; columns that no file has any more stay (a
    partition column's type is the exception: the entry is made anew). keep: nothing to do. Partitions
    follow the folders in all cases (``sync_partitions``). flag: the folder
    of a table registered from this root is gone; the table is marked, never dropped. failed: the files of
    this folder are no one table; the others are registered all the same. No folder at all is an error. The
    database is created when absent, at ``location`` if given.
    """
    folders = dataset_folders(spark, root)
    if not folders:
        raise FileNotFoundError(f"no dataset folders under {root}")
    db = f"`{database}`"
    have_db = spark.catalog.databaseExists(database)
    if not have_db and not dry_run:
        where = f"LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} {where}")
    existing = {t.name for t in spark.catalog.listTables(database)} if have_db else set()

    plan = []
    for folder in folders:
        name, path = snake_name(folder), dataset_path(root, folder)
        try:
            action = _follow(spark, f"{db}.`{name}`", path, root, name in existing, dry_run)
        except (PySparkException, Py4JJavaError) as error:  # files that no schema fits come as the latter
            logging.getLogger(__name__).warning("%s: %s", path, error)
            action = "failed"
        plan.append((name, path, action))

    present = {snake_name(f) for f in folders}
    for name in sorted(existing - present):
        table = f"{db}.`{name}`"
        if _properties(spark, table).get(ROOT_PROPERTY) == root:
            plan.append((name, None, "flag"))
            if not dry_run:
                spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{MISSING_PROPERTY}' = 'true')")
    return spark.createDataFrame(plan, PLAN_SCHEMA)


def _follow(spark: SparkSession, table: str, path: str, root: str, exists: bool, dry_run: bool) -> str:
    """Make one table fit the files under ``path``; returns what was (to be) done."""
    found = {f.name.lower(): f for f in spark.read.option("mergeSchema", True).parquet(path).schema}
    known = {f.name.lower(): f for f in spark.table(table).schema} if exists else {}
    changed = [n for n, f in known.items() if n in found and found[n].dataType != f.dataType]
    added = [f for n, f in found.items() if n not in known]
    action = "create" if not exists else "replace" if changed else "update" if added else "keep"
    if dry_run:
        return action
    anew = action == "replace" and bool(set(changed) & {c.lower() for c in _partition_columns(spark, table)})
    if anew:
        # Spark cannot alter a partition column. The table is external: only its entry goes, the files stay.
        spark.sql(f"DROP TABLE {table}")
    elif action == "replace":
        _swap_types(spark, table, {n: found[n] for n in changed})
    if action == "create" or anew:
        spark.sql(
            f"CREATE TABLE {table} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{path}' "
            f"TBLPROPERTIES ('{ROOT_PROPERTY}' = '{root}')"
        )
    elif added:  # beside a swap, too
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    if exists and not anew:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{MISSING_PROPERTY}')")
    sync_partitions(spark, table, path)
    spark.catalog.refreshTable(table)
    return action


def _partition_columns(spark: SparkSession, table: str) -> dict[str, str]:
    """Names and types, in order."""
    return {c.name: c.dataType for c in spark.catalog.listColumns(table) if c.isPartition}


def _swap_types(spark: SparkSession, table: str, found: dict) -> None:
    """Give columns of a table other types in one change of its entry, so that it is there at every moment. (SQL has no
    statement for it that file tables accept.)"""
    partitions = _partition_columns(spark, table)
    fields = [f for f in spark.table(table).schema if f.name not in partitions]
    schema = StructType([StructField(f.name, found[f.name.lower()].dataType if f.name.lower() in found else f.dataType) for f in fields])
    state = spark._jsparkSession.sessionState()
    state.catalog().alterTableDataSchema(
        state.sqlParser().parseTableIdentifier(table), spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    )


def sync_partitions(spark: SparkSession, table: str, path: str) -> tuple[int, int]:
    """Make the catalog's partitions of ``table`` those that have a folder under ``path``; returns how many were added
    and dropped.

    Only the difference is touched, in statements of ``AT_ONCE`` partitions. Names of partitions reach the driver, as
    they do for Spark's own file index. Dropping one never deletes files, since the table is external.
    """
    columns = _partition_columns(spark, table)
    if not columns:
        return 0, 0

    def spec(folders: str) -> tuple[str, ...]:
        values = {k.lower(): unquote(v) for k, v in (f.split("=", 1) for f in folders.split("/"))}
        given = [(values[c.lower()], kind) for c, kind in columns.items()]
        return tuple(str(int(v)) if kind in ("int", "bigint") and v != NO_VALUE else v for v, kind in given)

    def folders_in(at: str, depth: int) -> list[str]:
        names = [n for n, folder in children(spark, f"{path}/{at}".rstrip("/")) if folder and "=" in n]
        if depth == 1:
            return [f"{at}{n}" for n in names]
        return [f for n in names for f in folders_in(f"{at}{n}/", depth - 1)]

    def written(values: tuple[str, ...]) -> str:
        return "PARTITION (" + ", ".join(f"`{c}` = {'NULL' if v == NO_VALUE else quoted(v)}" for c, v in zip(columns, values)) + ")"

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    there = {spec(f): f for f in folders_in("", len(columns))}
    known = {spec(r["partition"]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    added, dropped = sorted(set(there) - known), sorted(known - set(there))
    for at in range(0, len(added), AT_ONCE):
        parts = " ".join(f"{written(v)} LOCATION {quoted(f'{path}/{there[v]}')}" for v in added[at : at + AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for at in range(0, len(dropped), AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(map(written, dropped[at : at + AT_ONCE]))}")
    return len(added), len(dropped)
