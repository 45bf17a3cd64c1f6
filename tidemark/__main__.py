"""Run a job from spark-submit: ``python -m tidemark silver|gold|audit|catalog …``."""

from __future__ import annotations

import argparse

from pyspark.sql.types import StructType

from tidemark.plans.audit import AuditParams, audit_report
from tidemark.plans.gold import electricity_demand, silver_to_gold
from tidemark.plans.silver import bronze_to_silver
from tidemark.session import spark_session
from tidemark.sources.catalog import register_tables
from tidemark.sources.tables import read_gold, write_report


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description="Hourly feature tables from raw JSON drops.")
    jobs = top.add_subparsers(dest="job", required=True)

    silver = jobs.add_parser("silver", help="bronze JSON to one Parquet table per dataset")
    silver.add_argument("--source", required=True)
    silver.add_argument("--target", required=True)
    silver.add_argument("--datasets", default="", help="comma-separated slugs; default all")
    silver.add_argument(
        "--schema",
        action="append",
        default=[],
        metavar="SLUG=DDL",
        help='columns of a dataset\'s JSON, e.g. "demand=Time string, Value double"; may be repeated',
    )
    silver.add_argument("--stock-schemas", action="store_true", help="declare the stock electricity datasets")
    silver.add_argument("--widen", action="store_true", help="write inferred whole numbers as doubles")

    gold = jobs.add_parser("gold", help="silver tables to the feature table")
    gold.add_argument("--source", required=True)
    gold.add_argument("--target", required=True)
    gold.add_argument("--target-dataset", default="demanda-real")
    gold.add_argument("--horizon-hours", type=int, default=24)
    gold.add_argument("--keep-incomplete", action="store_true")

    audit = jobs.add_parser("audit", help="check a feature table and fit baseline models")
    audit.add_argument("--input", required=True)
    audit.add_argument("--output", required=True)
    audit.add_argument("--time-column", default="event_ts")
    audit.add_argument("--label", default=None)
    audit.add_argument("--validation", type=float, default=0.15)
    audit.add_argument("--test", type=float, default=0.15)
    audit.add_argument("--latest", type=int, default=0, help="only the last N rows")

    catalog = jobs.add_parser("catalog", help="one catalog table per dataset folder")
    catalog.add_argument("--root", required=True)
    catalog.add_argument("--database", required=True)
    catalog.add_argument("--dry-run", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark_session(f"tidemark-{a.job}")
    if a.job == "silver":
        slugs = [s.strip() for s in a.datasets.split(",") if s.strip()]
        schemas = electricity_demand().bronze_schemas() if a.stock_schemas else {}
        for slug, _, ddl in (s.partition("=") for s in a.schema):
            schemas[slug.strip()] = StructType.fromDDL(ddl)
        for slug, rows in bronze_to_silver(spark, a.source, a.target, slugs, schemas, widen=a.widen).items():
            print(f"{slug}: {rows} rows")
    elif a.job == "gold":
        spec = electricity_demand(
            a.target_dataset, horizon_hours=a.horizon_hours, drop_incomplete=not a.keep_incomplete
        )
        print(f"{silver_to_gold(spark, a.source, a.target, spec)} rows")
    elif a.job == "audit":
        params = AuditParams(a.time_column, a.label, a.validation, a.test, a.latest)
        write_report(audit_report(read_gold(spark, a.input), params, a.input), a.output)
    else:
        for row in register_tables(spark, a.root, a.database, dry_run=a.dry_run).collect():
            print(f"{row['action']}: {row['table']}")


if __name__ == "__main__":
    main()
