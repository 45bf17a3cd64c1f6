"""Run queries and their SQL on the same tables and compare values. Usage: oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, name, sf_dir):
    """A list of differences, empty when the results agree."""
    df = driver.queries()[name](spark, str(sf_dir))
    got_columns, got = normal(df.columns, df.collect())
    relation = con.sql(driver.oracle_sql()[name])
    want_columns, want = normal(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return [f"columns {sorted(set(got_columns) ^ set(want_columns))}"]
    if len(got) != len(want):
        return [f"rows {len(got)} instead of {len(want)}"]
    out = []
    for g, w in zip(got, want):
        out += [f"{c}: {a!r} instead of {b!r}" for c, a, b in zip(got_columns, g, w) if repr(a) != repr(b)]
        if len(out) > 5:
            break
    return out


if __name__ == "__main__":
    from conftest import make_spark

    sf = DATA / (sys.argv[1] if len(sys.argv) > 1 else "sf0.01")
    names = sys.argv[2:] or list(driver.queries())
    spark, con, bad = make_spark(), duck(sf), 0
    for name in names:
        start = time.time()
        try:
            if name in driver.oracle_sql():
                found = compare(spark, con, name, sf)
            else:
                found = [] if driver.queries()[name](spark, str(sf)).collect() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if not found else found[:4]}", flush=True)
    print("queries that differ:", bad)
