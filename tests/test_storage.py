import shutil
import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from fixtures import drop
from tidemark.functions.paths import bronze_path_fields
from tidemark.plans.silver import bronze_to_silver, corrupt_documents
from tidemark.sources.bronze import METADATA_COLUMNS, bronze_datasets, bronze_files, bronze_slugs, read_bronze
from tidemark.sources.catalog import MISSING_PROPERTY, register_tables, sync_partitions
from tidemark.sources.tables import read_gold, read_silver, write_partitioned, write_report

JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    drop(root, "demanda", JAN, dt.date(2024, 1, 31), [{"Año": 1, "Valor": "x", "year": 1999}, {"Año": 2}])
    drop(root, "demanda", FEB, dt.date(2024, 2, 29), [{"Año": 3, "Valor": "2.5"}])
    drop(root, "demanda-real", JAN, dt.date(2024, 1, 31), [{"a b": 1, "a_b": 2, "lista": [1, 2], "obj": {"X y": 1}}])
    (root / "2024" / "01" / "Notes.json").write_text("[]")
    (root / "2024" / "01" / "demanda-2024-01-01.json").write_text("[]")
    nested = root / "2024" / "01" / "deeper"
    nested.mkdir()
    (nested / "demanda-2024-01-01_2024-01-31.json").write_text('[{"a": 1}]')
    return str(root)


def test_path_fields(spark):
    good, bad = "/2019/01/x/2024/02/a-b-2024-02-01_2024-02-29.json", "/2024/02/A-2024-02-01_2024-02-29.json"
    df = spark.createDataFrame([(good,), (bad,)], "path string")
    got = df.select(*[c.alias(n) for n, c in bronze_path_fields("path").items()]).collect()
    assert tuple(got[0]) == ("a-b", 2024, 2, FEB, dt.date(2024, 2, 29))
    assert tuple(got[1]) == (None,) * 5


def test_discovery_groups_and_skips(spark, bronze):
    got = {r.dataset_slug: r for r in bronze_datasets(bronze_files(spark, bronze)).collect()}
    assert {k: r.files for k, r in got.items()} == {"demanda": 2, "demanda-real": 1}
    assert (got["demanda"].first_day, got["demanda"].last_day) == (JAN, dt.date(2024, 2, 29))
    assert bronze_slugs(spark, bronze, ["demanda-real", "gone"]) == ["demanda-real"]


def test_finding_nothing_is_an_error(spark, bronze, tmp_path):
    with pytest.raises(FileNotFoundError, match="gone"):
        bronze_slugs(spark, bronze, ["gone"])
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError, match="all"):
        bronze_slugs(spark, str(tmp_path / "empty"))


def test_a_slug_does_not_take_the_files_of_a_longer_one(spark, bronze):
    df = read_bronze(spark, bronze, "demanda")
    # S20: the raw "year" does not fight with the partition column.
    assert df.columns == ["ano", "valor", "raw_year", *METADATA_COLUMNS]
    rows = sorted(df.collect(), key=lambda r: r.ano)
    assert [(r.ano, r.raw_year, r.year, r.month, r.period_start) for r in rows] == [
        (1, 1999, 2024, 1, JAN), (2, None, 2024, 1, JAN), (3, None, 2024, 2, FEB),
    ]
    assert all(r.source_file.endswith(".json") and r.dataset_slug == "demanda" and r.processed_at for r in rows)


def test_nested_values_stay_nested_and_schema_can_be_given(spark, bronze):
    df = read_bronze(spark, bronze, "demanda-real")
    assert df.columns[:4] == ["a_b", "a_b_2", "lista", "obj"]
    assert df.select("lista", "obj").first() == ([1, 2], (1,))
    schema = T.StructType([T.StructField("a b", T.StringType())])
    assert read_bronze(spark, bronze, "demanda-real", schema).first()["a_b"] == "1"


def test_silver_job_counts_rows_and_writes_partitions(spark, bronze, tmp_path):
    silver = str(tmp_path / "silver")
    assert bronze_to_silver(spark, bronze, silver, at_once=2) == {"demanda": 3, "demanda-real": 1}
    assert (tmp_path / "silver" / "demanda" / "year=2024" / "month=2").is_dir()
    assert read_silver(spark, silver, "demanda").where("month = 1").count() == 2
    assert bronze_to_silver(spark, bronze, silver, ["demanda-real"], rebalance=False) == {"demanda-real": 1}


def test_s17_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2023, 1)], "v int, year int, month int")
    assert write_partitioned(rows, path) == 3
    again = spark.createDataFrame([(9, 2024, 2), (8, 2024, 2)], "v int, year int, month int")
    assert write_partitioned(again, path) == 2
    assert sorted(r.v for r in read_gold(spark, path).collect()) == [1, 3, 8, 9]


def test_s21_rows_are_counted_in_the_write(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("id", "2024 AS year", "1 AS month").mapInArrow(count, "id long, year int, month int")
    assert write_partitioned(df, str(tmp_path / "t")) == 100
    assert seen.value == 100


@pytest.mark.parametrize("rebalance", [True, False])
def test_writing_no_rows_counts_none(spark, tmp_path, rebalance):
    df = spark.range(10).selectExpr("id", "2024 AS year", "1 AS month").where("id < 0")
    assert write_partitioned(df, str(tmp_path / "t"), rebalance=rebalance) == 0


def test_rebalance_splits_a_dominant_partition(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(60_000, numPartitions=6).selectExpr("id", "sha2(string(id), 256) AS s", "2024 AS year", "1 AS month")
        write_partitioned(df, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "year=2024" / "month=1").glob("*.parquet"))) > 3


def test_report_files(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "column string, null_pct double")
    write_report({"null_summary": df, "splits": df}, str(tmp_path))
    (csv,) = (tmp_path / "null_summary").glob("*.csv")
    assert csv.read_text().splitlines() == ["column,null_pct", "a,"]
    (js,) = (tmp_path / "splits").glob("*.json")
    assert json.loads(js.read_text()) == {"column": "a", "null_pct": None}


def test_catalog_follows_the_folders(spark, tmp_path):
    root, db = tmp_path / "silver", "follow_folders"
    kwargs = {"location": str(tmp_path / "db")}

    def plan(**extra):
        return {r.table: r.action for r in register_tables(spark, str(root), db, **kwargs, **extra).collect()}

    with pytest.raises(FileNotFoundError):
        plan()
    one = spark.createDataFrame([(1, 2024, 1)], "v int, year int, month int")
    write_partitioned(one, str(root / "demanda-real"))
    write_partitioned(one, str(root / "other"))
    assert plan(dry_run=True) == {"demanda_real": "create", "other": "create"}
    assert not spark.catalog.databaseExists(db)
    assert plan() == {"demanda_real": "create", "other": "create"}
    assert spark.table(f"{db}.demanda_real").count() == 1
    assert plan() == {"demanda_real": "keep", "other": "keep"}

    wider = spark.createDataFrame([(2, "x", 2024, 2)], "v int, extra string, year int, month int")
    write_partitioned(wider, str(root / "demanda-real"))
    assert plan() == {"demanda_real": "update", "other": "keep"}
    got = {(r.v, r.extra) for r in spark.table(f"{db}.demanda_real").collect()}
    assert got == {(1, None), (2, "x")}

    (root / "other").rename(tmp_path / "elsewhere")
    assert plan() == {"demanda_real": "keep", "other": "flag"}
    flags = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {db}.other").collect()}
    assert flags[MISSING_PROPERTY] == "true"
    (tmp_path / "elsewhere").rename(root / "other")
    assert plan() == {"demanda_real": "keep", "other": "keep"}
    flags = {r.key for r in spark.sql(f"SHOW TBLPROPERTIES {db}.other").collect()}
    assert MISSING_PROPERTY not in flags


def test_a_later_run_may_bring_fractions_and_columns(spark, tmp_path):
    root, silver = tmp_path / "bronze", str(tmp_path / "silver")
    drop(root, "d", JAN, JAN, [{"k": 1, "v": 1}, {"k": 2, "v": 2}])
    bronze_to_silver(spark, str(root), silver, widen=True)
    later = tmp_path / "later"
    drop(later, "d", FEB, FEB, [{"k": 3, "v": 1.5, "more": "x"}])
    bronze_to_silver(spark, str(later), silver)
    got = read_silver(spark, silver, "d").orderBy("k").collect()
    assert [(r.k, r.v, r.more) for r in got] == [(1.0, 1.0, None), (2.0, 2.0, None), (3.0, 1.5, "x")]


def test_a_column_that_does_not_fit_is_named_before_anything_is_written(spark, tmp_path):
    root, silver = tmp_path / "bronze", str(tmp_path / "silver")
    drop(root, "d", JAN, JAN, [{"k": 1, "v": 1}])
    bronze_to_silver(spark, str(root), silver)
    later = tmp_path / "later"
    drop(later, "d", FEB, FEB, [{"k": 3, "v": 1.5}])
    with pytest.raises(TypeError, match="v: double into bigint"):
        bronze_to_silver(spark, str(later), silver)
    assert [r.v for r in read_silver(spark, silver, "d").collect()] == [1]
    schema = T.StructType.fromDDL("k long, v double")
    other = str(tmp_path / "declared")
    for source in (root, later):
        bronze_to_silver(spark, str(source), other, schemas={"d": schema})
    assert sorted(r.v for r in read_silver(spark, other, "d").collect()) == [1.0, 1.5]


@pytest.mark.parametrize("declared", [True, False])
def test_documents_that_cannot_be_read_are_kept_and_counted(spark, bronze, tmp_path, caplog, declared):
    bad = tmp_path / "bronze" / "2024" / "01" / "demanda-2024-01-01_2024-01-30.json"
    bad.write_text('[{"A\u00f1o": 7, "Valor')
    schemas = {"demanda": T.StructType.fromDDL("`A\u00f1o` long, Valor string, year long")} if declared else {}
    silver = str(tmp_path / "silver")
    assert bronze_to_silver(spark, bronze, silver, schemas=schemas) == {"demanda": 3, "demanda-real": 1}
    assert "demanda: 1 documents could not be read" in caplog.text
    assert "tidemark_corrupt" not in read_silver(spark, silver, "demanda").columns
    kept = corrupt_documents(spark, silver, "demanda").collect()
    assert [(r.text, r.source_file.endswith(bad.name)) for r in kept] == [(bad.read_text(), True)]


def test_gold_is_the_union_of_its_files_and_plain_subfolders(spark, tmp_path):
    path = str(tmp_path / "gold")
    write_partitioned(spark.createDataFrame([(1, 2024, 1)], "a int, year int, month int"), path)
    write_partitioned(spark.createDataFrame([(2, 5.0, 2024, 2)], "a int, b double, year int, month int"), path)
    write_partitioned(spark.createDataFrame([(3, 7, 2023, 1)], "a int, b int, year int, month int"), f"{path}/old")
    got = read_gold(spark, path).orderBy("a").collect()
    assert [(r.a, r.b, r.year, r.month) for r in got] == [(1, None, 2024, 1), (2, 5.0, 2024, 2), (3, 7.0, 2023, 1)]


def test_catalog_follows_changed_types_and_survives_a_broken_folder(spark, tmp_path):
    root, db = tmp_path / "silver", "follow_types"

    def plan():
        return {r.table: r.action for r in register_tables(spark, str(root), db, str(tmp_path / "db")).collect()}

    write_partitioned(spark.createDataFrame([(1, 2024, 1)], "v int, year int, month int"), str(root / "a"))
    assert plan() == {"a": "create"}
    spark.createDataFrame([(1.5, 2024, 1)], "v double, year int, month int").write.mode("overwrite").partitionBy("year", "month").parquet(str(root / "a"))
    for month, kind in ((1, "int"), (2, "string")):
        one = spark.createDataFrame([(1, 2024, month)], "v int, year int, month int").selectExpr(f"CAST(v AS {kind}) v", "year", "month")
        one.write.mode("append").partitionBy("year", "month").parquet(str(root / "b"))
    write_partitioned(spark.createDataFrame([(1, 2024, 1)], "v int, year int, month int"), str(root / "c"))
    assert plan() == {"a": "replace", "b": "failed", "c": "create"}
    assert [r.v for r in spark.table(f"{db}.a").collect()] == [1.5] and spark.table(f"{db}.c").count() == 1


def test_partitions_follow_the_folders_by_difference(spark, tmp_path):
    root, db = tmp_path / "silver", "follow_partitions"
    place = str(root / "a")
    rows = [(1, 2024, "x y"), (2, 2024, "it's"), (3, None, "a/b=c"), (4, 2025, None), (5, 2025, "back\\slash")]
    df = spark.createDataFrame(rows, "v int, year int, kind string")
    write_partitioned(df.where("v < 4"), place, ("year", "kind"))
    register_tables(spark, str(root), db, str(tmp_path / "db"))
    values = lambda: sorted(r.v for r in spark.table(f"{db}.a").collect())
    assert values() == [1, 2, 3]
    write_partitioned(df.where("v >= 4"), place, ("year", "kind"))
    shutil.rmtree(root / "a" / "year=2024" / "kind=x y", ignore_errors=False)
    assert sync_partitions(spark, f"`{db}`.`a`", place) == (2, 1)
    spark.catalog.refreshTable(f"{db}.a")
    assert values() == [2, 3, 4, 5]
    assert sync_partitions(spark, f"`{db}`.`a`", place) == (0, 0)


def test_a_changed_type_never_takes_the_table_away(spark, tmp_path, monkeypatch):
    root, db, statements = tmp_path / "silver", "swap_types", []
    write_partitioned(spark.createDataFrame([(1, "k", 2024, 1)], "v int, w string, year int, month int"), str(root / "a"))
    register_tables(spark, str(root), db, str(tmp_path / "db"))
    write_partitioned(spark.createDataFrame([(2.5, 7, 2024, 1)], "v double, z int, year int, month int"), str(root / "a"))
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (statements.append(text), sql(self, text, *a, **k))[1])
    assert register_tables(spark, str(root), db, str(tmp_path / "db")).first()["action"] == "replace"
    assert not any("DROP TABLE" in s or "CREATE TABLE" in s for s in statements)
    assert [r.asDict() for r in spark.table(f"{db}.a").collect()] == [{"v": 2.5, "w": None, "z": 7, "year": 2024, "month": 1}]


def test_a_partition_column_of_another_type(spark, tmp_path):
    root, db = tmp_path / "silver", "partition_types"
    write_partitioned(spark.createDataFrame([(1, 2024)], "v int, year int"), str(root / "a"), ("year",))
    register_tables(spark, str(root), db, str(tmp_path / "db"))
    write_partitioned(spark.createDataFrame([(2, "x")], "v int, year string"), str(root / "a"), ("year",))
    assert register_tables(spark, str(root), db, str(tmp_path / "db")).first()["action"] == "replace"
    assert sorted((r.v, r.year) for r in spark.table(f"{db}.a").collect()) == [(1, "2024"), (2, "x")]
