import datetime as dt
import json
import os
import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import drop
from tidemark.plans import refresh
from tidemark.plans.refresh import Refreshed, refresh_silver
from tidemark.plans.silver import bronze_to_silver
from tidemark.sources.bronze import read_bronze
from tidemark.sources.ledger import Ledger
from tidemark.sources.tables import read_silver
from tidemark.sources.variant import column_types, read_bronze_once, stage_bronze

JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def values(df):
    return sorted((tuple(r) for r in df.drop("processed_at").collect()), key=repr)


def same_reading(spark, root, slug="d"):
    once, twice = read_bronze_once(spark, str(root), slug, corrupt=True), read_bronze(spark, str(root), slug, corrupt=True)
    assert [(f.name, f.dataType) for f in once.schema] == [(f.name, f.dataType) for f in twice.schema]
    assert values(once) == values(twice)


def test_one_parse_reads_what_inference_reads(spark, tmp_path):
    rows = [
        {"Fecha Hora": "2024-01-01", "Código": 5, "v": 10.5, "x": {"a": 1, "b": [1, 2]}, "year": 1, "big": 2**70},
        {"Fecha Hora": None, "Código": 2**40, "v": 3, "`q": "s", "x": {"c": [{"d": 0.5}]}, 'a"b': True, "VARIANT": 1},
    ]
    drop(tmp_path, "d", JAN, JAN, rows)
    drop(tmp_path, "d", JAN, dt.date(2024, 1, 2), {"v": 2, "only": {"DECIMAL": 1.5, "VOID": None, "X y": [{"a`b": 1}]}})
    drop(tmp_path, "d", FEB, FEB, [])
    drop(tmp_path, "d-other", JAN, JAN, [{"never": 1}])
    folder = tmp_path / "2024" / "01"
    (folder / "d-2024-01-05_2024-01-05.json").write_text('[{"v": 1}, {"broken')
    (folder / "d-2024-01-06_2024-01-06.json").write_text('[1,"two",{"v":2}]')
    (folder / "d-2024-01-07_2024-01-07.json").write_text("")
    same_reading(spark, tmp_path)


def test_text_and_numbers_in_one_column_are_text(spark, tmp_path):
    drop(tmp_path, "d", JAN, JAN, [{"v": "x"}, {"v": 1}, {"v": [1]}, {"v": {"a": 2}}])
    got = read_bronze_once(spark, str(tmp_path), "d")
    assert got.schema["v"].dataType.simpleString() == "string"
    assert sorted(r.v for r in got.collect()) == ["1", "[1]", "x", '{"a":2}']
    drop(tmp_path, "e", JAN, JAN, [{"": 5}])  # a name that inference leaves out
    assert read_bronze_once(spark, str(tmp_path), "e").first()["column"] == 5


json_values = st.one_of(st.none(), st.booleans(), st.integers(-(2**60), 2**60), st.floats(-1e6, 1e6, width=32), st.text("aé\"'`:<, ", max_size=3))
json_rows = st.lists(st.dictionaries(st.sampled_from(["a", "b c", "é", "OBJECT", "d'e"]), st.lists(st.integers(0, 3)) | json_values, max_size=4), min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(json_rows)
def test_any_drop_keeps_its_values(spark, tmp_path_factory, rows):
    root = tmp_path_factory.mktemp("bronze")
    drop(root, "d", JAN, JAN, [{"k": i, **r} for i, r in enumerate(rows)])
    once, twice = read_bronze_once(spark, str(root), "d"), read_bronze(spark, str(root), "d")
    assert once.columns == twice.columns
    same = [f.name for f in once.schema if f.dataType == twice.schema[f.name].dataType and f.dataType.simpleString() != "string"]
    assert values(once.select(*same, "processed_at")) == values(twice.select(*same, "processed_at"))


def test_types_of_names_that_look_like_types():
    got = column_types("OBJECT<`a: VOID`: VOID, DECIMAL: DECIMAL(3,0), OBJECT: OBJECT<VARIANT: VARIANT>, v: ARRAY<DECIMAL(21,1)>, e: OBJECT<>>")
    kinds = {f.name: f.dataType.simpleString() for f in got}
    assert kinds == {"a: VOID": "string", "DECIMAL": "decimal(3,0)", "OBJECT": "struct<VARIANT:string>", "v": "array<double>", "e": "string"}
    assert not column_types(None).fields and not column_types("VOID").fields and not column_types("OBJECT<>").fields


def test_drops_are_scanned_once(spark, tmp_path):
    drop(tmp_path, "d", JAN, JAN, [{"v": 1}])
    folder, schema = stage_bronze(spark, str(tmp_path), "d")
    for name in (tmp_path / "2024" / "01").glob("*.json"):
        name.rename(tmp_path / name.name)  # gone from here on
    assert [f.name for f in schema] == ["v"]
    assert spark.read.parquet(folder).count() == 1


def state(spark, silver):
    return values(read_silver(spark, silver, "d").select("k", "v", "year", "month", "source_file", "processed_at"))


@pytest.mark.parametrize("declared", [True, False])
def test_refresh_equals_a_full_run(spark, tmp_path, declared):
    from pyspark.sql.types import StructType

    root, silver, full = tmp_path / "bronze", str(tmp_path / "silver"), tmp_path / "full"
    schemas = {"d": StructType.fromDDL("k long, v double")} if declared else {}

    def step(expected):
        assert refresh_silver(spark, str(root), silver, schemas=schemas, widen=True)["d"] == expected
        whole = str(full / str(len(list(full.glob("*")))))
        bronze_to_silver(spark, str(root), whole, schemas=schemas, widen=True)
        assert state(spark, silver) == state(spark, whole)

    drop(root, "d", JAN, JAN, [{"k": 1, "v": 1}, {"k": 2, "v": 2}])
    drop(root, "d", FEB, FEB, [{"k": 3, "v": 3}])
    step(Refreshed(2, 0, 3))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "silver" / "d").rglob("*.parquet")}
    step(Refreshed(0, 0, 0))
    drop(root, "d", JAN, dt.date(2024, 1, 2), [{"k": 4, "v": 4.5}])
    step(Refreshed(1, 0, 1))
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())  # only added to
    drop(root, "d", JAN, JAN, [{"k": 1, "v": 10}])
    step(Refreshed(1, 1, 2))
    february = [p for p in before if "month=2" in str(p)]
    assert february and all(p.stat().st_mtime_ns == before[p] for p in february)
    path = root / "2024" / "02" / "d-2024-02-01_2024-02-01.json"
    path.write_text(json.dumps([{"k": 3, "v": 7}]))  # same length
    os.utime(path, (1, 1))
    step(Refreshed(1, 1, 1))


def test_a_run_that_was_cut_short_is_made_good(spark, tmp_path, monkeypatch):
    root, silver = tmp_path / "bronze", str(tmp_path / "silver")
    drop(root, "d", JAN, JAN, [{"k": 1, "v": 1}])
    refresh_silver(spark, str(root), silver)
    drop(root, "d", JAN, dt.date(2024, 1, 2), [{"k": 2, "v": 2}])
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "close", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_silver(spark, str(root), silver)
    assert len(state(spark, silver)) == 2
    assert refresh_silver(spark, str(root), silver)["d"] == Refreshed(1, 0, 2)  # not added twice
    assert [r[0] for r in state(spark, silver)] == [1, 2]
    assert refresh_silver(spark, str(root), silver)["d"] == Refreshed(0, 0, 0)


def test_a_first_run_that_wrote_nothing_is_made_good(spark, tmp_path, monkeypatch):
    root, silver = tmp_path / "bronze", str(tmp_path / "silver")
    drop(root, "d", JAN, JAN, [{"k": 1, "v": 1}])
    with monkeypatch.context() as broken:
        broken.setattr("tidemark.plans.refresh.write_good", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_silver(spark, str(root), silver)
    assert refresh_silver(spark, str(root), silver)["d"].rows == 1
    assert [r[0] for r in state(spark, silver)] == [1]


def test_tables_are_refreshed_side_by_side(spark, tmp_path, monkeypatch):
    """Each waits for the other to have begun."""
    both, real = threading.Barrier(2, timeout=60), refresh._refresh

    def waits(*args):
        both.wait()
        return real(*args)

    monkeypatch.setattr(refresh, "_refresh", waits)
    for slug in ("d", "e"):
        drop(tmp_path / "bronze", slug, JAN, JAN, [{"v": slug}])
    silver = str(tmp_path / "silver")
    ran = refresh_silver(spark, str(tmp_path / "bronze"), silver, at_once=2)
    assert ran == {"d": Refreshed(1, 0, 1), "e": Refreshed(1, 0, 1)}
    assert [r.v for slug in ran for r in read_silver(spark, silver, slug).collect()] == ["d", "e"]
