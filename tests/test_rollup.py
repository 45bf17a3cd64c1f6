import pytest
from pyspark.sql import functions as F

from tidemark.functions.numeric import guarded_ratio, round_even
from tidemark.operators.rollup import (
    DistinctCount,
    PivotRows,
    PivotTotal,
    Total,
    categories,
    distinct_rows,
    rollup,
    rollup_with_row_pivot,
)

FACTS = "h int, agent string, market string, valor double"


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        (1, "a", "Regulado", 1.0),
        (1, "a", "REGULADO", 2.0),
        (1, "b", None, 4.0),
        (1, None, "total", 8.0),
        (2, "a", "Regulado", None),
        (3, "a", "No Regulado", 16.0),
    ]
    return spark.createDataFrame(rows, FACTS)


def by_key(df, key="h"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_totals_distincts_and_pivot_in_one_row(facts):
    out = rollup(
        facts, ["h"], [Total("valor", "d_total")], [DistinctCount("agent", "d_agentes")], PivotTotal("valor", "market", "d")
    )
    # NULL category first, then text order; look-alikes and clashes are told apart (S7, S19).
    assert out.columns == [
        "h", "d_total", "d_agentes", "d_null", "d_no_regulado", "d_regulado", "d_regulado_2", "d_total_2",
    ]
    got = by_key(out)
    assert got[1] == {
        "h": 1, "d_total": 15.0, "d_agentes": 2, "d_null": 4.0, "d_no_regulado": None,
        "d_regulado": 2.0, "d_regulado_2": 1.0, "d_total_2": 8.0,
    }
    assert got[2]["d_total"] is None and got[2]["d_agentes"] == 1


def test_s5_every_variable_and_unit_adds_to_the_total(spark):
    df = spark.createDataFrame([(1, "V1", 1.0), (1, "V2", 2.0)], "h int, codigovariable string, valor double")
    assert rollup(df, ["h"], [Total("valor", "t")]).first()["t"] == 3.0


def test_s6_missing_cells_are_null(facts):
    got = by_key(rollup(facts, ["h"], pivot=PivotTotal("valor", "market", "d", ("No Regulado",))))
    assert got[1]["d_no_regulado"] is None and got[3]["d_no_regulado"] == 16.0


def test_facts_are_added_up_once_however_many_categories(facts):
    """The aggregate over the facts has one sum; the categories only meet its result."""
    for values in (("Regulado",), tuple(f"c{i}" for i in range(50))):
        out = rollup(facts, ["h"], [Total("valor", "t")], pivot=PivotTotal("valor", "market", "d", values))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "pivotfirst" in plan.lower()
        lowest = [line for line in plan.splitlines() if "Aggregate [h#" in line and "market" in line]
        assert lowest and all(line.count("sum(") == 1 for line in lowest)


def test_pivot_with_null_period_and_given_categories(spark):
    rows = [(None, "a", 1.0), (None, "a", 2.0), (None, None, 4.0), (1, "b", 8.0)]
    df = spark.createDataFrame(rows, "h int, c string, v double")
    out = rollup(df, ["h"], [Total("v", "t")], [DistinctCount("c", "n")], PivotTotal("v", "c", "p", ("b", None, "a")))
    assert out.columns == ["h", "t", "n", "p_b", "p_null", "p_a"]
    assert {r.h: tuple(r)[1:] for r in out.collect()} == {None: (7.0, 1, None, 4.0, 3.0), 1: (8.0, 1, 8.0, None, None)}


def test_members_are_compared_with_their_types(spark):
    rows = [(1, 0.0, ["a, b"], "c"), (1, -0.0, ["a", "b"], "c"), (1, 1.0, None, "c")]
    df = spark.createDataFrame(rows, "h int, x double, xs array<string>, kind string")
    counts = [DistinctCount("x", "nx"), DistinctCount("xs", "nxs")]
    mix = rollup_with_row_pivot(df, ["h"], counts, PivotRows(("x", "kind"), "kind", "p")).first()
    plain = rollup(df, ["h"], distincts=counts).first()
    assert (mix.nx, mix.nxs, mix.p_c) == (plain.nx, plain.nxs, 2) == (2, 2, 2)


def test_s22_bad_numbers_are_null_not_errors(spark):
    df = spark.createDataFrame([(1, "x"), (1, "2.5"), (2, "")], "h int, valor string")
    assert {r["h"]: r["t"] for r in rollup(df, ["h"], [Total("valor", "t")]).collect()} == {1: 2.5, 2: None}


def test_exact_sums_do_not_depend_on_row_order(spark):
    df = spark.range(10_000).select(F.lit(1).alias("h"), (F.col("id") / 100).alias("v"))
    sums = {rollup(df.repartition(n), ["h"], [Total("v", "t")], exact="decimal(18,2)").first()["t"] for n in (1, 3, 7)}
    assert sums == {499950.0}


UNITS = "d int, unit string, plant string, state string, kind string"


@pytest.fixture(scope="module")
def units(spark):
    rows = [
        (1, "u1", "p1", "OPERACION", "Hidro"),
        (1, "u1", "p1", "operacion", "Hidro"),
        (1, "u1", "p1", "operacion", "Solar"),
        (1, "u2", "p1", "Operación", "Hidro"),
        (1, "u3", None, None, None),
        (1, None, "p2", " operacion", "Hidro"),
        (2, None, None, "operacion", "Solar"),
    ]
    return spark.createDataFrame(rows, UNITS)


COUNTS = [
    DistinctCount("unit", "unidades_total"),
    DistinctCount("plant", "plantas_total"),
    DistinctCount("unit", "unidades_operacion", where="lower(state) = 'operacion'"),
]


def test_s8_s9_unit_mix(units):
    out = rollup_with_row_pivot(units, ["d"], COUNTS, PivotRows(("unit", "kind"), "kind", "tipo"))
    got = by_key(out, "d")
    # A NULL unit is a row of its type but not a unit; only the unaccented spelling is in operation.
    assert got[1] == {
        "d": 1, "unidades_total": 3, "plantas_total": 2, "unidades_operacion": 1,
        "tipo_null": 1, "tipo_hidro": 3, "tipo_solar": 1,
    }
    assert got[2] == {
        "d": 2, "unidades_total": 0, "plantas_total": 0, "unidades_operacion": 0,
        "tipo_null": None, "tipo_hidro": None, "tipo_solar": 1,
    }


def test_unit_mix_agrees_with_the_conditional_distinct_form(units):
    mix = rollup_with_row_pivot(units, ["d"], COUNTS, PivotRows(("unit", "kind"), "kind", "tipo", ("Hidro",)))
    plain = rollup(units, ["d"], distincts=COUNTS)
    assert mix.drop("tipo_hidro").exceptAll(plain).isEmpty()


def test_category_lookup_is_bounded(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    spark.conf.set("spark.sql.pivotMaxValues", "20")
    try:
        with pytest.raises(ValueError, match="more than 20"):
            categories(df, "c")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 6), (2, "x", 7)], "a int, b string, c int")
    assert distinct_rows(df, ["a", "b"]).count() == 2


def test_s14_ratio_guard(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(guarded_ratio("a", "b")).collect()] == [0.5, None, None, None]


def test_round_even(spark):
    df = spark.createDataFrame([(3.125,), (3.375,), (-3.125,), (2.0,)], "x double")
    assert [r[0] for r in df.select(round_even(F.col("x"), 2)).collect()] == [3.12, 3.38, -3.12, 2.0]


def test_pivot_as_rows_equals_the_columns_read_back(facts):
    pivot = PivotTotal("valor", "market", "d")
    wide = rollup(facts, ["h"], [Total("valor", "d_total")], [DistinctCount("agent", "d_agentes")], pivot)
    keys = ["h", "d_total", "d_agentes"]
    for values in (None, ("Regulado", None, "other")):
        pivot = PivotTotal("valor", "market", "d", values)
        wide = rollup(facts, ["h"], [Total("valor", "d_total")], [DistinctCount("agent", "d_agentes")], pivot)
        want = wide.unpivot(keys, [c for c in wide.columns if c not in keys], "cell", "v")
        got = rollup(facts, ["h"], [Total("valor", "d_total")], [DistinctCount("agent", "d_agentes")], pivot, as_rows=("cell", "v"))
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_pivot_as_rows_has_no_limit_of_categories(spark):
    df = spark.range(50).select(F.lit(1).alias("h"), F.col("id").alias("c"), F.lit(2.0).alias("v"))
    df = df.union(spark.createDataFrame([(2, 7, 3.0), (2, None, 4.0)], "h int, c long, v double"))
    spark.conf.set("spark.sql.pivotMaxValues", "20")
    try:
        got = rollup(df, ["h"], [Total("v", "t")], pivot=PivotTotal("v", "c", "p"), as_rows=("cell", "value")).collect()
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    assert len(got) == 2 * 51 and {r.t for r in got} == {100.0, 7.0}
    assert {(r.h, r.cell): r.value for r in got if r.value not in (None, 2.0)} == {(2, "p_col_7"): 3.0, (2, "p_null"): 4.0}
