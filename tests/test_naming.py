from hypothesis import given, settings
from hypothesis import strategies as st
import pytest

from tidemark.functions.naming import (
    drop_other_labels,
    first_label,
    pivot_names,
    snake_name,
    unique_names,
    with_clean_names,
    with_prefix,
)


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("FechaHora", "fechahora"),
        ("Código Agente", "codigo_agente"),
        ("  valor (kWh) ", "valor_kwh"),
        ("1er valor", "col_1er_valor"),
        ("--", "column"),
        ("", "column"),
        ("日本", "column"),
        ("a__b", "a_b"),
        ("ﬁn", "fin"),
    ],
)
def test_snake_name(raw, clean):
    assert snake_name(raw) == clean


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=6), max_size=8))
def test_clean_names_are_unique_ascii(names):
    out = unique_names(map(snake_name, names))
    assert len(set(out)) == len(names)
    assert all(n.isascii() and n == n.lower() and not n[0].isdigit() for n in out)


def test_unique_names_count_repeats():
    assert unique_names(["x", "y", "x", "x"]) == ["x", "y", "x_2", "x_3"]
    assert unique_names(["x", "x", "x_2"]) == ["x", "x_3", "x_2"]


def test_s18_names_that_normalise_alike_stay_apart(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "a_b", "A-B"])
    out = with_clean_names(df)
    assert out.columns == ["a_b", "a_b_2", "a_b_3"]
    assert out.first() == (1, 2, 3)


def test_s19_category_named_like_an_aggregate_gets_a_suffix():
    assert pivot_names("d", ["total", None, "No Regulado"], ["d_total"]) == ["d_total_2", "d_null", "d_no_regulado"]


def test_s20_reserved_names_are_kept_as_raw(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Year", "raw_year", "valor"])
    assert with_clean_names(df, reserved=["year"]).columns == ["raw_year", "raw_year_2", "valor"]


def test_prefix_leaves_keys_alone(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["event_ts", "No Regulado", "x"])
    assert with_prefix(df, "p", ["event_ts"]).columns == ["event_ts", "p_no_regulado", "p_x"]


def test_labels(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["label_b", "label_a", "x"])
    assert first_label(df.columns) == "label_a"
    assert drop_other_labels(df, "label_b").columns == ["label_b", "x"]
    with pytest.raises(ValueError):
        first_label(["x"])
