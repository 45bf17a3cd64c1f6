"""Bronze to gold over invented data, against a plain Python calculation."""

import datetime as dt
import statistics
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fixtures import GAPS, HOURS, START, market_data, write_bronze
from tidemark.operators.models import ForestParams
from tidemark.plans.audit import AuditParams, audit_report
from tidemark.plans.gold import electricity_demand, gold_features, silver_to_gold
from tidemark.plans.silver import bronze_to_silver
from tidemark.sources.tables import read_gold, read_silver

T = "target_demanda_real"
RANK = {v: i for i, v in enumerate(reversed("TXR TXF TX7 TX6 TX5 TX4 TX3 TX2 TX1".split()), 1)}


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    write_bronze(root / "bronze")
    counts = bronze_to_silver(spark, str(root / "bronze"), str(root / "silver"))
    assert counts == {slug: len(rows) for slug, rows in market_data().items()}
    return str(root / "silver")


@pytest.fixture(scope="module")
def sources(spark, silver):
    return {s.dataset: read_silver(spark, silver, s.dataset) for s in electricity_demand().sources}


@pytest.fixture(scope="module")
def all_hours(sources):
    rows = gold_features(sources, electricity_demand(drop_incomplete=False)).orderBy("event_ts").collect()
    return rows


def latest(rows, keys):
    best = {}
    for r in rows:
        key = tuple(r.get(k) for k in keys)
        if key not in best or RANK.get(r["Version"].upper(), 0) > RANK.get(best[key]["Version"].upper(), 0):
            best[key] = r
    return best.values()


def hour_of(row):
    try:
        return (dt.datetime.fromisoformat(row["FechaHora"]) - START) // dt.timedelta(hours=1)
    except (TypeError, ValueError):
        return None


DEMAND_KEYS = ("FechaHora", "CodigoSICAgente", "TipoMercado", "CodigoVariable", "CodigoDuracion", "UnidadMedida")


@pytest.fixture(scope="module")
def expected():
    data = market_data()
    target = [None] * HOURS
    cells = {}
    for r in latest(data["demanda-real"], DEMAND_KEYS):
        h = hour_of(r)
        if h is not None:
            target[h] = (target[h] or 0) + r["Valor"]
            cells[h, r["TipoMercado"]] = cells.get((h, r["TipoMercado"]), 0) + r["Valor"]
    commercial = [0.0] * HOURS
    for r in data["demanda-comercial"]:
        if hour_of(r) < HOURS:
            commercial[hour_of(r)] += r["Valor"]
    return target, cells, commercial


def test_one_row_per_hour_of_the_target(all_hours):
    # S10: the later hour that only the commercial data has does not appear.
    assert [r.event_ts for r in all_hours] == [START + dt.timedelta(hours=i) for i in range(HOURS)]


def test_target_and_markets(all_hours, expected):
    target, cells, _ = expected
    for i, r in enumerate(all_hours):
        assert r[T] == (None if i in GAPS else pytest.approx(target[i]))
        assert r[f"{T}_agentes"] == (None if i in GAPS else 3)
        for market, name in (("Regulado", "regulado"), ("No Regulado", "no_regulado"), (None, "null")):
            assert r[f"{T}_{name}"] == (None if i in GAPS else pytest.approx(cells[i, market]))


def test_commercial_market_called_total_keeps_its_own_column(all_hours, expected):
    for r, total in zip(all_hours, expected[2]):
        assert r.demanda_comercial_total == pytest.approx(total)
        parts = r.demanda_comercial_regulado + r.demanda_comercial_no_regulado + r.demanda_comercial_total_2
        assert parts == pytest.approx(total)


def test_lags_rolling_and_label(all_hours, expected):
    target = [None if i in GAPS else v for i, v in enumerate(expected[0])]
    for i, r in enumerate(all_hours):
        assert r[f"label_{T}_h_plus_24"] == (target[i + 24] if i + 24 < HOURS else None)
        for n in (1, 24, 168):
            assert r[f"{T}_lag_{n}h"] == (target[i - n] if i >= n else None)
        for n in (24, 168):
            window = [v for v in target[max(0, i - n) : i] if v is not None]
            assert r[f"{T}_rolling_mean_{n}h"] == (pytest.approx(statistics.fmean(window)) if window else None)
        day = [v for v in target[max(0, i - 24) : i] if v is not None]
        assert r[f"{T}_rolling_stddev_24h"] == (pytest.approx(statistics.stdev(day)) if len(day) > 1 else None)
        assert r.demanda_comercial_total_lag_24h == (all_hours[i - 24].demanda_comercial_total if i >= 24 else None)
        assert r.generacion_real_total_lag_24h == (all_hours[i - 24].generacion_real_total if i >= 24 else None)


def test_generation_and_daily_figures(all_hours):
    for i, r in enumerate(all_hours):
        d = i // 24
        assert (r.generacion_real_plantas, r.generacion_real_agentes) == (3, 3)
        assert (r.aporte_hidrico_energia_total, r.aporte_hidrico_regiones) == (20.0 + 2 * d, 2)
        historic = {3: 0, 4: None}.get(d, 80.0)
        assert r.aporte_hidrico_media_historica_total == historic
        # S14: no ratio without a denominator.
        assert r.aporte_hidrico_vs_media_ratio == ((20.0 + 2 * d) / 80.0 if historic else None)
        assert (r.unidades_total, r.plantas_total, r.unidades_operacion) == (3, 2, 1)
        assert r.unidades_operacion_share == pytest.approx(1 / 3)
        assert (r.unidades_tipo_hidro, r.unidades_tipo_solar, r.unidades_tipo_null) == (3, 1, 1)


def test_calendar_and_bookkeeping(all_hours):
    for r in all_hours:
        assert (r.event_date, r.event_hour) == (r.event_ts.date(), r.event_ts.hour)
        assert (r.year, r.month) == (2024, 1) and r.processed_at is not None


def test_s16_incomplete_hours_are_dropped(spark, silver, all_hours, tmp_path):
    path = str(tmp_path / "gold")
    spec = electricity_demand()
    required = [T, spec.label, f"{T}_lag_24h", f"{T}_lag_168h", *spec.required]
    want = [r.event_ts for r in all_hours if all(r[c] is not None for c in required)]
    assert 0 < len(want) < HOURS
    assert silver_to_gold(spark, silver, path, spec) == len(want)
    gold = read_gold(spark, path)
    assert [r.event_ts for r in gold.orderBy("event_ts").collect()] == want


def test_other_targets_horizons_and_blocks(sources, all_hours):
    spec = electricity_demand(horizon_hours=3, block_hours=None, drop_incomplete=False)
    assert spec.label == f"label_{T}_h_plus_3"
    rows = gold_features(sources, spec).orderBy("event_ts").collect()
    assert [r[spec.label] for r in rows] == [r[T] for r in all_hours[3:]] + [None] * 3
    other = electricity_demand("demanda-comercial", drop_incomplete=False)
    out = gold_features(sources, other)
    assert other.label == "label_target_demanda_comercial_h_plus_24"
    assert "target_demanda_comercial_regulado" in out.columns and len(set(out.columns)) == len(out.columns)
    # This target reaches to the hour only it knows.
    assert out.count() == HOURS + 6
    with pytest.raises(ValueError):
        electricity_demand(horizon_hours=0)


def test_s4_hydrology_is_not_deduplicated(sources):
    spec = electricity_demand(drop_incomplete=False)
    doubled = {**sources, "aporte-hidricos": sources["aporte-hidricos"].union(sources["aporte-hidricos"])}
    first = gold_features(doubled, spec).orderBy("event_ts").first()
    assert first.aporte_hidrico_energia_total == 40.0


def test_s23_empty_target_gives_an_empty_table(sources):
    empty = {**sources, "demanda-real": sources["demanda-real"].where(F.lit(False))}
    assert gold_features(empty, electricity_demand(drop_incomplete=False)).count() == 0


def test_no_window_over_the_whole_table(sources):
    plan = gold_features(sources, electricity_demand())._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    assert windows and "hashpartitioning(_block" in plan
    for i in windows:  # what a window stands on: the first shuffle below it
        below = next(line for line in lines[i:] if "Exchange" in line)
        assert "SinglePartition" not in below


def test_every_source_is_read_once(spark, sources):
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = store.executionsCount()
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        gold_features(sources, electricity_demand()).collect()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    ran = store.executionsList()
    plans = [ran.apply(i).physicalPlanDescription() for i in range(ran.size()) if ran.apply(i).executionId() >= before]
    for s in electricity_demand().sources:
        assert sum(p.count(f"/{s.dataset}]") for p in plans) == 1, s.dataset


def test_a_target_column_is_cleaned_like_any_name(sources):
    spec = electricity_demand(drop_incomplete=False)
    target = replace(spec.target, totals=(replace(spec.target.totals[0], alias="Target X"),))
    odd = replace(spec, target=target, target_column="Target X", required=("Demanda Comercial total",))
    assert odd.label == "label_target_x_h_plus_24"
    out = gold_features(sources, replace(odd, drop_incomplete=True))
    assert {"target_x", "target_x_lag_24h", odd.label} <= set(out.columns) and out.count() > 0


def test_a_session_zone_with_clock_changes_changes_nothing(spark, sources, all_hours):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = gold_features(sources, electricity_demand(drop_incomplete=False)).drop("processed_at").orderBy("event_ts").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in rows] == [tuple(v for k, v in r.asDict().items() if k != "processed_at") for r in all_hours]


def test_audit_report_sections(sources):
    gold = gold_features(sources, electricity_demand(drop_incomplete=False)).drop("processed_at")
    gold = gold.withColumn("label_other", F.lit(1.0))
    params = AuditParams(forest=ForestParams(trees=5))
    got = {k: v.collect() for k, v in audit_report(gold, params).items()}
    # The first label in name order is the target; the other one is dropped.
    assert got["dataset"][0].target_column == "label_other"
    params = AuditParams(label=f"label_{T}_h_plus_24", forest=ForestParams(trees=5))
    got = {k: v.collect() for k, v in audit_report(gold, params).items()}
    dataset = got["dataset"][0]
    rows = HOURS - 24 - len([g for g in GAPS if g >= 24])
    assert (dataset.rows, dataset.ignored_label_columns) == (rows, ["label_other"])
    assert dataset.naive_prediction_column == T and T in dataset.feature_columns
    assert got["granularity"][0].missing_timestamp_count == 3
    assert sum(r["rows"] for r in got["splits"]) == rows
    assert len(got["top_null_columns"]) == 20 and len(got["null_summary"]) == dataset["columns"]
    assert {(r.split, r.model) for r in got["models"]} == {
        (s, m)
        for s in ("validation", "test")
        for m in ("dummy_mean", "ridge_regression_scaled", "random_forest", "naive_persistence")
    }
    assert [r.event_month for r in got["monthly_means"]] == ["2024-01"] and not got["monthly_changes"]
    assert {r.split for r in got["split_feature_means"]} == {"train", "validation", "test"}


def test_audit_needs_rows(spark):
    gold = spark.createDataFrame([("never", 1.0, 2.0)], "event_ts string, label_x double, a double")
    with pytest.raises(ValueError, match="label_x"):
        audit_report(gold)
