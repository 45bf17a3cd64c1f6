"""Check a gold table and fit the baseline forecasts on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.naming import first_label, label_columns
from tidemark.operators import models as M
from tidemark.operators import quality as Q
from tidemark.session import pin

# Columns whose means are compared over splits and months, besides the label.
FOCUS_COLUMNS = (
    "target_demanda_real",
    "demanda_comercial_total",
    "generacion_real_total",
    "aporte_hidrico_energia_total",
    "unidades_operacion",
)


@dataclass(frozen=True)
class AuditParams:
    time: str = "event_ts"
    label: str | None = None
    validation: float = 0.15
    test: float = 0.15
    latest: int = 0
    focus: tuple[str, ...] = FOCUS_COLUMNS
    alpha: float = 1.0
    forest: M.ForestParams = M.ForestParams()


def prepare(gold: DataFrame, params: AuditParams) -> tuple[DataFrame, str]:
    """The audited rows, pinned because every section reads them, with their split; and the label."""
    Q.check_split_sizes(params.validation, params.test)
    label = params.label or first_label(gold.columns)
    rows = pin(Q.audit_input(gold, params.time, label, params.latest))
    if rows.isEmpty():
        raise ValueError(f"no row has a valid {params.time} and a {label}")
    return Q.temporal_split(rows, [params.time], params.validation, params.test), label


# The models' names in the report.
MODELS = ("dummy_mean", "ridge_regression_scaled", "random_forest", "naive_persistence")


def with_predictions(
    rows: DataFrame,
    label: str,
    features: Sequence[str],
    params: AuditParams,
    models: Sequence[str] = MODELS,
    split: str = "split",
) -> tuple[DataFrame, dict[str, str]]:
    """Fit ``models`` on the train split; add one prediction column per model and name them. The naive
    forecast is left out when no feature can serve as one."""
    train = rows.where(F.col(split) == "train")
    columns = {}
    if "naive_persistence" in models and (naive := M.naive_column(label, features)):
        columns["naive_persistence"] = naive
    if "dummy_mean" in models:
        rows = rows.withColumn("_mean", F.lit(train.agg(F.avg(label)).first()[0]))
        columns["dummy_mean"] = "_mean"
    if "ridge_regression_scaled" in models or "random_forest" in models:
        medians = M.exact_medians(train, features)
        inputs = {f"_x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
        rows = M.assemble(rows.withColumns(inputs), list(inputs))
        train = rows.where(F.col(split) == "train")
    if "ridge_regression_scaled" in models:
        rows = M.fit_ridge(train, label, "_ridge", params.alpha).transform(rows)
        columns["ridge_regression_scaled"] = "_ridge"
    if "random_forest" in models:
        rows = M.fit_forest(train, label, "_forest", params.forest, [params.time]).transform(rows)
        columns["random_forest"] = "_forest"
    return rows, columns


def model_comparison(
    rows: DataFrame,
    label: str,
    params: AuditParams,
    models: Sequence[str] | None = None,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Scores of the models on the validation and test splits of ``rows`` (see ``prepare``). Default: all
    models on all feature columns."""
    features = features or Q.feature_columns(rows, label)
    scored, columns = with_predictions(rows, label, features, params, models or MODELS)
    return M.regression_metrics(scored.where("split != 'train'"), label, columns)


def audit_report(
    gold: DataFrame, params: AuditParams = AuditParams(), input_path: str | None = None
) -> dict[str, DataFrame]:
    """Every section of the report as a small DataFrame; write them with ``write_report``.

    NULLs, shape, splits and their means are one aggregate over the rows and the months another; the
    sections are cut from those two results.
    """
    rows, label = prepare(gold, params)
    audited = rows.drop("split")
    features = Q.feature_columns(audited, label)
    naive = M.naive_column(label, features)
    focus = Q.present(audited, [*params.focus[:1], label, *params.focus[1:]])
    ignored = [c for c in label_columns(gold.columns) if c != label]
    facts = pin(
        rows.agg(
            F.count(F.lit(1)).alias("_rows"),
            Q.null_counts(audited).alias("_nulls"),
            Q.split_facts(params.time).alias("_splits"),
            Q.means_by_split(focus).alias("_means"),
        )
    )
    monthly = pin(Q.monthly_means(audited, params.time, focus))
    shape = facts.select(
        F.lit(input_path).cast("string").alias("input_path"),
        F.lit(label).alias("target_column"),
        F.lit(params.time).alias("timestamp_column"),
        F.col("_rows").alias("rows"),
        F.lit(len(audited.columns)).alias("columns"),
        F.array(*map(F.lit, features)).alias("feature_columns"),
        F.array(*map(F.lit, ignored)).cast("array<string>").alias("ignored_label_columns"),
        F.lit(naive).cast("string").alias("naive_prediction_column"),
    )
    return {
        "dataset": shape,
        "granularity": Q.granularity(audited, params.time),
        "splits": facts.select(F.inline("_splits")),
        "top_null_columns": Q.ranked_nulls(facts, top=20),
        "null_summary": Q.ranked_nulls(facts),
        "split_feature_means": facts.select(F.inline("_means")).drop("_n"),
        "monthly_means": Q.latest_months(monthly, focus),
        "monthly_changes": Q.largest_changes(Q.monthly_changes(monthly, focus)),
        "models": model_comparison(rows, label, params),
    }
