"""Baseline forecasts with Spark MLlib, and their scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import keys_at, sorts_before, tie_columns
from tidemark.operators.quantiles import exact_quantiles


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of each column, NULLs skipped. A column without values is left out. All columns at once; two
    passes over ``df``, of which only the values around the middle are ordered."""
    rows = exact_quantiles(df, columns, [0.5]).collect()
    return {r["column"]: (r["lower"] + r["upper"]) / 2 for r in rows}


def fill_with(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Replace NULLs by the fitted values; the columns become double."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items()})


def fit_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column that has values."""
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns if row[f"m_{c}"] is not None}


def scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Z-scores. A constant column becomes 0."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s or 1.0) for c, (m, s) in fitted.items()})


def assemble(df: DataFrame, features: Sequence[str], output: str = "_features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(df)


def fit_ridge(train: DataFrame, label: str, prediction: str, alpha: float = 1.0):
    """Ridge on standardised features: minimise ``sum (y - y')^2 + alpha * |b|^2``.

    Spark divides the squared error by 2n and scales the label by its deviation as well, hence the
    conversion of ``alpha``. The normal-equation solver makes one pass and sends k x k sums to the
    driver, whatever the number of rows.
    """
    stats = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
    return LinearRegression(
        featuresCol="_features",
        labelCol=label,
        predictionCol=prediction,
        elasticNetParam=0.0,
        solver="normal",
        standardization=True,
        regParam=alpha * (stats["sd"] or 0.0) / max(stats["n"], 1),
    ).fit(train)


@dataclass(frozen=True)
class ForestParams:
    trees: int = 300
    depth: int = 14
    min_leaf: int = 2
    seed: int = 42


ROWS_PER_BLOCK = 100_000


def laid_out_by(df: DataFrame, order: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``df`` in blocks of about ``rows_per_block`` rows of neighbouring ``order``, sorted inside. Which rows
    make a block, and their sequence, depend on the rows alone and not on how ``df`` is partitioned."""
    order = [*order, *(c for c in tie_columns(df, order))]
    blocks: list[int] = []

    def cuts(rows: int) -> list[int]:
        blocks.append(max(-(-rows // rows_per_block), 1))
        return [rows * i // blocks[0] for i in range(1, blocks[0])]

    found = [b for b in keys_at(df, order[:1], cuts) if b]
    block = sum((F.when(sorts_before(df, b), 0).otherwise(1) for b in found), F.lit(0))
    return df.withColumn("_block", block).repartition(blocks[0], "_block").sortWithinPartitions("_block", *order).drop("_block")


def fit_forest(
    train: DataFrame, label: str, prediction: str, params: ForestParams = ForestParams(), order: Sequence[str] = ()
):
    """Bagging draws by partition and row number, so the rows are laid out by ``order`` first: the same rows
    then give the same forest, however they were partitioned."""
    train = laid_out_by(train, order) if order else train
    return RandomForestRegressor(
        featuresCol="_features",
        labelCol=label,
        predictionCol=prediction,
        numTrees=params.trees,
        maxDepth=params.depth,
        minInstancesPerNode=params.min_leaf,
        featureSubsetStrategy="all",
        seed=params.seed,
    ).fit(train)


def naive_column(label: str, features: Sequence[str]) -> str | None:
    """The column that serves as a persistence forecast of ``label_<target>_h_plus_<n>``: the target now,
    else a day ago."""
    if not label.startswith("label_"):
        return None
    target = label.removeprefix("label_").split("_h_plus_")[0]
    return next((c for c in (target, f"{target}_lag_24h") if c in features), None)


def regression_metrics(
    df: DataFrame, actual: str, predictions: dict[str, str], split: str = "split"
) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (in percent, zero actuals skipped) per split and model, where
    ``predictions`` maps a model's name to its column. All models are scored in the same aggregate; a
    pair with a NULL is skipped."""
    y = F.col(actual).cast("double")
    scores = []
    for model, column in predictions.items():
        p = F.col(column).cast("double")
        pair = y.isNotNull() & p.isNotNull()

        def over_pairs(c: Column, pair=pair) -> Column:
            return F.when(pair, c)

        n = F.count_if(pair)
        residual = F.sum(over_pairs((y - p) * (y - p)))
        spread = F.var_pop(over_pairs(y)) * n
        r2 = F.when(n < 2, None).when(spread != 0, 1 - residual / spread).when(residual == 0, 1.0).otherwise(0.0)
        mape = F.avg(over_pairs(F.abs(y - p) / F.abs(F.nullif(y, F.lit(0.0))))) * 100
        scores.append(
            F.struct(
                F.lit(model).alias("model"),
                n.alias("pairs"),
                F.round(F.avg(over_pairs(F.abs(y - p))), 6).alias("mae"),
                F.round(F.sqrt(F.avg(over_pairs((y - p) * (y - p)))), 6).alias("rmse"),
                F.round(r2, 6).alias("r2"),
                F.round(mape, 6).alias("mape_pct"),
            )
        )
    return df.groupBy(split).agg(F.array(*scores).alias("_scores")).select(split, F.inline("_scores"))
