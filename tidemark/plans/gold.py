"""Silver datasets -> one wide hourly feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.naming import snake_name, unique_names
from tidemark.functions.numeric import guarded_ratio
from tidemark.functions.time import calendar_fields, to_day, to_wall_clock
from tidemark.operators.combine import attach_daily, left_fold
from tidemark.operators.lags import Rolling, Shift, lag_columns
from tidemark.operators.rollup import (
    DistinctCount,
    PivotRows,
    PivotTotal,
    Total,
    rollup,
    rollup_with_row_pivot,
)
from tidemark.operators.spine import dense_spine
from tidemark.operators.versions import VERSION_PRIORITY, latest_version
from tidemark.session import pin
from tidemark.sources.tables import read_silver, write_partitioned


@dataclass(frozen=True)
class SourceSpec:
    """How one silver dataset becomes one row per hour or day. ``version_keys`` empty: no versions."""

    dataset: str
    time: str
    distincts: tuple[DistinctCount, ...]
    totals: tuple[Total, ...] = ()
    pivot: PivotTotal | PivotRows | None = None
    version_keys: tuple[str, ...] = ()
    bronze_schema: str | None = None  # of its JSON drops, as DDL; None: inferred


@dataclass(frozen=True)
class Ratio:
    numerator: str
    denominator: str
    alias: str


@dataclass(frozen=True)
class GoldSpec:
    target: SourceSpec
    target_column: str
    hourly: tuple[SourceSpec, ...] = ()
    daily: tuple[SourceSpec, ...] = ()
    ratios: tuple[Ratio, ...] = ()
    day_lag_columns: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    horizon_hours: int = 24
    drop_incomplete: bool = True
    version_priority: tuple[str, ...] = VERSION_PRIORITY
    tie_break: Mapping[str, Sequence[str]] = field(default_factory=dict)
    exact_sums: str | None = None
    daily_lag_days: int = 0
    block_hours: int | None = 2016

    def __post_init__(self):
        if self.horizon_hours <= 0:
            raise ValueError("the label horizon must be at least one hour")
        # Lags and label are made after the names of the folded sources are cleaned.
        object.__setattr__(self, "target_column", snake_name(self.target_column))
        for name in ("day_lag_columns", "required"):
            object.__setattr__(self, name, tuple(map(snake_name, getattr(self, name))))

    @property
    def label(self) -> str:
        return f"label_{self.target_column}_h_plus_{self.horizon_hours}"

    def bronze_schemas(self) -> dict[str, StructType]:
        """Declared schemas by dataset, for ``bronze_to_silver``."""
        return {s.dataset: StructType.fromDDL(s.bronze_schema) for s in self.sources if s.bronze_schema}

    @property
    def sources(self) -> tuple[SourceSpec, ...]:
        return (self.target, *self.hourly, *self.daily)

    def features(self) -> list[Shift | Rolling]:
        t = self.target_column
        return [
            Shift(t, -self.horizon_hours, self.label),
            *[Shift(t, n, f"{t}_lag_{n}h") for n in (1, 24, 168)],
            Rolling(t, "mean", 24, f"{t}_rolling_mean_24h"),
            Rolling(t, "stddev", 24, f"{t}_rolling_stddev_24h"),
            Rolling(t, "mean", 168, f"{t}_rolling_mean_168h"),
            *[Shift(c, 24, f"{c}_lag_24h") for c in self.day_lag_columns],
        ]


# Raw columns of the stock datasets. Codes and times are text, measures are doubles.
_DEMAND_SCHEMA = (
    "FechaHora string, CodigoSICAgente string, TipoMercado string, CodigoVariable string, CodigoDuracion string, "
    "UnidadMedida string, Version string, Valor double"
)
_PLANT_SCHEMA = (
    "FechaHora string, CodigoPlanta string, CodigoSICAgente string, CodigoVariable string, CodigoDuracion string, "
    "UnidadMedida string, Version string, Valor double"
)
_WATER_SCHEMA = (
    "Fecha string, RegionHidrologica string, AportesHidricosEnergia double, MediaHistoricaEnergia double, "
    "PromedioAcumuladoEnergia double"
)
_UNIT_SCHEMA = (
    "Fecha string, CodigoUnidadGeneracion string, CodigoPlanta string, EstadoRecurso string, TipoGeneracion string"
)


def electricity_demand(target_dataset: str = "demanda-real", **overrides) -> GoldSpec:
    """The stock spec: hourly electricity demand with commercial demand, generation, hydrology and
    generating units as features. The strings are fixed values: dataset, source and output names."""
    target = f"target_{snake_name(target_dataset)}"
    demand_keys = ("fechahora", "codigosicagente", "tipomercado", "codigovariable", "codigoduracion", "unidadmedida")
    plant_keys = ("fechahora", "codigoplanta", "codigosicagente", "codigovariable", "codigoduracion", "unidadmedida")
    spec = GoldSpec(
        target=SourceSpec(
            target_dataset,
            "fechahora",
            totals=(Total("valor", target),),
            distincts=(DistinctCount("codigosicagente", f"{target}_agentes"),),
            pivot=PivotTotal("valor", "tipomercado", target),
            version_keys=demand_keys,
            bronze_schema=_DEMAND_SCHEMA,
        ),
        target_column=target,
        hourly=(
            SourceSpec(
                "demanda-comercial",
                "fechahora",
                totals=(Total("valor", "demanda_comercial_total"),),
                distincts=(DistinctCount("codigosicagente", "demanda_comercial_agentes"),),
                pivot=PivotTotal("valor", "tipomercado", "demanda_comercial"),
                version_keys=demand_keys,
                bronze_schema=_DEMAND_SCHEMA,
            ),
            SourceSpec(
                "generacion-real",
                "fechahora",
                totals=(Total("valor", "generacion_real_total"),),
                distincts=(
                    DistinctCount("codigoplanta", "generacion_real_plantas"),
                    DistinctCount("codigosicagente", "generacion_real_agentes"),
                ),
                version_keys=plant_keys,
                bronze_schema=_PLANT_SCHEMA,
            ),
        ),
        daily=(
            SourceSpec(
                "aporte-hidricos",
                "fecha",
                totals=(
                    Total("aporteshidricosenergia", "aporte_hidrico_energia_total"),
                    Total("mediahistoricaenergia", "aporte_hidrico_media_historica_total"),
                    Total("promedioacumuladoenergia", "aporte_hidrico_promedio_acumulado_total"),
                ),
                distincts=(DistinctCount("regionhidrologica", "aporte_hidrico_regiones"),),
                bronze_schema=_WATER_SCHEMA,
            ),
            SourceSpec(
                "unidades-generacion",
                "fecha",
                distincts=(
                    DistinctCount("codigounidadgeneracion", "unidades_total"),
                    DistinctCount("codigoplanta", "plantas_total"),
                    DistinctCount(
                        "codigounidadgeneracion", "unidades_operacion", where="lower(estadorecurso) = 'operacion'"
                    ),
                ),
                pivot=PivotRows(("codigounidadgeneracion", "tipogeneracion"), "tipogeneracion", "unidades_tipo"),
                bronze_schema=_UNIT_SCHEMA,
            ),
        ),
        ratios=(
            Ratio("aporte_hidrico_energia_total", "aporte_hidrico_media_historica_total", "aporte_hidrico_vs_media_ratio"),
            Ratio("unidades_operacion", "unidades_total", "unidades_operacion_share"),
        ),
        day_lag_columns=("demanda_comercial_total", "generacion_real_total"),
        required=(
            "demanda_comercial_total",
            "generacion_real_total",
            "aporte_hidrico_energia_total",
            "unidades_total",
        ),
    )
    return replace(spec, **overrides)


def fold_source(df: DataFrame, source: SourceSpec, key: str, spec: GoldSpec) -> DataFrame:
    """One row per ``key`` (``event_ts`` or ``event_date``). Rows whose time cannot be read are left out:
    they can match no hour."""
    if source.version_keys:
        df = latest_version(
            df,
            source.version_keys,
            priority=spec.version_priority,
            tie_break=spec.tie_break.get(source.dataset, ()),
        )
    parse = to_wall_clock if key == "event_ts" else to_day
    facts = df.withColumn(key, parse(source.time)).where(F.col(key).isNotNull())
    if isinstance(source.pivot, PivotRows):
        return rollup_with_row_pivot(facts, [key], source.distincts, source.pivot)
    return rollup(facts, [key], source.totals, source.distincts, source.pivot, spec.exact_sums)


def gold_features(sources: Mapping[str, DataFrame], spec: GoldSpec) -> DataFrame:
    """The feature table: latest versions -> hourly and daily folds -> spine -> joins -> calendar and
    ratios -> lags and label -> complete rows. ``sources`` maps dataset slug to silver rows.

    Facts are reduced to one row per hour before anything is joined, so all steps after the folds work
    on the time range and not on the data. The target's fold is pinned, since the spine's bounds come from
    it as well; so every source is read once.
    """
    folded = {s.dataset: fold_source(sources[s.dataset], s, "event_ts", spec) for s in spec.hourly}
    target_hourly = pin(fold_source(sources[spec.target.dataset], spec.target, "event_ts", spec))
    dailies = [fold_source(sources[s.dataset], s, "event_date", spec) for s in spec.daily]

    hourly = left_fold(dense_spine(target_hourly, "event_ts"), [target_hourly, *(folded[s.dataset] for s in spec.hourly)], ["event_ts"])
    wide = attach_daily(hourly, dailies, "event_ts", spec.daily_lag_days)
    wide = wide.withColumns(
        calendar_fields("event_ts") | {r.alias: guarded_ratio(r.numerator, r.denominator) for r in spec.ratios}
    )
    wide = wide.toDF(*unique_names(map(snake_name, wide.columns)))
    wide = lag_columns(wide, spec.features(), "event_ts", block_hours=spec.block_hours, on_spine=True, exact=spec.exact_sums)
    if spec.drop_incomplete:
        t = spec.target_column
        wide = wide.dropna(subset=[t, spec.label, f"{t}_lag_24h", f"{t}_lag_168h", *spec.required])
    return wide.withColumns(
        {"year": F.year("event_ts"), "month": F.month("event_ts"), "processed_at": F.current_timestamp()}
    )


def silver_to_gold(spark: SparkSession, silver: str, gold: str, spec: GoldSpec) -> int:
    """Build gold from the silver tables under ``silver`` and write it; returns the rows written."""
    sources = {s.dataset: read_silver(spark, silver, s.dataset) for s in spec.sources}
    # A row per hour is small: no layout shuffle is worth its cost.
    return write_partitioned(gold_features(sources, spec), gold, rebalance=False)
