"""The feature table, built from the events table cast in the roles of the five silver datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.time import hour_floor
from tidemark.plans.gold import electricity_demand, gold_features
from tidemark.workload.facts import CENTS, EVENT_TYPES
from tidemark.workload.registry import query, table
from tidemark.workload.series import rolling_sql


def demo_spec(horizon_hours: int = 24, **overrides):
    return electricity_demand(
        horizon_hours=horizon_hours,
        exact_sums=CENTS,
        tie_break={d: ("event_id",) for d in ("demanda-real", "demanda-comercial", "generacion-real")},
        **overrides,
    )


def silver_roles(spark, sf_dir):
    """Events as silver rows. Two events of one user, type and hour are versions of one fact; the version
    code comes from the number in ``props`` and includes lower-case and unknown codes."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    version = F.when(k >= 90, "TXR").when(k >= 80, "txf").otherwise(F.concat(F.lit("TX"), F.right(k.cast("string"), F.lit(1))))
    versioned = events.select(
        "event_id",
        hour_floor("ts").alias("fechahora"),
        F.to_date("ts").alias("fecha"),
        F.col("user_id").cast("string").alias("user"),
        "event_type",
        F.lit("V1").alias("codigovariable"),
        F.lit("PT1H").alias("codigoduracion"),
        F.lit("kWh").alias("unidadmedida"),
        version.alias("version"),
        "value",
        "k",
        "user_id",
    )
    common = ["event_id", "fechahora", "codigovariable", "codigoduracion", "unidadmedida", "version"]

    def demand(measure):
        return versioned.select(
            *common,
            F.col("user").alias("codigosicagente"),
            F.col("event_type").alias("tipomercado"),
            F.col(measure).alias("valor"),
        )

    return {
        "demanda-real": demand("value"),
        "demanda-comercial": demand("k"),
        "generacion-real": versioned.select(
            *common,
            F.col("user").alias("codigoplanta"),
            F.col("event_type").alias("codigosicagente"),
            F.col("value").alias("valor"),
        ),
        "aporte-hidricos": versioned.select(
            "fecha",
            F.col("event_type").alias("regionhidrologica"),
            F.col("value").alias("aporteshidricosenergia"),
            F.col("k").alias("mediahistoricaenergia"),
            F.col("user_id").alias("promedioacumuladoenergia"),
        ),
        "unidades-generacion": versioned.select(
            "fecha",
            F.col("user").alias("codigounidadgeneracion"),
            F.col("k").cast("string").alias("codigoplanta"),
            F.when(F.col("event_type") == "purchase", "OPERACION").otherwise("Parada").alias("estadorecurso"),
            F.col("event_type").alias("tipogeneracion"),
        ),
    }


def gold(spark, sf_dir, horizon_hours=24, **overrides):
    return gold_features(silver_roles(spark, sf_dir), demo_spec(horizon_hours, **overrides)).drop("processed_at")


def _cells(measure, prefix):
    return ", ".join(
        f"sum({measure}::decimal(18,2)) filter (where event_type = '{t}')::double as {prefix}_{t}" for t in EVENT_TYPES
    )


def gold_ctes(horizon_hours: int = 24, drop_incomplete: bool = True) -> str:
    """CTEs ending in ``gold``, in full precision."""
    t = "target_demanda_real"
    label = f"label_{t}_h_plus_{horizon_hours}"
    units = ", ".join(f"nullif(count(*) filter (where event_type = '{x}'), 0) as unidades_tipo_{x}" for x in EVENT_TYPES)
    complete = (
        f"where {t} is not null and {label} is not null and {t}_lag_24h is not null and {t}_lag_168h is not null "
        "and demanda_comercial_total is not null and generacion_real_total is not null "
        "and aporte_hidrico_energia_total is not null and unidades_total is not null"
        if drop_incomplete
        else ""
    )
    return f"""
    ev0 as (select *, cast(json_extract_string(props, '$.k') as int) as k from events),
    ev as (select *, date_trunc('hour', ts) as event_ts, ts::date as event_date,
                  case when k >= 90 then 'TXR' when k >= 80 then 'txf' else 'TX' || right(k::varchar, 1) end as version
           from ev0),
    latest as (
        select * from ev
        qualify row_number() over (
            partition by event_ts, user_id, event_type
            order by case upper(version) when 'TXR' then 9 when 'TXF' then 8 when 'TX7' then 7 when 'TX6' then 6
                     when 'TX5' then 5 when 'TX4' then 4 when 'TX3' then 3 when 'TX2' then 2 when 'TX1' then 1
                     else 0 end desc, upper(version) desc, event_id) = 1),
    tgt as (select event_ts, sum(value::decimal(18,2))::double as {t}, count(distinct user_id) as {t}_agentes,
                   {_cells('value', t)} from latest group by 1),
    com as (select event_ts, sum(k::decimal(18,2))::double as demanda_comercial_total,
                   count(distinct user_id) as demanda_comercial_agentes,
                   {_cells('k', 'demanda_comercial')} from latest group by 1),
    gen as (select event_ts, sum(value::decimal(18,2))::double as generacion_real_total,
                   count(distinct user_id) as generacion_real_plantas,
                   count(distinct event_type) as generacion_real_agentes from latest group by 1),
    hyd as (select event_date, sum(value::decimal(18,2))::double as aporte_hidrico_energia_total,
                   sum(k::decimal(18,2))::double as aporte_hidrico_media_historica_total,
                   sum(user_id::decimal(18,2))::double as aporte_hidrico_promedio_acumulado_total,
                   count(distinct event_type) as aporte_hidrico_regiones from ev group by 1),
    uni as (select event_date, count(distinct user_id) as unidades_total, count(distinct k) as plantas_total,
                   count(distinct case when event_type = 'purchase' then user_id end) as unidades_operacion
            from ev group by 1),
    typ as (select event_date, {units} from (select distinct event_date, user_id, event_type from ev) group by 1),
    spine as (select unnest(generate_series(min(event_ts), max(event_ts), interval 1 hour)) as event_ts from tgt),
    wide as (
        select * from spine left join tgt using (event_ts) left join com using (event_ts) left join gen using (event_ts)),
    cal as (
        select wide.*, hyd.* exclude (event_date), uni.* exclude (event_date), typ.* exclude (event_date),
               wide.event_ts::date as event_date, hour(wide.event_ts)::int as event_hour,
               (dayofweek(wide.event_ts) + 1)::int as day_of_week, day(wide.event_ts)::int as day_of_month,
               dayofyear(wide.event_ts)::int as day_of_year, week(wide.event_ts)::int as week_of_year,
               month(wide.event_ts)::int as month_of_year,
               case when dayofweek(wide.event_ts) in (0, 6) then 1 else 0 end as is_weekend,
               case when day(wide.event_ts) = 1 then 1 else 0 end as is_month_start,
               case when wide.event_ts::date = last_day(wide.event_ts::date) then 1 else 0 end as is_month_end,
               aporte_hidrico_energia_total / nullif(aporte_hidrico_media_historica_total, 0)
                   as aporte_hidrico_vs_media_ratio,
               unidades_operacion::double / nullif(unidades_total, 0)::double as unidades_operacion_share
        from wide left join hyd on hyd.event_date = wide.event_ts::date
                  left join uni on uni.event_date = wide.event_ts::date
                  left join typ on typ.event_date = wide.event_ts::date),
    lagged as (
        select *, lead({t}, {horizon_hours}) over w as {label}, lag({t}, 1) over w as {t}_lag_1h,
               lag({t}, 24) over w as {t}_lag_24h, lag({t}, 168) over w as {t}_lag_168h,
               {rolling_sql("mean", t, 24, f"{t}_rolling_mean_24h")}, {rolling_sql("stddev", t, 24, f"{t}_rolling_stddev_24h")},
               {rolling_sql("mean", t, 168, f"{t}_rolling_mean_168h")},
               lag(demanda_comercial_total, 24) over w as demanda_comercial_total_lag_24h,
               lag(generacion_real_total, 24) over w as generacion_real_total_lag_24h
        from cal window w as (order by event_ts)),
    gold as (select *, year(event_ts)::int as "year", month(event_ts)::int as "month" from lagged {complete})
    """


@query("gold_features", f"with {gold_ctes()} select * from gold")
def _(spark, sf_dir):
    return gold(spark, sf_dir)


@query("gold_features_h6", f"with {gold_ctes(6)} select * from gold")
def _(spark, sf_dir):
    return gold(spark, sf_dir, 6)


@query("gold_features_all_hours", f"with {gold_ctes(drop_incomplete=False)} select * from gold")
def _(spark, sf_dir):
    return gold(spark, sf_dir, drop_incomplete=False)
