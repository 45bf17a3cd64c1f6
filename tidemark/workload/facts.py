"""Versions, names and aggregates over fact rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.naming import with_clean_names, with_prefix
from tidemark.functions.numeric import guarded_ratio, version_rank
from tidemark.functions.paths import bronze_path_fields
from tidemark.functions.time import hour_floor
from tidemark.operators.bitmaps import distinct_by_grain
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.rollup import (
    DistinctCount,
    PivotRows,
    PivotTotal,
    Total,
    distinct_rows,
    rollup,
    rollup_with_row_pivot,
)
from tidemark.operators.versions import LatestTable, latest_version
from tidemark.workload.registry import query, scratch, table

CENTS = "decimal(18,2)"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
LINE_FLAGS = ("R", "A")


def hourly_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("event_ts", hour_floor("ts"))


@query(
    "version_priority",
    """
    select l_orderkey, l_linenumber, l_returnflag,
           case upper(l_returnflag) when 'R' then 2 when 'A' then 1 else 0 end as version_rank
    from lineitem
    """,
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_returnflag", version_rank("l_returnflag", LINE_FLAGS).alias("version_rank")
    )


_LATEST_SQL = """
    select * from lineitem
    qualify row_number() over (
        partition by l_orderkey, l_linenumber
        order by case upper(l_returnflag) when 'R' then 2 when 'A' then 1 else 0 end desc,
                 l_shipdate desc nulls last, l_linestatus desc nulls last, upper(l_returnflag) desc nulls last,
                 l_partkey asc nulls last, l_suppkey asc nulls last) = 1
"""


@query("dedup_incremental", _LATEST_SQL)
def _(spark, sf_dir):
    """The lines of each of three ranges of ship dates, taken one after the other into a bucketed table."""
    lines = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    path = scratch(spark, "latest")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    latest = LatestTable(
        name, ("l_orderkey", "l_linenumber"), 8, "l_returnflag", LINE_FLAGS, ("l_shipdate", "l_linestatus"), ("l_partkey", "l_suppkey")
    )
    latest.create(lines.where(year <= 1994), f"{path}/0")
    latest.take(lines.where((year > 1994) & (year <= 1996)), f"{path}/1")
    return latest.with_drop(lines.where((year > 1996) | year.isNull()))


@query("dedup_latest_version", _LATEST_SQL)
def _(spark, sf_dir):
    return latest_version(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        version="l_returnflag",
        priority=LINE_FLAGS,
        recency=("l_shipdate", "l_linestatus"),
        tie_break=("l_partkey", "l_suppkey"),
    )


@query(
    "agg_target_hourly",
    """
    select date_trunc('hour', ts) as event_ts, sum(value::decimal(18,2))::double as target_events,
           count(distinct user_id) as target_events_agents
    from events group by 1
    """,
)
def _(spark, sf_dir):
    return rollup(
        hourly_events(spark, sf_dir),
        ["event_ts"],
        [Total("value", "target_events")],
        [DistinctCount("user_id", "target_events_agents")],
        exact=CENTS,
    )


@query(
    "agg_feature_hourly",
    """
    select date_trunc('hour', ts) as event_ts, sum(value::decimal(18,2))::double as events_total,
           count(distinct event_type) as events_agents
    from events group by 1
    """,
)
def _(spark, sf_dir):
    return rollup(
        hourly_events(spark, sf_dir),
        ["event_ts"],
        [Total("value", "events_total")],
        [DistinctCount("event_type", "events_agents")],
        exact=CENTS,
    )


@query(
    "agg_multi_distinct",
    """
    select l_shipdate, sum(l_quantity::decimal(18,2))::double as quantity_total,
           count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers
    from lineitem group by 1
    """,
)
def _(spark, sf_dir):
    return rollup(
        table(spark, sf_dir, "lineitem"),
        ["l_shipdate"],
        [Total("l_quantity", "quantity_total")],
        [DistinctCount("l_partkey", "parts"), DistinctCount("l_suppkey", "suppliers")],
        exact=CENTS,
    )


@query(
    "agg_daily_sums",
    """
    select l_shipdate::date as event_date, sum(l_quantity::decimal(18,2))::double as quantity_total,
           sum(l_extendedprice::decimal(18,2))::double as price_total,
           sum(l_discount::decimal(18,2))::double as discount_total, count(distinct l_suppkey) as suppliers
    from lineitem group by 1
    """,
)
def _(spark, sf_dir):
    return rollup(
        table(spark, sf_dir, "lineitem").withColumn("event_date", F.to_date("l_shipdate")),
        ["event_date"],
        [
            Total("l_quantity", "quantity_total"),
            Total("l_extendedprice", "price_total"),
            Total("l_discount", "discount_total"),
        ],
        [DistinctCount("l_suppkey", "suppliers")],
        exact=CENTS,
    )


@query(
    "agg_conditional_distinct",
    """
    select ts::date as event_date, count(distinct user_id) as users,
           count(distinct case when lower(event_type) = 'purchase' then user_id end) as buyers
    from events group by 1
    """,
)
def _(spark, sf_dir):
    return rollup(
        table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts")),
        ["event_date"],
        distincts=[
            DistinctCount("user_id", "users"),
            DistinctCount("user_id", "buyers", where="lower(event_type) = 'purchase'"),
        ],
    )


_PIVOT_SQL = ",\n".join(
    f"sum(value::decimal(18,2)) filter (where event_type = '{t}')::double as market_{t}" for t in EVENT_TYPES
)


@query(
    "pivot_market_hourly",
    f"""
    select date_trunc('hour', ts) as event_ts, sum(value::decimal(18,2))::double as market_total,
           count(distinct user_id) as market_agents,
           {_PIVOT_SQL}
    from events group by 1
    """,
)
def _(spark, sf_dir):
    return rollup(
        hourly_events(spark, sf_dir),
        ["event_ts"],
        [Total("value", "market_total")],
        [DistinctCount("user_id", "market_agents")],
        PivotTotal("value", "event_type", "market"),
        exact=CENTS,
    )


@query(
    "prefix_columns",
    f"""
    select event_ts, click as market_click, error as market_error, purchase as market_purchase,
           signup as market_signup, "view" as market_view
    from (select date_trunc('hour', ts) as event_ts,
                 {_PIVOT_SQL.replace("as market_", 'as ').replace('as view', 'as "view"')}
          from events group by 1)
    """,
)
def _(spark, sf_dir):
    cells = hourly_events(spark, sf_dir).groupBy("event_ts").pivot("event_type", list(EVENT_TYPES))
    return with_prefix(cells.agg(F.sum(F.col("value").cast(CENTS)).cast("double")), "market", ["event_ts"])


_UNITS_SQL = ",\n".join(
    f"nullif(count(*) filter (where event_type = '{t}'), 0) as users_type_{t}" for t in EVENT_TYPES
)


@query(
    "unit_mix_daily",
    f"""
    with u as (select distinct ts::date as event_date, user_id, event_type from events),
         p as (select event_date, {_UNITS_SQL} from u group by 1),
         t as (select ts::date as event_date, count(distinct user_id) as users,
                      count(distinct case when event_type = 'purchase' then user_id end) as buyers
               from events group by 1)
    select * from t left join p using (event_date)
    """,
)
def _(spark, sf_dir):
    return rollup_with_row_pivot(
        table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts")),
        ["event_date"],
        [DistinctCount("user_id", "users"), DistinctCount("user_id", "buyers", where="event_type = 'purchase'")],
        PivotRows(("user_id", "event_type"), "event_type", "users_type"),
    )


@query("distinct_rows", "select distinct ts::date as event_date, user_id, event_type from events")
def _(spark, sf_dir):
    return distinct_rows(
        table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts")),
        ["event_date", "user_id", "event_type"],
    )


@query(
    "safe_ratio",
    """
    with d as (select ts::date as event_date, user_id, count(*) filter (where event_type = 'error') as errors,
                      count(*) filter (where event_type = 'purchase') as purchases
               from events group by 1, 2)
    select event_date, user_id, errors, purchases, errors::double / nullif(purchases, 0)::double as errors_per_purchase
    from d
    """,
)
def _(spark, sf_dir):
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("event_date"), "user_id")
        .agg(
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        )
    )
    return daily.withColumn("errors_per_purchase", guarded_ratio("errors", "purchases"))


@query(
    "sanitize_columns",
    """
    select o_orderkey as numero_de_orden, o_custkey as codigo_cliente, o_orderstatus as codigo_cliente_2,
           o_totalprice as col_1er_valor_cop, o_orderdate as "column", o_orderpriority as codigo_cliente_3
    from orders
    """,
)
def _(spark, sf_dir):
    awkward = ["Número de Orden", "Código Cliente", "codigo-cliente", "1er valor (COP)", "--", "CODIGO  CLIENTE"]
    return with_clean_names(table(spark, sf_dir, "orders").toDF(*awkward))


_PATH_RE = r"/(\d{4})/(\d{2})/([a-z0-9-]+)-(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})\.json$"


@query(
    "path_metadata",
    f"""
    with p as (select o_orderkey, '/bronze' || strftime(o_orderdate, '/%Y/%m/') ||
                      case when o_orderstatus = 'F' then 'Notes ' else 'orders-' || lower(o_orderstatus) || '-' end ||
                      strftime(o_orderdate, '%Y-%m-01') || '_' || strftime(last_day(o_orderdate), '%Y-%m-%d') ||
                      '.json' as path from orders)
    select o_orderkey,
           nullif(regexp_extract(path, '{_PATH_RE}', 3), '') as dataset_slug,
           nullif(regexp_extract(path, '{_PATH_RE}', 1), '')::int as year,
           nullif(regexp_extract(path, '{_PATH_RE}', 2), '')::int as month,
           nullif(regexp_extract(path, '{_PATH_RE}', 4), '')::date as period_start,
           nullif(regexp_extract(path, '{_PATH_RE}', 5), '')::date as period_end
    from p
    """,
)
def _(spark, sf_dir):
    day = F.col("o_orderdate")
    name = F.when(F.col("o_orderstatus") == "F", "Notes ").otherwise(
        F.concat(F.lit("orders-"), F.lower("o_orderstatus"), F.lit("-"))
    )
    path = F.concat(
        F.lit("/bronze"),
        F.date_format(day, "/yyyy/MM/"),
        name,
        F.date_format(day, "yyyy-MM-01"),
        F.lit("_"),
        F.date_format(F.last_day(day), "yyyy-MM-dd"),
        F.lit(".json"),
    )
    paths = table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))
    return paths.select("o_orderkey", *[c.alias(n) for n, c in bronze_path_fields("path").items()])


@query(
    "pivot_many_categories",
    """
    with cells as (select date_trunc('month', l_shipdate) as ship_month, 'supplier_col_' || l_suppkey as supplier,
                          sum(l_quantity::decimal(18,2))::double as quantity from lineitem group by 1, 2),
         months as (select ship_month, sum(l_quantity::decimal(18,2))::double as month_quantity
                    from (select date_trunc('month', l_shipdate) as ship_month, l_quantity from lineitem) group by 1),
         suppliers as (select distinct supplier from cells)
    select ship_month, month_quantity, supplier, quantity
    from months cross join suppliers left join cells using (ship_month, supplier)
    """,
)
def _(spark, sf_dir):
    """A column per supplier, in blocks that are read back as rows so that SQL can state them; what a line costs does not
    depend on how many there are."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.withColumn("ship_month", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz"))
    pivot = PivotTotal("l_quantity", "l_suppkey", "supplier")
    total = Total("l_quantity", "month_quantity")
    return rollup(lines, ["ship_month"], [total], pivot=pivot, exact=CENTS, as_rows=("supplier", "quantity"))


@query(
    "distinct_bitmaps",
    " union all ".join(
        f"""select '{grain}' as grain, date_trunc('{grain}', ts)::timestamp as period, count(distinct user_id) as user_id,
                   count(distinct event_type) as event_type from events group by 2"""
        for grain in ("hour", "day", "month")
    ),
)
def _(spark, sf_dir):
    """Hours, days and months from one aggregate over the events."""
    return distinct_by_grain(table(spark, sf_dir, "events"), "ts", ["user_id", "event_type"])


_QUANTILES = (0.0, 0.25, 0.5, 0.9, 1.0)
_MEASURES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "exact_quantiles",
    f"""
    with lists as ({
        " union all ".join(
            f"select l_returnflag, '{c}' as \"column\", list_sort(list({c})) as v from lineitem group by 1" for c in _MEASURES
        )
    }),
    spots as (select *, len(v) as n, unnest({list(_QUANTILES)}::double[]) as probability from lists),
    ends as (select *, probability * (n - 1) as place, v[floor(probability * (n - 1))::int + 1] as lower,
                    v[ceil(probability * (n - 1))::int + 1] as upper from spots)
    select l_returnflag, "column", probability, n::bigint as n, lower, upper,
           case when lower = upper then lower else lower + (upper - lower) * (place - floor(place)) end as value
    from ends
    """,
)
def _(spark, sf_dir):
    """Five quantiles of three columns per flag; no row is ordered."""
    return exact_quantiles(table(spark, sf_dir, "lineitem"), _MEASURES, _QUANTILES, by=["l_returnflag"])
