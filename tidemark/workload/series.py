"""Spines, joins over time, calendar, lags and rolling statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.time import calendar_fields
from tidemark.operators.combine import attach_daily, left_fold
from tidemark.operators.lags import Rolling, Shift, lag_columns, rolling_by_prefix
from tidemark.operators.rollup import DistinctCount, Total, rollup
from tidemark.operators.spine import dense_spine, on_spine
from tidemark.workload.facts import CENTS, hourly_events
from tidemark.workload.registry import query, table

HOURLY_SQL = """
    e as (select date_trunc('hour', ts) as event_ts, sum(value::decimal(18,2))::double as v,
                 count(distinct user_id) as users from events group by 1),
    sp as (select unnest(generate_series(min(event_ts), max(event_ts), interval 1 hour)) as event_ts from e),
    g as (select sp.event_ts, e.v, e.users from sp left join e using (event_ts))
"""


def hourly_totals(spark, sf_dir, by=("event_ts",)):
    return rollup(
        hourly_events(spark, sf_dir), by, [Total("value", "v")], [DistinctCount("user_id", "users")], exact=CENTS
    )


def hourly_series(spark, sf_dir):
    """Hourly totals on a dense spine. The spine reads one column of the raw rows."""
    return on_spine(hourly_totals(spark, sf_dir), bounds_of=hourly_events(spark, sf_dir).select("event_ts"))


def hourly_series_by_type(spark, sf_dir):
    keys = ["event_type", "event_ts"]
    raw = hourly_events(spark, sf_dir).select(*keys)
    return on_spine(hourly_totals(spark, sf_dir, keys), series_keys=["event_type"], bounds_of=raw)


@query("hourly_spine", f"with {HOURLY_SQL} select event_ts from sp")
def _(spark, sf_dir):
    return dense_spine(hourly_events(spark, sf_dir).select("event_ts"))


SERIES_SQL = """
    e as (select event_type, date_trunc('hour', ts) as event_ts, sum(value::decimal(18,2))::double as v,
                 count(distinct user_id) as users from events group by 1, 2),
    b as (select event_type, min(event_ts) as lo, max(event_ts) as hi from e group by 1),
    sp as (select event_type, unnest(generate_series(lo, hi, interval 1 hour)) as event_ts from b),
    g as (select sp.event_type, sp.event_ts, e.v, e.users from sp left join e using (event_type, event_ts))
"""


@query("gap_fill_by_series", f"with {SERIES_SQL} select * from g")
def _(spark, sf_dir):
    return hourly_series_by_type(spark, sf_dir)


@query(
    "multi_left_join",
    """
    with e as (select date_trunc('hour', ts) as event_ts, * exclude (ts) from events),
         sp as (select unnest(generate_series(min(event_ts), max(event_ts), interval 1 hour)) as event_ts from e),
         c as (select event_ts, sum(value::decimal(18,2))::double as clicks_value from e
               where event_type = 'click' group by 1),
         s as (select event_ts, count(distinct user_id) as signup_users from e where event_type = 'signup' group by 1),
         p as (select event_ts, sum(value::decimal(18,2))::double as purchases_value,
                      count(distinct user_id) as buyers from e where event_type = 'purchase' group by 1),
         x as (select event_ts, sum(value::decimal(18,2))::double as other_value, count(distinct user_id) as other_users
               from e where event_type not in ('click', 'signup', 'purchase') group by 1)
    select * from sp left join c using (event_ts) left join s using (event_ts) left join p using (event_ts)
                  left join x using (event_ts)
    """,
)
def _(spark, sf_dir):
    events = hourly_events(spark, sf_dir)

    def part(event_type, totals=(), distincts=()):
        mine = F.col("event_type") == event_type if event_type else ~F.col("event_type").isin("click", "signup", "purchase")
        return rollup(events.where(mine), ["event_ts"], totals, distincts, exact=CENTS)

    return left_fold(
        dense_spine(events.select("event_ts")),
        [
            part("click", [Total("value", "clicks_value")]),
            part("signup", distincts=[DistinctCount("user_id", "signup_users")]),
            part("purchase", [Total("value", "purchases_value")], [DistinctCount("user_id", "buyers")]),
            part(None, [Total("value", "other_value")], [DistinctCount("user_id", "other_users")]),
        ],
        ["event_ts"],
    )


@query(
    "daily_to_hourly",
    f"""
    with {HOURLY_SQL},
         d as (select ts::date as event_date, count(distinct user_id) as day_users,
                      sum(value::decimal(18,2))::double as day_value from events group by 1)
    select g.event_ts, g.v, g.users, d.day_users, d.day_value from g left join d on g.event_ts::date = d.event_date
    """,
)
def _(spark, sf_dir):
    daily = rollup(
        table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts")),
        ["event_date"],
        [Total("value", "day_value")],
        [DistinctCount("user_id", "day_users")],
        exact=CENTS,
    )
    return attach_daily(hourly_series(spark, sf_dir), [daily])


@query(
    "calendar_features",
    """
    select event_id, ts::date as event_date, hour(ts)::int as event_hour, (dayofweek(ts) + 1)::int as day_of_week,
           day(ts)::int as day_of_month, dayofyear(ts)::int as day_of_year, week(ts)::int as week_of_year,
           month(ts)::int as month_of_year, case when dayofweek(ts) in (0, 6) then 1 else 0 end as is_weekend,
           case when day(ts) = 1 then 1 else 0 end as is_month_start,
           case when ts::date = last_day(ts::date) then 1 else 0 end as is_month_end
    from events
    """,
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", *[c.alias(n) for n, c in calendar_fields("ts").items()])


_LAGS = [Shift("v", n, f"v_lag_{n}h") for n in (1, 24, 168)]
_LAGS_SQL = ", ".join(f"lag(v, {n}) over w as v_lag_{n}h" for n in (1, 24, 168))
_LEAD = Shift("v", -24, "label_v_h_plus_24")
_MEANS = [Rolling("v", "mean", n, f"v_rolling_mean_{n}h") for n in (24, 168)]
_STDDEV = Rolling("v", "stddev", 24, "v_rolling_stddev_24h")


def rolling_sql(stat, column, hours, alias, partition=""):
    """Mean or deviation of exact cents before the row, rounded in the last step only."""
    frame = f"over ({partition} order by event_ts rows between {hours} preceding and 1 preceding)"
    cents = f"({column}::decimal(18,2) * 100)::hugeint"
    n, s, q = f"count({column}) {frame}", f"sum({cents}) {frame}", f"sum({cents} * {cents}) {frame}"
    if stat == "mean":
        return f"({s})::double / nullif({n}, 0)::double / 100 as {alias}"
    spread = f"(({n}) * ({q}) - ({s}) * ({s}))::varchar::double"
    return f"case when {n} > 1 then sqrt({spread} / (({n})::double * (({n})::double - 1)) / 10000) end as {alias}"


_MEANS_SQL = ", ".join(rolling_sql("mean", "v", n, f"v_rolling_mean_{n}h") for n in (24, 168))
_STDDEV_SQL = rolling_sql("stddev", "v", 24, "v_rolling_stddev_24h")


@query("lead_label", f"with {HOURLY_SQL} select event_ts, v, lead(v, 24) over (order by event_ts) as label_v_h_plus_24 from g")
def _(spark, sf_dir):
    return lag_columns(hourly_series(spark, sf_dir).select("event_ts", "v"), [_LEAD])


@query("lag_features", f"with {HOURLY_SQL} select event_ts, v, {_LAGS_SQL} from g window w as (order by event_ts)")
def _(spark, sf_dir):
    return lag_columns(hourly_series(spark, sf_dir).select("event_ts", "v"), _LAGS)


@query("rolling_mean", f"with {HOURLY_SQL} select event_ts, {_MEANS_SQL} from g")
def _(spark, sf_dir):
    return lag_columns(hourly_series(spark, sf_dir).select("event_ts", "v"), _MEANS, exact=CENTS).drop("v")


@query("rolling_stddev", f"with {HOURLY_SQL} select event_ts, {_STDDEV_SQL} from g")
def _(spark, sf_dir):
    return lag_columns(hourly_series(spark, sf_dir).select("event_ts", "v"), [_STDDEV], exact=CENTS).drop("v")


@query(
    "lag_rolling_bundle",
    f"""
    with {HOURLY_SQL}
    select event_ts, v, users, lead(v, 24) over w as label_v_h_plus_24, {_LAGS_SQL}, {_MEANS_SQL}, {_STDDEV_SQL},
           lag(users, 24) over w as users_lag_24h
    from g window w as (order by event_ts)
    """,
)
def _(spark, sf_dir):
    features = [_LEAD, *_LAGS, *_MEANS, _STDDEV, Shift("users", 24, "users_lag_24h")]
    return lag_columns(hourly_series(spark, sf_dir), features, exact=CENTS)


@query(
    "lag_rolling_by_series",
    f"""
    with {SERIES_SQL}
    select event_type, event_ts, v, lag(v, 24) over w as v_lag_24h, lead(v, 24) over w as label_v_h_plus_24,
           {rolling_sql("mean", "v", 24, "v_rolling_mean_24h", "partition by event_type")}
    from g window w as (partition by event_type order by event_ts)
    """,
)
def _(spark, sf_dir):
    dense = hourly_series_by_type(spark, sf_dir)
    return lag_columns(dense.drop("users"), [_LAGS[1], _LEAD, _MEANS[0]], series_keys=["event_type"], exact=CENTS)


_LONG = [Rolling("v", stat, n, f"v_{stat}_{n}h") for n in (168, 8760) for stat in ("mean", "stddev")]


@query(
    "rolling_long",
    f"""
    with e as (select o_orderpriority as priority, o_orderdate as event_ts, sum(o_totalprice::decimal(18,2))::double as v
               from orders group by 1, 2),
         b as (select priority, min(event_ts) as lo, max(event_ts) as hi from e group by 1),
         sp as (select priority, unnest(generate_series(lo, hi, interval 1 hour)) as event_ts from b),
         g as (select sp.priority, sp.event_ts, e.v from sp left join e using (priority, event_ts))
    select priority, event_ts, {", ".join(rolling_sql(f.stat, "v", f.hours, f.alias, "partition by priority") for f in _LONG)}
    from g
    """,
)
def _(spark, sf_dir):
    """Frames of a week and of a year over the hours of several series."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("event_ts"), "o_totalprice")
    keys = ["priority", "event_ts"]
    totals = rollup(orders, keys, [Total("o_totalprice", "v")], exact=CENTS)
    series = on_spine(totals, series_keys=["priority"], bounds_of=orders.select(*keys))
    return rolling_by_prefix(series, _LONG, CENTS, series_keys=["priority"]).drop("v")


@query(
    "dropna_subset",
    """
    select d.doc_id, d.lang, d.source, l.quality, l.toxic
    from documents d left join labels l using (doc_id)
    where l.quality is not null and l.toxic is not null
    """,
)
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").dropna(subset=["quality", "toxic"])
