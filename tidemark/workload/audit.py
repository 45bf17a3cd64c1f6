"""Data quality, splits, drift, imputation, scaling, models and the full report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import drop_other_labels
from tidemark.operators import models as M
from tidemark.operators import quality as Q
from tidemark.operators.maintained import granularity_of, means_of, moments, of_partitions, stretches, update_summary
from tidemark.operators.ordering import latest_rows, row_position
from tidemark.plans.audit import AuditParams, audit_report, model_comparison, prepare, with_predictions
from tidemark.sources.tables import read_gold, write_partitioned, write_report
from tidemark.workload.gold import gold, gold_ctes
from tidemark.workload.registry import query, scratch, table

_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)
LABEL = "label_target_demanda_real_h_plus_24"
TARGET = "target_demanda_real"


def labelled_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


_DOCS_SQL = "d as (select doc_id, text, lang, source, n_chars, quality, toxic from documents left join labels using (doc_id))"
_DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


@query(
    "null_profile",
    f"with {_DOCS_SQL} "
    + " union all ".join(
        f"select '{c}' as \"column\", count(*) - count({c}) as null_count, "
        f"round_even(100 * ((count(*) - count({c}))::double / count(*)), 2) as null_pct from d"
        for c in _DOC_COLUMNS
    ),
)
def _(spark, sf_dir):
    return Q.null_profile(labelled_documents(spark, sf_dir), top=20)


def _granularity_sql(source):
    return f"""
    with t as (select t from ({source}) where t is not null),
         gaps as (select epoch_us(t) - lag(epoch_us(t)) over (order by t) as gap from t),
         step as (select case when max(gap) > 0 then max(gap) else 3600000000 end as us from (
                      select gap from gaps where gap is not null group by gap order by count(*) desc, gap limit 1)),
         f as (select min(t) as lo, max(t) as hi, count(*) as n, count(distinct t) as d from t)
    select lo as min_timestamp, hi as max_timestamp, n as row_count, d as distinct_timestamps,
           n - d as duplicate_timestamps, round(us / 60000000.0, 2)::double as expected_frequency_minutes,
           greatest((epoch_us(hi) - epoch_us(lo)) // us + 1 - d, 0)::bigint as missing_timestamp_count
    from f, step
    """


@query("granularity_audit", _granularity_sql("select o_orderdate as t from orders"))
def _(spark, sf_dir):
    return Q.granularity(table(spark, sf_dir, "orders"), "o_orderdate")


@query("granularity_by_day", _granularity_sql("select date_trunc('day', l_shipdate) as t from lineitem"))
def _(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").select(F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("day"))
    return Q.granularity(days, "day")


def partitioned_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})


_HALF_1997 = "year(o_orderdate) <> 1997 or month(o_orderdate) > 6 or day(o_orderdate) % 2 = 0"


@query("granularity_by_partition", _granularity_sql(f"select o_orderdate as t from orders where {_HALF_1997}"))
def _(spark, sf_dir):
    """A table, then six of its months written again without their odd days; the audit reads those six alone."""
    data, summary = scratch(spark, "orders"), scratch(spark, "stretches")
    orders = partitioned_orders(spark, sf_dir)
    write_partitioned(orders, data)
    update_summary(stretches(read_gold(spark, data), "o_orderdate"), summary)
    write_partitioned(orders.where("year = 1997 and month <= 6 and day(o_orderdate) % 2 = 0"), data)
    touched = [(1997, m) for m in range(1, 7)]
    update_summary(stretches(of_partitions(read_gold(spark, data), touched), "o_orderdate"), summary)
    return granularity_of(read_gold(spark, summary))


@query(
    "drift_incremental",
    """
    with o as (select strftime(o_orderdate, '%Y-%m') as event_month, o_orderstatus as status,
                      case when year(o_orderdate) = 1997 then o_totalprice * 2 else o_totalprice end as price from orders),
         m as (select event_month, sum(price::decimal(18,2))::double / count(price) as current_mean, count(price) as n from o group by 1),
         p as (select *, lag(current_mean) over (order by event_month) as previous_mean from m)
    select event_month, 'o_totalprice' as metric, n, current_mean, previous_mean,
           (current_mean - previous_mean) / previous_mean * 100 as change_pct
    from p where previous_mean is not null
    """,
)
def _(spark, sf_dir):
    """Monthly drift from sums that a second write changed for one year."""
    data, summary = scratch(spark, "orders"), scratch(spark, "moments")
    orders, month = partitioned_orders(spark, sf_dir), F.date_format("o_orderdate", "yyyy-MM").alias("event_month")
    kept = lambda rows: update_summary(moments(rows, ["o_totalprice"], "decimal(18,2)", groups=[month]), summary)
    write_partitioned(orders, data)
    kept(read_gold(spark, data))
    write_partitioned(orders.where("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") * 2), data)
    kept(of_partitions(read_gold(spark, data), [(1997, m) for m in range(1, 13)]))
    means = means_of(read_gold(spark, summary), ["event_month"])
    wide = means.select("event_month", "n", F.col("mean").alias("o_totalprice"))
    changes = Q.monthly_changes(wide.drop("n"), ["o_totalprice"]).drop("abs_change_pct")
    return changes.join(wide.select("event_month", "n"), "event_month")


def split_sql(source: str, order: str) -> str:
    """``source`` plus its split, cut at the reference positions (15 % validation, 15 % test)."""
    return f"""(
        select *, case when _pos < floor(_n * (1 - 0.15::double - 0.15::double)) then 'train'
                       when _pos < floor(_n * (1 - 0.15::double)) then 'validation' else 'test' end as split
        from (select *, row_number() over (order by {order}) - 1 as _pos, count(*) over () as _n from {source}))"""


_ORDERS_SPLIT = split_sql("orders", "o_orderdate, o_orderkey")


def split_orders(spark, sf_dir):
    return Q.temporal_split(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"])


@query("row_position", "select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as position from orders")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return row_position(orders, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("temporal_split", f"select o_orderkey, o_orderdate, split from {_ORDERS_SPLIT}")
def _(spark, sf_dir):
    return split_orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "split")


@query(
    "split_summary",
    f'select split, count(*) as rows, min(o_orderdate) as start, max(o_orderdate) as "end" from {_ORDERS_SPLIT} group by 1',
)
def _(spark, sf_dir):
    return Q.split_summary(split_orders(spark, sf_dir), "o_orderdate")


@query(
    "split_feature_means",
    "select split, round(avg(o_totalprice), 6) as o_totalprice, round(avg(o_custkey), 6) as o_custkey "
    f"from {_ORDERS_SPLIT} group by 1",
)
def _(spark, sf_dir):
    return Q.split_means(split_orders(spark, sf_dir), ["o_totalprice", "o_custkey"])


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_MONTHLY_SQL = (
    "m as (select strftime(l_shipdate, '%Y-%m') as event_month, "
    + ", ".join(f"avg({c}) as {c}" for c in _MEASURES)
    + " from lineitem group by 1)"
)


def monthly_lines(spark, sf_dir):
    return Q.monthly_means(table(spark, sf_dir, "lineitem"), "l_shipdate", _MEASURES)


@query(
    "monthly_means",
    f"with {_MONTHLY_SQL} select event_month, "
    + ", ".join(f"round({c}, 6) as {c}" for c in _MEASURES)
    + " from m order by event_month desc limit 12",
)
def _(spark, sf_dir):
    return Q.latest_months(monthly_lines(spark, sf_dir), _MEASURES)


@query(
    "monthly_drift",
    f"""
    with {_MONTHLY_SQL},
         long as ({" union all ".join(f"select event_month, '{c}' as metric, {c} as current_mean from m" for c in _MEASURES)}),
         p as (select *, lag(current_mean) over (partition by metric order by event_month) as previous_mean from long),
         c as (select *, (current_mean - previous_mean) / nullif(previous_mean, 0) * 100 as change_pct from p)
    select event_month, metric, round(current_mean, 6) as current_mean, round(previous_mean, 6) as previous_mean,
           round(change_pct, 6) as change_pct, round(abs(change_pct), 6) as abs_change_pct
    from c where change_pct is not null order by abs(change_pct) desc, metric, event_month limit 10
    """,
)
def _(spark, sf_dir):
    return Q.largest_changes(Q.monthly_changes(monthly_lines(spark, sf_dir), _MEASURES))


@query("latest_n", "select * from orders order by o_orderdate desc, o_orderkey desc limit 100")
def _(spark, sf_dir):
    return latest_rows(table(spark, sf_dir, "orders"), 100, ["o_orderdate", "o_orderkey"])


@query(
    "latest_n_with_ties",
    f"""select * from lineitem order by l_shipdate desc, {", ".join(f"{c} desc nulls last" for c in _LINE_COLUMNS)}
        limit (select count(*) * 2 // 5 from lineitem)""",
)
def _(spark, sf_dir):
    """Two fifths of a table whose order column is shared by many rows."""
    lines = table(spark, sf_dir, "lineitem")
    return latest_rows(lines, lines.count() * 2 // 5, ["l_shipdate"])


def two_label_gold(spark, sf_dir):
    """Gold with a second label, so that there is one to drop."""
    return gold(spark, sf_dir).withColumn(
        "label_target_demanda_real_h_plus_0", F.col("target_demanda_real")
    )


@query("drop_other_labels", f"with {gold_ctes()} select * from gold")
def _(spark, sf_dir):
    return drop_other_labels(two_label_gold(spark, sf_dir), LABEL)


@query(
    "feature_columns",
    f"with {gold_ctes()} select * exclude (event_ts, event_date, {LABEL}) from gold",
)
def _(spark, sf_dir):
    features = two_label_gold(spark, sf_dir)
    return features.select(Q.feature_columns(features, LABEL))


@query(
    "audit_input",
    """
    with t as (select event_id, case when event_type = 'error' then 'n/a' else ts::varchar end as ts_text,
                      case when event_type = 'view' then null else value end as label_value from events)
    select event_id, try_cast(ts_text as timestamp) as ts_text, label_value from t
    where try_cast(ts_text as timestamp) is not null and label_value is not null
    """,
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("ts").cast("string")).alias("ts_text"),
        # NaN counts as missing too.
        F.when(F.col("event_type") == "view", float("nan")).otherwise(F.col("value")).alias("label_value"),
        F.col("value").alias("label_other"),
    )
    return Q.audit_input(events, "ts_text", "label_value")


_IMPUTED = ("n_chars", "quality", "toxic")


@query(
    "median_impute",
    f"with {_DOCS_SQL} select doc_id, "
    + ", ".join(f"coalesce({c}::double, (select median({c}) from d)::double) as {c}" for c in _IMPUTED)
    + " from d",
)
def _(spark, sf_dir):
    df = labelled_documents(spark, sf_dir).select("doc_id", *_IMPUTED)
    return M.fill_with(df, M.exact_medians(df, _IMPUTED))


@query(
    "standard_scale",
    """
    select o_orderkey,
           round((o_totalprice - avg(o_totalprice) over ()) / stddev_pop(o_totalprice) over (), 6) as o_totalprice,
           round((o_custkey - avg(o_custkey) over ()) / stddev_pop(o_custkey) over (), 6) as o_custkey
    from orders
    """,
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    columns = ["o_totalprice", "o_custkey"]
    return M.scale(orders, M.fit_scale(orders, columns)).withColumns({c: F.round(c, 6) for c in columns})


def metrics_sql(source: str, actual: str, predictions: dict[str, str], split: str = "split") -> str:
    return " union all ".join(
        f"""
        select {split}, '{model}' as model, count(*) as pairs, round(avg(abs(y - p)), 6) as mae,
               round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2,
               round(avg(abs(y - p) / abs(nullif(y, 0))) * 100, 6) as mape_pct
        from (select {split}, {actual}::double as y, {p}::double as p from {source})
        where y is not null and p is not null group by 1"""
        for model, p in predictions.items()
    )


_PREDICTIONS = {"flat_price": "flat_price", "by_part": "by_part"}


@query(
    "regression_metrics",
    f"""
    with l as (select l_returnflag as split, l_extendedprice, l_quantity * 2000 as flat_price,
                      case when l_discount > 0 then l_quantity * (900 + l_partkey / 10.0::double) end as by_part
               from lineitem)
    {metrics_sql("l", "l_extendedprice", _PREDICTIONS)}
    """,
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("split"),
        "l_extendedprice",
        (F.col("l_quantity") * 2000).alias("flat_price"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") * (F.lit(900) + F.col("l_partkey") / 10.0)).alias("by_part"),
    )
    return M.regression_metrics(lines, "l_extendedprice", _PREDICTIONS)


_GOLD_SPLIT = f"with {gold_ctes()}, s as (select * from {split_sql('gold', 'event_ts')})"
_DEMO_PARAMS = AuditParams(label=LABEL)


def compare(spark, sf_dir, models, features=None):
    rows, label = prepare(gold(spark, sf_dir), _DEMO_PARAMS)
    return model_comparison(rows, label, _DEMO_PARAMS, models, features)


@query(
    "baseline_mean_metrics",
    f"""{_GOLD_SPLIT}, m as (select *, (select avg({LABEL}) from s where split = 'train') as mean from s
                             where split <> 'train')
    {metrics_sql("m", LABEL, {"dummy_mean": "mean"})}""",
)
def _(spark, sf_dir):
    return compare(spark, sf_dir, ["dummy_mean"])


@query(
    "naive_persistence_metrics",
    f"""{_GOLD_SPLIT}, m as (select * from s where split <> 'train')
    {metrics_sql("m", LABEL, {"naive_persistence": TARGET})}""",
)
def _(spark, sf_dir):
    return compare(spark, sf_dir, ["naive_persistence"])


# Every numeric column of the feature table but the label, in order.
_MARKET_COLUMNS = [f"_{t}" for t in ("click", "error", "purchase", "signup", "view")]
_RIDGE_FEATURES = (
    TARGET, f"{TARGET}_agentes", *(TARGET + m for m in _MARKET_COLUMNS),
    "demanda_comercial_total", "demanda_comercial_agentes", *("demanda_comercial" + m for m in _MARKET_COLUMNS),
    "generacion_real_total", "generacion_real_plantas", "generacion_real_agentes",
    "aporte_hidrico_energia_total", "aporte_hidrico_media_historica_total", "aporte_hidrico_promedio_acumulado_total",
    "aporte_hidrico_regiones", "unidades_total", "plantas_total", "unidades_operacion",
    *("unidades_tipo" + m for m in _MARKET_COLUMNS),
    "event_hour", "day_of_week", "day_of_month", "day_of_year", "week_of_year", "month_of_year",
    "is_weekend", "is_month_start", "is_month_end", "aporte_hidrico_vs_media_ratio", "unidades_operacion_share",
    f"{TARGET}_lag_1h", f"{TARGET}_lag_24h", f"{TARGET}_lag_168h", f"{TARGET}_rolling_mean_24h",
    f"{TARGET}_rolling_stddev_24h", f"{TARGET}_rolling_mean_168h",
    "demanda_comercial_total_lag_24h", "generacion_real_total_lag_24h", "year", "month",
)
_FILLED = ", ".join(f"coalesce({c}::double, (select median({c}) from s where split = 'train')::double)" for c in _RIDGE_FEATURES)

# Normal equations over standardised features, solved by elimination, one column per step.
RIDGE_CTES = f"""
    filled as (select row_number() over () as r, split, {LABEL} as y, [{_FILLED}] as v from s),
    u as (select r, split, y, unnest(range(1, {len(_RIDGE_FEATURES) + 1})) as i, unnest(v) as x from filled),
    st as (select i, avg(x) as m, stddev_pop(x) as sd from u where split = 'train' group by i),
    z as (select r, split, y, i, case when sd > 1e-12 then (x - m) / sd else 0 end as z from u join st using (i)),
    mean as (select avg(y) as my from filled where split = 'train'),
    a as (select p.i, q.i as j, sum(p.z * q.z) + (p.i = q.i)::int as a from z p join z q using (r)
          where p.split = 'train' group by p.i, q.i),
    b as (select i, sum(z * (y - my)) as b from z, mean where split = 'train' group by i),
    start as (select list(line order by i) as m from (
                  select a.i, list_append(list(a order by j), any_value(b)) as line from a join b using (i) group by a.i)),
    solve as (
        select 1 as i, m from start
        union all
        select i + 1, list_transform(m, lambda line, n: case when n = i
                          then list_transform(line, lambda x: x / m[i][i])
                          else list_transform(line, lambda x, c: x - line[i] * m[i][c] / m[i][i]) end)
        from solve where i <= {len(_RIDGE_FEATURES)}),
    beta as (select unnest(range(1, {len(_RIDGE_FEATURES) + 1})) as i,
                    unnest(list_transform(m, lambda line: line[{len(_RIDGE_FEATURES) + 1}])) as beta
             from solve where i = {len(_RIDGE_FEATURES) + 1}),
    ridge as (select r, any_value(split) as split, any_value(y) as y, any_value(my) + sum(z * beta) as p
              from z join beta using (i), mean where split <> 'train' group by r)"""
_RECURSIVE_SPLIT = _GOLD_SPLIT.replace("with ", "with recursive ", 1)


@query(
    "ridge_metrics",
    f"""{_RECURSIVE_SPLIT}, {RIDGE_CTES}
    {metrics_sql("ridge", "y", {"ridge_regression_scaled": "p"})}""",
)
def _(spark, sf_dir):
    return compare(spark, sf_dir, ["ridge_regression_scaled"])


@query(
    "comparison_metrics",
    f"""{_RECURSIVE_SPLIT}, {RIDGE_CTES},
    o as (select *, (select avg({LABEL}) from s where split = 'train') as mean from s where split <> 'train')
    {metrics_sql("o", LABEL, {"dummy_mean": "mean", "naive_persistence": TARGET})} union all
    {metrics_sql("ridge", "y", {"ridge_regression_scaled": "p"})} union all
    select split, 'random_forest', count(*), null, null, null, null from o group by split""",
)
def _(spark, sf_dir):
    """The whole comparison; of the forest, which SQL cannot grow, the pairs it was scored on."""
    found = compare(spark, sf_dir, None)
    scores = ["mae", "rmse", "r2", "mape_pct"]
    return found.withColumns({c: F.when(F.col("model") != "random_forest", F.col(c)) for c in scores})


@query(
    "forest_facts",
    f"""{_GOLD_SPLIT}
    select split, count({LABEL}) as pairs, true as within_train_labels, true as better_than_mean_on_train
    from s group by split""",
)
def _(spark, sf_dir):
    """What holds for any forest: it predicts every row, within the range of the labels it was fitted to, and
    fits those better than their mean does."""
    rows, label = prepare(gold(spark, sf_dir), _DEMO_PARAMS)
    features = Q.feature_columns(rows, label)
    scored, columns = with_predictions(rows, label, features, _DEMO_PARAMS, ["dummy_mean", "random_forest"])
    train = F.col("split") == "train"
    of, mean, y = F.col(columns["random_forest"]), F.col(columns["dummy_mean"]), F.col(label)
    facts = scored.agg(
        F.min(F.when(train, y)).alias("low"),
        F.max(F.when(train, y)).alias("high"),
        F.sum(F.when(train, (of - y) * (of - y))).alias("forest"),
        F.sum(F.when(train, (mean - y) * (mean - y))).alias("mean"),
    )
    both = scored.select("split", of.alias("p")).crossJoin(F.broadcast(facts))  # one row
    return both.groupBy("split").agg(
        F.count("p").alias("pairs"),
        F.bool_and((F.col("p") >= F.col("low")) & (F.col("p") <= F.col("high"))).alias("within_train_labels"),
        F.first(F.col("forest") < F.col("mean")).alias("better_than_mean_on_train"),
    )


@query("forest_metrics")
def _(spark, sf_dir):
    return compare(spark, sf_dir, ["random_forest"])


@query("model_comparison")
def _(spark, sf_dir):
    return compare(spark, sf_dir, None)


# Sections of the written report as (section, key, name, value): which columns make the key.
_SECTION_KEYS = {
    "dataset": (), "granularity": (), "splits": ("split",), "null_summary": ("column",), "split_feature_means": ("split",),
    "monthly_means": ("event_month",), "monthly_changes": ("metric", "event_month"), "models": ("split", "model"),
}
_FOCUS = (TARGET, LABEL, "demanda_comercial_total", "generacion_real_total", "aporte_hidrico_energia_total", "unidades_operacion")
_AUDITED = ("event_ts", "event_date", LABEL, *_RIDGE_FEATURES)


def _cells_sql(section: str, key: str, source: str, names) -> str:
    return " union all ".join(
        f"select '{section}' as section, {key} as key, '{n}' as name, {e}::double as value from {source}" for n, e in names
    )


_MONTHLY_GOLD = ", ".join(f"avg({c}) as {c}" for c in _FOCUS)
_AUDIT_SQL = f"""{_RECURSIVE_SPLIT}, {RIDGE_CTES},
    o as (select *, (select avg({LABEL}) from s where split = 'train') as mean from s where split <> 'train'),
    scores as ({metrics_sql("o", LABEL, {"dummy_mean": "mean", "naive_persistence": TARGET})} union all
               {metrics_sql("ridge", "y", {"ridge_regression_scaled": "p"})} union all
               select split, 'random_forest', count(*), null, null, null, null from o group by split),
    grain as ({_granularity_sql("select event_ts as t from s")}),
    mg as (select strftime(event_ts, '%Y-%m') as event_month, {_MONTHLY_GOLD} from s group by 1),
    last_months as (select * from mg order by event_month desc limit 12),
    by_split as (select split, count(*) as n, {_MONTHLY_GOLD} from s group by split),
    lm as ({" union all ".join(f"select event_month, '{c}' as metric, {c} as v from mg" for c in _FOCUS)}),
    pm as (select *, lag(v) over (partition by metric order by event_month) as p from lm),
    changes as (select *, (v - p) / nullif(p, 0) * 100 as d from pm where (v - p) / nullif(p, 0) is not null
                order by abs(d) desc, metric, event_month limit 10),
    cells as (
    {_cells_sql("dataset", "''", "(select count(*) as n from s)", [("rows", "n"), ("columns", len(_AUDITED))])} union all
    {_cells_sql("granularity", "''", "grain", [(n, n) for n in (
        "row_count", "distinct_timestamps", "duplicate_timestamps", "expected_frequency_minutes", "missing_timestamp_count")])} union all
    {_cells_sql("splits", "split", "by_split", [("rows", "n")])} union all
    {_cells_sql("split_feature_means", "split", "by_split", [(c, f"round({c}, 6)") for c in _FOCUS])} union all
    {_cells_sql("monthly_means", "event_month", "last_months", [(c, f"round({c}, 6)") for c in _FOCUS])} union all
    {_cells_sql("monthly_changes", "metric || '|' || event_month", "changes", [("current_mean", "round(v, 6)"),
        ("previous_mean", "round(p, 6)"), ("change_pct", "round(d, 6)"), ("abs_change_pct", "round(abs(d), 6)")])} union all
    {_cells_sql("models", "split || '|' || model", "scores", [(n, n) for n in ("pairs", "mae", "rmse", "r2", "mape_pct")])} union all
    {" union all ".join(_cells_sql("null_summary", f"'{c}'", "s", [("null_count", f"count(*) - count({c})"),
        ("null_pct", f"round_even(100 * ((count(*) - count({c}))::double / count(*)), 2)")]) for c in _AUDITED)})
    select * from cells where value is not null
"""


@query("audit_report", _AUDIT_SQL)
def _(spark, sf_dir):
    """The report as it reads from its files, one row per number in it. Of the forest only the pairs: its
    scores are Spark's own (see forest_facts)."""
    path = scratch(spark, "report")
    write_report(audit_report(gold(spark, sf_dir), _DEMO_PARAMS), path)
    parts = []
    for section, keys in _SECTION_KEYS.items():
        if section == "null_summary":
            df = spark.read.option("header", True).csv(f"{path}/{section}")
            df = df.withColumns({c: F.col(c).cast("double") for c in ("null_count", "null_pct")})
        else:
            df = spark.read.json(f"{path}/{section}")
        names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
        cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
        key = F.concat_ws("|", *keys) if keys else F.lit("")
        if names:
            parts.append(df.select(F.lit(section).alias("section"), key.alias("key"), F.inline(cells)))
    forest = (F.col("section") == "models") & F.col("key").endswith("random_forest") & (F.col("name") != "pairs")
    return reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull() & ~forest)
