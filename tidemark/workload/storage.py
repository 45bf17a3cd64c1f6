"""Bronze, silver, gold and the catalog: queries that write to the shared folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.plans.refresh import refresh_silver
from tidemark.plans.silver import bronze_to_silver
from tidemark.session import removed
from tidemark.sources.bronze import bronze_datasets, bronze_files, bronze_slugs
from tidemark.sources.catalog import register_tables
from tidemark.sources.tables import dataset_path, read_gold, read_silver, write_partitioned
from tidemark.sources.variant import read_bronze_once
from tidemark.workload.gold import gold, gold_ctes
from tidemark.workload.registry import query, scratch, table


def write_bronze(df: DataFrame, root: str, slug: str, day: str, order: str) -> None:
    """Write ``df`` as bronze drops, one file per value of the columns ``slug`` and ``day``, each a JSON
    array of the other columns.

    The lines of a file are sorted and streamed to it by one task, since a drop is one document; they are
    never gathered in memory.
    """
    payload = F.to_json(F.struct(*[c for c in df.columns if c not in (slug, day)]))
    name = F.concat_ws("-", slug, F.concat_ws("_", F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy-MM-dd")))
    rows = df.select(
        F.date_format(day, "yyyy/MM/").alias("folder"),
        name.alias("drop"),
        F.col(order).alias("_order"),
        payload.alias("_json"),
    )
    newest_last = Window.partitionBy("drop", "folder").orderBy("_order")
    lead = F.when(F.row_number().over(newest_last) == 1, "[").otherwise(",")
    tail = F.when(F.lead("_order").over(newest_last).isNull(), "]").otherwise("")
    lines = rows.withColumn("value", F.concat(lead, "_json", tail))
    staging = scratch(df.sparkSession, "staging")
    (
        lines.sortWithinPartitions("drop", "folder", "_order")
        .select("value", "folder", "drop")
        .write.partitionBy("folder", "drop")
        .text(staging)
    )
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in fs.globStatus(hadoop.Path(f"{staging}/folder=*/drop=*/part-*")):
        path = part.getPath()
        drop = path.getParent().getName().removeprefix("drop=")
        folder = path.getParent().getParent().getName().removeprefix("folder=").replace("%2F", "/")
        fs.mkdirs(hadoop.Path(f"{root}/{folder}"))
        fs.rename(path, hadoop.Path(f"{root}/{folder}{drop}.json"))


_PREPARED: dict[tuple[str, str], str] = {}


def events_bronze(spark, sf_dir) -> str:
    """The whole events table as daily drops, one dataset per event type, with untidy column names. Written
    once per session and scale; the queries only read it."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _PREPARED:
        _PREPARED[key] = _write_events_bronze(spark, sf_dir)
    return _PREPARED[key]


def event_drops(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("events-"), "event_type").alias("slug"),
        F.to_date("ts").alias("day"),
        F.col("event_id").alias("EventID"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Fecha Hora"),
        F.col("user_id").alias("Código Usuario"),
        F.col("value").alias("1er Valor"),
        F.year("ts").alias("Year"),
    )


def _write_events_bronze(spark, sf_dir) -> str:
    root = scratch(spark, "bronze")
    write_bronze(event_drops(spark, sf_dir), root, "slug", "day", "EventID")
    return root


@query(
    "bronze_discover",
    """
    select 'events-' || event_type as dataset_slug, count(distinct ts::date) as files,
           min(ts::date) as first_day, max(ts::date) as last_day
    from events where event_type <> 'view' group by 1
    """,
)
def _(spark, sf_dir):
    slugs = [f"events-{t}" for t in ("click", "error", "purchase", "signup")]
    return bronze_datasets(bronze_files(spark, events_bronze(spark, sf_dir), slugs)).drop("bytes")


@query(
    "bronze_to_silver",
    """
    select event_id as eventid, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as fecha_hora, user_id as codigo_usuario,
           value as col_1er_valor, year(ts)::bigint as raw_year, 'events-' || event_type as dataset_slug,
           year(ts)::int as "year", month(ts)::int as "month", ts::date as period_start, ts::date as period_end
    from events
    """,
)
def _(spark, sf_dir):
    silver = scratch(spark, "silver")
    written = bronze_to_silver(spark, events_bronze(spark, sf_dir), silver, at_once=4)
    tables = [read_silver(spark, silver, slug).drop("source_file", "processed_at") for slug in written]
    return reduce(DataFrame.unionByName, tables)


@query(
    "bronze_variant",
    """
    select 'events-' || event_type as dataset_slug, event_id as eventid, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as fecha_hora,
           user_id as codigo_usuario, value as col_1er_valor, year(ts)::bigint as raw_year, year(ts)::int as "year",
           month(ts)::int as "month", ts::date as period_start
    from events
    """,
)
def _(spark, sf_dir):
    """Every drop parsed once, into VARIANT; types and rows come from what was parsed."""
    root = events_bronze(spark, sf_dir)
    tables = [read_bronze_once(spark, root, slug) for slug in bronze_slugs(spark, root)]
    return reduce(DataFrame.unionByName, tables).drop("source_file", "period_end", "processed_at")


@query(
    "bronze_incremental",
    """
    with e as (select *, 'events-' || event_type as slug, ts::date as day from events),
         days as (select day, row_number() over (order by day) as n, count(*) over () as all_days from (select distinct day from e)),
         dated as (select e.*, 2 * n <= all_days as early, n = 1 as first_day from e join days using (day)),
         drops as (select count(distinct (slug, day)) filter (where early) as first_run,
                          count(distinct (slug, day)) filter (where not early or first_day) as third_run,
                          count(distinct (slug, day)) filter (where first_day) as changed from dated)
    select event_id as eventid, slug as dataset_slug, user_id as codigo_usuario,
           case when first_day then value + 1 else value end as col_1er_valor, day as period_start,
           first_run || ',0,' || third_run as drops_read, '0,0,' || changed as drops_changed
    from dated, drops
    """,
)
def _(spark, sf_dir):
    """Three refreshes: half of the days, nothing new, and the other days with all drops of the first day changed."""
    root, silver = scratch(spark, "bronze"), scratch(spark, "silver")
    drops = event_drops(spark, sf_dir)
    days = sorted(r["day"] for r in drops.select("day").distinct().collect())
    first, middle, runs = days[0], days[len(days) // 2 - 1], []
    write_bronze(drops.where(F.col("day") <= middle), root, "slug", "day", "EventID")
    runs.append(refresh_silver(spark, root, silver, at_once=8))
    runs.append(refresh_silver(spark, root, silver, at_once=8))
    for path in bronze_files(spark, root).where(F.col("period_start") == first).select("path").collect():
        removed(spark, path[0])
    again = drops.where(F.col("day") == first).withColumn("1er Valor", F.col("1er Valor") + 1)
    write_bronze(again.union(drops.where(F.col("day") > middle)), root, "slug", "day", "EventID")
    runs.append(refresh_silver(spark, root, silver, at_once=8))
    rows = reduce(DataFrame.unionByName, [read_silver(spark, silver, slug) for slug in runs[0]])
    read = [str(sum(r.drops for r in run.values())) for run in runs]
    changed = [str(sum(r.changed for r in run.values())) for run in runs]
    return rows.select(
        "eventid", "dataset_slug", "codigo_usuario", "col_1er_valor", "period_start",
        F.lit(",".join(read)).alias("drops_read"), F.lit(",".join(changed)).alias("drops_changed"),
    )


@query("silver_counts", "select 'events-' || event_type as dataset_slug, count(*) as rows from events group by 1")
def _(spark, sf_dir):
    written = bronze_to_silver(spark, events_bronze(spark, sf_dir), scratch(spark, "silver"), at_once=4)
    return spark.createDataFrame(list(written.items()), "dataset_slug string, rows long")


def drifting_orders(spark, sf_dir):
    """Bronze drops of two runs, one per month: up to 1997 prices are whole numbers; later ones have cents,
    and there is a column more."""
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("slug"), F.trunc("o_orderdate", "month").alias("day"), F.col("o_orderkey").alias("Key"),
        F.col("o_totalprice").alias("Valor"), F.col("o_orderstatus").alias("Estado"),
    )
    early = F.year("day") <= 1997
    runs = [orders.where(early).withColumn("Valor", F.floor("Valor")).drop("Estado"), orders.where(~early)]
    for run in runs:
        root = scratch(spark, "bronze")
        write_bronze(run, root, "slug", "day", "Key")
        yield root


_DRIFT_SQL = """
    select o_orderkey::double as "key", case when year(o_orderdate) <= 1997 then floor(o_totalprice) else o_totalprice end as valor,
           case when year(o_orderdate) > 1997 then o_orderstatus end as estado,
           year(o_orderdate)::int as "year", month(o_orderdate)::int as "month"
    from orders
"""
_DRIFTING = ("key", "valor", "estado", "year", "month")


@query("silver_drift", _DRIFT_SQL)
def _(spark, sf_dir):
    """Each run infers its schema and adds to the same table."""
    silver = scratch(spark, "silver")
    for root in drifting_orders(spark, sf_dir):
        bronze_to_silver(spark, root, silver, widen=True)
    return read_silver(spark, silver, "orders").select(*_DRIFTING)


@query(
    "register_tables_update",
    f"""
    with t as ({_DRIFT_SQL})
    select 'create,update' as actions, estado, count(*) as rows, sum(floor(valor))::bigint as whole from t group by estado
    """,
)
def _(spark, sf_dir):
    """The catalog after each of two runs; the second brings a column."""
    silver, actions = scratch(spark, "silver"), []
    database = silver.rsplit("/", 1)[-1].replace("-", "_")
    for root in drifting_orders(spark, sf_dir):
        bronze_to_silver(spark, root, silver, widen=True)
        actions += [r["action"] for r in register_tables(spark, silver, database, f"{silver}-database").collect()]
    found = spark.table(f"{database}.orders").groupBy("estado")
    found = found.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.floor("valor")).alias("whole"))
    return found.withColumn("actions", F.lit(",".join(actions)))


@query(
    "silver_roundtrip",
    """
    select * replace (o_totalprice * case when year(o_orderdate) = 1997 then 2 else 1 end as o_totalprice),
           year(o_orderdate)::int as "year", month(o_orderdate)::int as "month"
    from orders
    """,
)
def _(spark, sf_dir):
    # The second write replaces the twelve partitions of 1997 and leaves the others.
    path = scratch(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    write_partitioned(orders, path)
    write_partitioned(orders.where("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return spark.read.parquet(path)


@query("gold_roundtrip", f"with {gold_ctes()} select * from gold")
def _(spark, sf_dir):
    path = scratch(spark, "gold")
    write_partitioned(gold(spark, sf_dir), path, rebalance=False)
    return read_gold(spark, path)


@query(
    "register_tables",
    """
    select 'order_facts' as table_name, year(o_orderdate)::int as "year", count(*) as rows from orders group by 1, 2
    union all
    select 'ship_facts', year(l_shipdate)::int, count(*) from lineitem group by 1, 2
    """,
)
def _(spark, sf_dir):
    root = scratch(spark, "tables")
    sources = {"order-facts": ("orders", "o_orderdate"), "ship-facts": ("lineitem", "l_shipdate")}
    for folder, (name, day) in sources.items():
        df = table(spark, sf_dir, name).withColumns({"year": F.year(day), "month": F.month(day)})
        write_partitioned(df, dataset_path(root, folder))
    database = root.rsplit("/", 1)[-1].replace("-", "_")
    plan = register_tables(spark, root, database, location=f"{root}-database")
    counts = [
        spark.table(f"{database}.{r['table']}")
        .groupBy(F.lit(r["table"]).alias("table_name"), "year")
        .agg(F.count(F.lit(1)).alias("rows"))
        for r in plan.collect()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "register_tables_partitions",
    """
    with t as (select year(o_orderdate)::int as "year", month(o_orderdate)::int as "month", round(o_totalprice * 100)::bigint as cents
               from orders),
         months as (select count(distinct (year, month)) filter (where year <= 1995) as early,
                           count(distinct (year, month)) filter (where year > 1992) as rest from t)
    select 'create,keep,replace' as actions, early || ',' || rest || ',' || rest as partitions, "year", "month",
           sum(cents)::bigint as cents, count(*) as rows
    from t, months where year > 1992 group by all
    """,
)
def _(spark, sf_dir):
    """The catalog after each of three runs: months up to 1995; later months added and those of 1992 removed; a
    column of another type."""
    root, actions, partitions = scratch(spark, "tables"), [], []
    path, database = dataset_path(root, "orders"), root.rsplit("/", 1)[-1].replace("-", "_")
    rows = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), (F.col("o_totalprice") * 100).alias("cents")
    )

    def follow():
        actions.extend(r["action"] for r in register_tables(spark, root, database, f"{root}-database").collect())
        partitions.append(str(spark.sql(f"SHOW PARTITIONS {database}.orders").count()))

    write_partitioned(rows.where("year <= 1995"), path)
    follow()
    write_partitioned(rows.where("year > 1995"), path)
    removed(spark, f"{path}/year=1992")
    follow()
    write_partitioned(rows.where("year > 1992").withColumn("cents", F.round("cents").cast("long")), path)
    follow()
    found = spark.table(f"{database}.orders").groupBy("year", "month")
    found = found.agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("rows"))
    return found.withColumns({"actions": F.lit(",".join(actions)), "partitions": F.lit(",".join(partitions))})
