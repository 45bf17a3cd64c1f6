"""op11_interactions: what five filters remove in every order, per source."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.interactions import filter_audit
from tidemark.llm.registry import query, table

SQL = r"""with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
split as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from texts),
masks as (
  select part,
         (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
         + 4 * (100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t))::int
         + 8 * regexp_matches(t, '[#$%&*|]')::int
         + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask,
         doc_id in (select doc_id from labels where quality = 1 and doc_id is not null) as good,
         doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null) as toxic
  from split),
cells as (
  select part, mask, count(*) as n, count(*) filter (where good) as g, count(*) filter (where toxic) as x
  from masks group by part, mask),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 4, 8, 16]) as b),
orders as (
  select p.l || q.l || r.l || s.l || t.l as filter_order, [p.b, q.b, r.b, s.b, t.b] as bits
  from letters p, letters q, letters r, letters s, letters t
  where p.b + q.b + r.b + s.b + t.b = 31 and p.b | q.b | r.b | s.b | t.b = 31),
steps as (
  select filter_order, step::int as step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as before
  from orders, range(1, 6) as places(step)),
effects as (
  select part, filter_order, step, bit,
         sum(n) filter (where mask & (bit | before) = 0) as kept,
         sum(n) filter (where mask & bit <> 0 and mask & before = 0) as removed,
         sum(n) filter (where mask & bit <> 0 and mask & before <> 0) as redundant,
         sum(n) filter (where mask = bit) as unique_fails,
         sum(g) filter (where mask & bit <> 0 and mask & before = 0) as good_lost,
         sum(x) filter (where mask & bit <> 0 and mask & before = 0) as toxic_lost
  from cells, steps group by part, filter_order, step, bit)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
       coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
       coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
       (sum(coalesce(removed, 0)) over (partition by part, bit))::bigint as shapley
from effects"""


@query("op11_interactions", SQL)
def op11_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))
