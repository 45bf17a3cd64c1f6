"""op12_topk: the five best inner products of every fiftieth embedding."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.topk import top_k

SQL = """with kept as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where len(embedding) = len(list_filter(embedding, lambda x: x is not null and isfinite(x)))),
pairs as (
  select q.r, q.vec_id as query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::bigint as score
  from kept q, kept c where q.vec_id % 50 = 0 and q.r <> c.r)
select query_id, (row_number() over (partition by r order by score desc, vec_id nulls last))::int as rank, vec_id, score
from pairs qualify rank <= 5"""


@query("op12_topk", SQL)
def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)
