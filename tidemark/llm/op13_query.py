"""op13_clusters: centroid clustering of all embeddings."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.clusters import Clustering, clusters
from tidemark.llm.registry import query, table


def sql(params: Clustering = Clustering()) -> str:
    parts = [f"""
kept as materialized (
  select row_number() over () as r, vec_id,
         list_transform(embedding, lambda x: floor({params.scale} * x::double)::bigint) as v
  from embeddings
  where len(embedding) = {params.size}
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {params.size}),
c0 as materialized (
  select (row_number() over (order by h, v) - 1)::int as c, v
  from (select sha256('{params.seed}:' || vec_id::varchar) as h, v from kept)
  order by h nulls last, v limit {params.k})"""]
    for i in range(params.rounds + 1):
        parts.append(f"""
a{i} as materialized (
  select r, vec_id, v, c, d from (
    select r, vec_id, k.v, c, list_sum(list_transform(list_zip(k.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from kept k, c{i})
  qualify row_number() over (partition by r order by d, c) = 1)""")
        if i < params.rounds:
            parts.append(f"""
s{i} as materialized (
  select c, i, sum(x)::hugeint as s, count(*)::hugeint as n
  from (select c, unnest(range(1, {params.size + 1})) as i, unnest(v) as x from a{i}) group by c, i),
m{i} as materialized (
  select c, list(((s - (s % n + n) % n) // n)::bigint order by i) as v from s{i} group by c),
c{i + 1} as materialized (select c{i}.c, coalesce(m{i}.v, c{i}.v) as v from c{i} left join m{i} using (c))""")
    last = params.rounds
    return f"""with {','.join(parts)}
select vec_id, c as cluster, d as distance, (sum(d) over (partition by c))::bigint as cluster_inertia,
       (sum(d) over ())::bigint as inertia, sha256(array_to_string(c{last}.v, ',')) as centroid_sha256
from a{last} join c{last} using (c)"""


@query("op13_clusters", sql())
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumnRenamed("id", "vec_id")
