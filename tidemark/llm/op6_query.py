"""op6_chat: every conversation from the perspective of every participant."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.chat import rotate
from tidemark.llm.registry import query, table

SQL = """with messages as (
  select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text,
         floor(turn / 32)::bigint as block from conversations),
said as (
  select *, (row_number() over (partition by conv_id, block order by turn, role, text) - 1) // 128 as part from messages),
people as (select distinct conv_id, role as speaker from said)
select s.conv_id, speaker, block, part::bigint as part,
       string_agg('<|im_start|>' || case when role = speaker then 'assistant' else 'user name=' || role end || chr(10)
                  || text || '<|im_end|>' || chr(10), '' order by turn, role, text) as dialogue,
       string_agg(case when role = speaker then '1' else '0' end, '' order by turn, role, text) as mask,
       count(*) as n_messages, count(*) filter (role = speaker) as n_trained,
       coalesce(sum(length(text)) filter (role = speaker), 0)::bigint as trained_chars
from said s join people p on p.conv_id is not distinct from s.conv_id
group by s.conv_id, speaker, block, part"""


@query("op6_chat", SQL)
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))
