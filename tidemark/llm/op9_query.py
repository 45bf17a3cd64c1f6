"""op9_quality: quality rules over all documents."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.quality import quality
from tidemark.llm.registry import query, table

JUDGED_SQL = r"""
texts as (
  select doc_id, source as host, coalesce(text, '') as text, row_number() over () as r from documents),
split as (
  select r, doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from texts),
windows as (
  select r, i, array_to_string(w[i:i + 7], ' ') as shingle
  from (select r, w, unnest(range(1, len(w) - 6)) as i from split)),
twice as (
  select r, i from (select r, i, count(*) over (partition by r, shingle) as n from windows) where n > 1),
covered as (
  select r, sum(step)::bigint as n_repeat_words
  from (select r, least(8, coalesce(lead(i) over (partition by r order by i) - i, 8)) as step from twice)
  group by r),
measured as (
  select doc_id, host, text, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words, split.r as r
  from split left join covered on split.r = covered.r),
judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured),
hosts as (select host, count(*) as n, sum(base_failed::int) as bad from judged group by host),
whole as (select (sum(bad) + 1) / (sum(n) + 2) as mean, sum(n) as all_n, count(*) as hosts from hosts),
fit as (
  select mean, 1 / least(greatest((sum(n * pow(bad / n - mean, 2)) / (mean * (1 - mean)) - any_value(whole.hosts))
                                  / greatest(any_value(all_n) - any_value(whole.hosts), 1), 0.0001), 0.99) - 1 as strength
  from hosts, whole group by mean),
shrunk as (select host, n + strength as total, (bad + mean * strength) / (n + strength) as rate from hosts, fit),
bad_hosts as (select host from shrunk where rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5)
"""

SQL = f"""with {JUDGED_SQL}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not exists (select 1 from bad_hosts b where b.host is not distinct from judged.host) as kept
from judged"""


@query("op9_quality", SQL)
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
