"""op8_urls: a verdict on every page's url."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.reputation import UrlRule, judge_urls

RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)


def _level_sql(name: str, children: str, parents: str, parent: str) -> str:
    return f"""
{name}_joined as (select c.*, p.mean as prior from {children} c join {parents} p using ({parent})),
{name}_fit as (
  select 1 / least(greatest(coalesce((coalesce(sum(case when n > 0 then n * pow(bad / n - prior, 2) / (prior * (1 - prior)) end), 0)
           - sum((n > 0)::int)) / greatest(sum(n) - sum((n > 0)::int), 1), 0), 0.0001), 0.99) - 1 as strength
  from {name}_joined),
{name} as (select j.*, n + strength as total, (bad + prior * strength) / (n + strength) as mean from {name}_joined j, {name}_fit)"""


SUFFIXES = "('co.uk', 'org.uk', 'ac.uk', 'com.au', 'net.au', 'co.jp', 'co.nz', 'com.br')"
SQL = (
    rf"""with cut as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
counted as (
  select host, sum(n) as n, sum(bad) as bad
  from (select host, (quality is not null)::int as n, (coalesce(quality = 0 or toxic = 1, false))::int as bad
        from cut left join labels on doc_id = page_id)
  group by host),
hosts as (
  select host, n, bad, string_split(host, '.') as parts,
         array_to_string(parts[-2:], '.') as two, case when two in {SUFFIXES} then two else parts[-1] end as suffix,
         case when two in {SUFFIXES} then array_to_string(parts[-3:], '.') else two end as domain
  from counted),
domains as (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by domain, suffix),
suffixes as (select suffix, 1 as everything, sum(n) as n, sum(bad) as bad from domains group by suffix),
overall as (select 1 as everything, (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) as mean from hosts),"""
    + ",".join(
        (
            _level_sql("suffix_rates", "suffixes", "overall", "everything"),
            _level_sql("domain_rates", "domains", "suffix_rates", "suffix"),
            _level_sql("host_rates", "(select host, domain, n, bad from hosts)", "domain_rates", "domain"),
        )
    )
    + """
select page_id, cut.host, path,
       case when (cut.host = 'example.org' or cut.host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
            when (cut.host = 'example.org' or cut.host like '%.example.org') and path like '/es/%' then 'example.org/es/'
            when (cut.host = 'com' or cut.host like '%.com') and path like '/fr/%' then 'com/fr/'
            when (cut.host = 'com' or cut.host like '%.com') and path like '/de/%' then 'com/de/'
            when (cut.host = 'org' or cut.host like '%.org') and path like '/%' then 'org/' end as rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
            when mean - 1.645 * sqrt(mean * (1 - mean) / (total + 1)) > 0.5 then 'block' else 'allow' end as verdict
from cut join host_rates on cut.host = host_rates.host"""
)


@query("op8_urls", SQL)
def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled page is bad when its label says low quality or toxic."""
    labels = table(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    outcomes = labels.filter("quality is not null").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes, RULES)
