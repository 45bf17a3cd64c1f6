"""op1_licenses: known licences among documents and their lines."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.licences import KNOWN, SPELLINGS, known_digests, license_scan
from tidemark.llm.registry import query, table


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lines_sql(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for spelling, usual in SPELLINGS:
        out = f"replace({out}, {_quoted(spelling)}, {_quoted(usual)})"
    out = rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    lines = f"list_transform(string_split({out}, chr(10)), lambda x: trim(x))"
    return f"list_filter({lines}, lambda x: x <> '' and not starts_with(x, 'copyright ') and x <> 'all rights reserved')"


VALUES = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, all_ in KNOWN.items() for text in all_)
SQL = f"""with known as (
  select distinct md5(array_to_string({_lines_sql('t')}, ' ')) as digest, license from (values {VALUES}) v(license, t)),
cut as (select row_number() over () as r, doc_id, {_lines_sql('text')} as lines from documents),
found as (
  select r, string_agg(distinct license, ',' order by license) as notices, count(*) as notice_lines
  from (select r, md5(unnest(lines)) as digest from cut) join known using (digest) group by r)
select doc_id, md5(array_to_string(lines, ' ')) as digest, license, notices, coalesce(notice_lines, 0)::bigint as notice_lines
from cut left join known on known.digest = md5(array_to_string(lines, ' ')) left join found on found.r = cut.r"""


@query("op1_licenses", SQL)
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), known_digests(spark))
