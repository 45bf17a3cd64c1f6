"""op5_html: the main text of every page."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.registry import query, table
from tidemark.llm.wrappers import extract


@query("op5_html")
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
