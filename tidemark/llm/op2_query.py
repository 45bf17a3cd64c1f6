"""op2_lm: scores of every document under a log-bilinear model and under word frequencies."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.lm import scores
from tidemark.llm.registry import query, table


@query("op2_lm")
def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
