"""op3_decontaminate: regions of documents that hold passages of the benchmark."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import leaks
from tidemark.llm.registry import query, table


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
