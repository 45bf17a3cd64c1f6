"""op7_simhash: fingerprint and near-duplicate group of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.simhash import groups, hex_print


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), hex_print(F.col("fp")).alias("fingerprint"), "component_id")
