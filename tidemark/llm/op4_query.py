"""op4_substrings: what is left of every document without repeated windows of 35 words."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.substrings import kept_words


@query("op4_substrings")
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
