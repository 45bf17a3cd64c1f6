"""op10_bpe: ids and decoded text of every document under a public vocabulary."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import Codec, digests
from tidemark.llm.registry import query, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), Codec(TOKENIZER))
