"""A training corpus from raw documents: rules, near-duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are written as
Parquet and read again, so that a stage may read its input several times and survives lost executors. All
but the last return the columns of ``documents``, whatever columns that has.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import Codec, encoded
from tidemark.llm.decontaminate import without_leaks
from tidemark.llm.frames import stored
from tidemark.llm.neardup import one_of_each_similar
from tidemark.llm.quality import keep_good
from tidemark.llm.substrings import without_repeats

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and come from hosts that do."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 0.8 of their five-word shingles."""
    return one_of_each_similar(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur again in what the stage was given. ``n_chars``, where
    it is a column, is that of the text that is left."""
    out = without_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian 32-bit integers), their number, and the digests of ids
    and decoded text."""
    return encoded(docs, Codec(TOKENIZER)).select(
        F.col("id").alias("doc_id"),
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup by shared shingles", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("bpe encoding", encoding),
]

# Fingerprints (XXH64), alignments and BPE have no counterpart in SQL; tests/llm holds a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
