"""The corpus pipeline: rejects toxic documents, keeps one of each group of near copies, drops documents that hold
benchmark passages, mixes sources to their target weights, and writes token records.

Each stage takes (spark, docs, sf_dir) and returns a table that is written before the next one reads it. All but the
last return the columns of `documents`; the last returns what the written records hold.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padronix.llm import decontamination, jaccard, mixing, records, toxicity
from padronix.llm.batches import materialize, shared_folder


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned on the labelled ones among `docs`, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean_documents(docs, toxicity.learn(docs, labels))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts."""
    return jaccard.one_per_group(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the written records hold: doc_id, start, n_tokens, ids_crc32, in the order of doc_id."""
    folder = f"{shared_folder(spark)}/tokens"
    records.write_records(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    back = records.read_records(spark, folder)
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_copies", near_copies_stage),
    ("benchmark", benchmark_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again in the shared folder."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), folder, name)
    return docs
