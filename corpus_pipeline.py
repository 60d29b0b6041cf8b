"""The corpus pipeline: from ``documents`` to token ids.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read back as the docs of the next one. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pathlib import PurePosixPath

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import bpe, exact_dedup, mixing, simhash, toxicity
from panelkit.session import work_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text does not score as toxic."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.keep_first(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return simhash.keep_one_per_group(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the target mix reads them: some left out, some more than once."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and what they decode to, as digests."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("mix_sources", mixing_stage),
    ("bpe", encoding_stage),
]

#: A trained classifier and the SimHash links have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = work_dir(spark, "pipeline")
    for name, stage in STAGES:
        path = str(PurePosixPath(root) / name) if "://" not in root else f"{root}/{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
