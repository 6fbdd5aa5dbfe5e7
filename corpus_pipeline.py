"""From raw documents to packed training sequences: stages, each written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickfeat.llm.common import new_path
from clickfeat.llm.exact_dedup import drop_copies
from clickfeat.llm.mixing import mixed
from clickfeat.llm.near_dedup import drop_near_copies
from clickfeat.llm.packing import pack
from clickfeat.llm.quality_rules import clean


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    return clean(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the smallest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights: a row for each copy that the mix takes."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixing", mixing),
    ("packing", packing),
]

#: Packing needs a tokenizer and near-dedup a similarity join, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` and return the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
