"""Exact length histogram: what a corpus holds under every context limit.

Documents are counted by encoded length; suffix sums over the lengths then answer totals, quantiles
and truncated totals for any limit without another pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import keep, query, table
from clickfeat.llm.tokens import WordEncoder, in_chunks, vocabulary_path
from clickfeat.operators.ordering import running_totals, store_in_order


def _lengths(path: str):
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder(path)
        for batch in batches:
            texts = batch["_text"].tolist()
            for start, stop in in_chunks(texts):
                yield pd.DataFrame({"tokens": encoder.encode(texts[start:stop])[1]})

    return counted


def length_histogram(
    docs: DataFrame, text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Documents by encoded length: ``tokens, n_docs``. Null text has length 0."""
    path = vocabulary or vocabulary_path()
    lengths = docs.select(F.col(text_col).alias("_text")).mapInPandas(_lengths(path), "tokens bigint")
    return lengths.groupBy("tokens").agg(F.count("*").alias("n_docs"))


def by_limit(histogram: DataFrame) -> DataFrame:
    """One row for each length that occurs, read as a context limit.

    ``n_docs`` have just this length, ``n_longer`` exceed it, ``tokens_longer`` are the tokens of
    those; ``n_within`` and ``tokens_within`` are of documents that fit, ``total_docs`` and
    ``total_tokens`` of all; ``truncated_tokens`` is the total with every document cut at the limit,
    and ``quantile`` the share of documents that fit. Between two lengths, the row of the shorter one
    has the counts, and ``tokens_within + limit * n_longer`` the truncated total. An empty table
    gives no rows.
    """
    stored = keep(histogram, "length-histogram")
    n, t = stored.agg(F.sum("n_docs"), F.sum(F.col("tokens") * F.col("n_docs"))).first()
    ordered = store_in_order(
        stored.withColumn("_down", -F.col("tokens")), ["_down"], "lengths-down"
    )
    suffix = running_totals(
        ordered,
        ["_down"],
        {"_docs": F.col("n_docs"), "_tokens": F.col("tokens") * F.col("n_docs")},
    )
    docs, tokens = F.lit(n).cast("bigint"), F.lit(t).cast("bigint")
    longer = F.col("_docs") - F.col("n_docs")
    tokens_longer = F.col("_tokens") - F.col("tokens") * F.col("n_docs")
    return suffix.select(
        "tokens",
        "n_docs",
        longer.alias("n_longer"),
        tokens_longer.alias("tokens_longer"),
        (docs - longer).alias("n_within"),
        (tokens - tokens_longer).alias("tokens_within"),
        (tokens - tokens_longer + F.col("tokens") * longer).alias("truncated_tokens"),
        ((docs - longer) / docs).alias("quantile"),
        docs.alias("total_docs"),
        tokens.alias("total_tokens"),
    )


def length_at(limits: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of all documents fit in, as one row."""
    return limits.filter(F.col("quantile") >= share).agg(F.min("tokens").alias("tokens"))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_limit(length_histogram(table(spark, sf_dir, "documents")))
