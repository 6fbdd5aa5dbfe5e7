"""Splits of a table, by a stable hash of a key or at random."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.operators.ordering import FILE, POSITION

BUCKETS = 10_000


def hash_bucket(key: Column, seed: int = 0, buckets: int = BUCKETS) -> Column:
    """A bucket that depends on the key and the seed alone: the same on every run and cluster."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def part_of(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """The number of the part a key falls into. Weights need not sum to 1."""
    ends = [round(BUCKETS * end / sum(weights)) for end in accumulate(weights)]
    if any(w > 0 and a == b for w, a, b in zip(weights, [0, *ends], ends)):
        raise ValueError(f"a part below 1/{BUCKETS} of the rows can't be split off: {weights}")
    bucket = hash_bucket(key, seed)
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        part = F.when(bucket < ends[i], F.lit(i)).otherwise(part)
    return part


def split_hash(
    df: DataFrame, key: str, weights: Sequence[float], seed: int = 0
) -> list[DataFrame]:
    """One frame per weight; rows with equal keys stay together."""
    part = part_of(F.col(key), weights, seed)
    return [df.filter(part == i) for i in range(len(weights))]


def random_part(columns: Sequence[str], weights: Sequence[float], seed: int) -> Column:
    """The part of a row by a seeded hash of its own values: the same on every run and cluster.

    One expression, so a single pass tags all parts and nothing is sorted. Equal rows go together.
    """
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return part_of(F.concat_ws("|", *cells), weights, seed)


def split_random(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random parts by the values of whole rows."""
    part = random_part(df.columns, weights, seed)
    return [df.filter(part == i) for i in range(len(weights))]


def row_part(weights: Sequence[float], seed: int) -> Column:
    """The part of a row by a hash of where it stands in its file, for rows of :func:`file_positions`.

    Equal rows are drawn one by one. The part depends on file name, position and seed alone, so a retried task
    or another cluster gives the same.
    """
    return part_of(F.concat_ws(":", FILE, POSITION), weights, seed)


def split_counts(df: DataFrame, key: str, weights: Sequence[float], seed: int = 0) -> DataFrame:
    """Rows of the table and of every part, in one pass: ``total, part_0, part_1, ...``."""
    part = part_of(F.col(key), weights, seed)
    return df.select(part.alias("part")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("part") == i).alias(f"part_{i}") for i in range(len(weights))],
    )
