"""Helpers of the operators in this folder: stored tables, ASCII folding, skewed lookups, registry."""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.workspace import new_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Everything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, every executor can read it."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes Spark's byte-wise path."""
    translated = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(translated)


def lookup(
    left: DataFrame, facts: DataFrame, keys: Sequence[str], rows: str, how: str = "left"
) -> DataFrame:
    """Join ``facts`` (one row per ``keys``) to ``left``, hot keys by broadcast.

    ``facts`` has in ``rows`` the number of left rows of the key. Keys with over half of a
    partition's share of all left rows are hot: there are at most two for each shuffle partition, so
    they are broadcast and their rows stay where they are. All others are joined by a shuffle of
    rows that are spread evenly. Keys must not be null. Both inputs should be stored tables.
    """
    spark = left.sparkSession
    total = facts.agg(F.sum(rows)).first()[0] or 0
    limit = max(1.0, total / (2 * partitions(spark)))
    hot = F.broadcast(facts.filter(F.col(rows) > limit))
    cold = facts.filter(F.col(rows) <= limit)
    names = list(keys)
    marked = left.join(
        F.broadcast(facts.filter(F.col(rows) > limit).select(*names)), names, "left_semi"
    )
    rest = left.join(
        F.broadcast(facts.filter(F.col(rows) > limit).select(*names)), names, "left_anti"
    )
    return marked.join(hot, names).unionByName(rest.join(cold, names, how))
