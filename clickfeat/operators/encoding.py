"""Replace categorical levels by what a fitted level table says about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.operators.levels import LevelTable, level_counts, target_rates
from clickfeat.operators.lookup import BROADCAST_LEVELS, attach
from clickfeat.roles import Roles


def replace_levels(
    df: DataFrame,
    roles: Roles,
    table: LevelTable,
    source: str,
    otherwise=lambda level: F.lit(None),
    broadcast_levels: int = BROADCAST_LEVELS,
) -> DataFrame:
    """Every categorical cell becomes its level's ``source`` value, or ``otherwise(cell)``."""
    columns = [c for c in roles.categorical if c in df.columns]
    found = attach(df, table, {c: {f"__{c}_new": source} for c in columns}, broadcast_levels)

    def cell(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        return F.coalesce(F.col(f"__{name}_new"), otherwise(F.col(name))).alias(name)

    return found.select(*[cell(c) for c in df.columns])


def frequent_levels(counts: LevelTable, more_than: int) -> LevelTable:
    """Present levels with strictly more rows than ``more_than``."""
    return counts.where(F.col("value").isNotNull() & (F.col("n") > more_than))


def drop_rare_levels(df: DataFrame, roles: Roles, frequent: LevelTable, **kw) -> DataFrame:
    """Rare and unseen levels become missing."""
    return replace_levels(df, roles, frequent, "value", **kw)


def index_levels(df: DataFrame, roles: Roles, numbered: LevelTable, **kw) -> DataFrame:
    """Levels become their number; missing and unseen levels -1."""
    return replace_levels(df, roles, numbered, "idx", lambda _: F.lit(-1).cast("bigint"), **kw)


def fit_target_rates(df: DataFrame, roles: Roles) -> LevelTable:
    return LevelTable.keep(target_rates(level_counts(df, roles, keep_missing=False, by_label=True)))


def target_encode(
    df: DataFrame,
    roles: Roles,
    rates: LevelTable,
    unseen: str = "raw",
    prior: float | None = None,
    **kw,
) -> DataFrame:
    """Levels become their label mean.

    A level the table does not hold passes through as a number (``raw``), becomes missing
    (``null``) or gets the label mean of all rows (``prior``). Missing cells stay missing.
    """
    others = {
        "raw": lambda level: level.cast("double"),
        "null": lambda level: F.lit(None).cast("double"),
        "prior": lambda level: F.when(level.isNotNull(), F.lit(prior)),
    }
    if unseen not in others:
        raise ValueError(f"unseen must be one of {sorted(others)}, not {unseen!r}")
    return replace_levels(df, roles, rates, "rate", others[unseen], **kw)


def rate_means(rates: LevelTable) -> dict[str, float]:
    """The mean of every encoded column of the table the rates were fitted on.

    From the level table: the rows themselves need not be encoded for it. One row per column.
    """
    sums = rates.frame.groupBy("col").agg((F.sum("label_sum") / F.sum("n")).alias("mean"))
    return {r["col"]: float(r["mean"]) for r in sums.collect()}


def as_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
