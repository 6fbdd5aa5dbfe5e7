"""Column statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.operators.levels import level_counts, level_summary
from clickfeat.roles import CATEGORICAL, NUMERIC, Roles


def numeric_summary(df: DataFrame, roles: Roles, columns: Sequence[str] | None = None) -> DataFrame:
    """``pos, col, min, max, mean, sum, n`` per numeric column, label included, over present cells.

    One scan and one aggregate for all columns, then one output row per column.
    """
    names = columns or (roles.label, *roles.numeric)
    measures = {"min": F.min, "max": F.max, "sum": F.sum, "n": F.count}
    row = df.agg(
        *[
            f(F.col(c).cast("double")).alias(f"_{i}_{m}")
            for i, c in enumerate(names)
            for m, f in measures.items()
        ]
    )
    cells = [
        F.struct(
            F.lit(roles.position(c)).alias("pos"),
            F.lit(c).alias("col"),
            *[F.col(f"_{i}_{m}").alias(m) for m in measures],
            F.try_divide(F.col(f"_{i}_sum"), F.col(f"_{i}_n")).alias("mean"),
        )
        for i, c in enumerate(names)
    ]
    table = row.select(F.inline(F.array(*cells)))
    return table.select("pos", "col", "min", "max", "mean", "sum", "n")


def level_cardinality(df: DataFrame, roles: Roles, include_id: bool = False) -> DataFrame:
    """Distinct present levels per categorical column."""
    counts = level_counts(df, roles, include_id=include_id)
    return level_summary(counts).select("pos", "col", "levels")


def level_modes(df: DataFrame, roles: Roles, include_id: bool = False) -> DataFrame:
    """Most frequent level per categorical column and its count."""
    counts = level_counts(df, roles, include_id=include_id)
    return level_summary(counts).select("pos", "col", "mode", "mode_n")


def summarise(df: DataFrame, roles: Roles, include_id: bool = False) -> DataFrame:
    """The table summary, one row per column: a numeric aggregate and one level table.

    ``pos, col, kind, min, max, mean, sum, n, mode, levels``; statistics that do not apply are NULL.
    """
    numbers = numeric_summary(df, roles).withColumns(
        {
            "kind": F.lit(NUMERIC),
            "mode": F.lit(None).cast("bigint"),
            "levels": F.lit(None).cast("bigint"),
        }
    )
    levels = level_summary(level_counts(df, roles, include_id=include_id)).withColumn(
        "kind", F.lit(CATEGORICAL)
    )
    table = numbers.unionByName(levels.drop("mode_n"), allowMissingColumns=True)
    return table.select("pos", "col", "kind", "min", "max", "mean", "sum", "n", "mode", "levels")


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``col, mean`` over present cells."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)])
    cells = [
        F.struct(F.lit(c).alias("col"), F.col(f"_{i}").alias("mean")) for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*cells)))


def means_of(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The same as a dictionary: one number per column."""
    return {r["col"]: r["mean"] for r in column_means(df, columns).collect()}


def bounds_of(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """``{column: (min, max, missing cells?)}`` from one aggregate."""
    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        aggregates += [
            F.min(value).alias(f"_{i}_min"),
            F.max(value).alias(f"_{i}_max"),
            F.coalesce(F.bool_or(value.isNull()), F.lit(False)).alias(f"_{i}_gap"),
        ]
    row = df.agg(*aggregates).first()
    return {
        c: (row[f"_{i}_min"], row[f"_{i}_max"], row[f"_{i}_gap"]) for i, c in enumerate(columns)
    }
