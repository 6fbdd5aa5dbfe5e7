"""Fill missing cells with fitted values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.operators.levels import level_counts, level_summary
from clickfeat.operators.summary import column_means, means_of
from clickfeat.roles import Roles


def mean_mode_table(df: DataFrame, roles: Roles) -> DataFrame:
    """``col, mean, mode``: means of numeric columns (label included), modes of categorical ones."""
    means = column_means(df, (roles.label, *roles.numeric))
    modes = level_summary(level_counts(df, roles)).select("col", "mode")
    return means.unionByName(modes, allowMissingColumns=True)


def fill_values(df: DataFrame, values: Mapping[str, float | int | None]) -> DataFrame:
    """Fill each column's missing cells with its value; a column without a value stays as it is.

    A fractional value turns an integer column into double.
    """
    filled = {
        c: F.coalesce(F.col(c).cast("double") if isinstance(v, float) else F.col(c), F.lit(v))
        for c, v in values.items()
        if v is not None and c in df.columns
    }
    return df.withColumns(filled) if filled else df


def fill_column_mean(df: DataFrame) -> DataFrame:
    """Fill every column of an all-number table with its own mean."""
    return fill_values(df, means_of(df, df.columns))
