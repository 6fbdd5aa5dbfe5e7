"""Numeric transforms: constant fill, min-max, log. Bounds are ``{column: (min, max, ...)}``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.numeric import log_min_max, min_max, shifted_log


def fill_constant(df: DataFrame, columns: Iterable[str], value: float) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(value))) for c in columns}
    )


def scale_minmax(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({c: min_max(F.col(c), b[0], b[1]) for c, b in bounds.items()})


def scale_minmax_filled(df: DataFrame, bounds: Mapping[str, tuple], fill: float = 0.0) -> DataFrame:
    """Fill missing cells, then min-max with bounds taken before the fill."""
    return scale_minmax(fill_constant(df, bounds, fill), bounds)


def scale_log(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({c: shifted_log(F.col(c), b[0]) for c, b in bounds.items()})


def scale_log_minmax(df: DataFrame, bounds: Mapping[str, tuple], fill: float = 0.0) -> DataFrame:
    """Fill missing cells, then log min-max with bounds taken before the fill."""
    filled = fill_constant(df, bounds, fill)
    return filled.withColumns({c: log_min_max(F.col(c), b[0], b[1]) for c, b in bounds.items()})
