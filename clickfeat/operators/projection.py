"""Column choice, column-wise maps and missing-cell counts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.roles import Roles, resolve

ColumnMap = Callable[[Column, str], Column]


def project_by_index(df: DataFrame, keep: Callable[[int], bool] | Iterable[int]) -> DataFrame:
    """Columns whose position satisfies a predicate or is in a set, in table order."""
    test = keep if callable(keep) else set(keep).__contains__
    return df.select(*[c for i, c in enumerate(df.columns) if test(i)])


def project_by_kind(df: DataFrame, roles: Roles, keep: Callable[[str, str], bool]) -> DataFrame:
    """Columns whose ``(name, kind)`` satisfies a predicate, in table order."""
    return df.select(*[c for c in df.columns if keep(c, roles.kind(c))])


def project_by_name(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Named columns in table order; unknown names are ignored."""
    names = set(names)
    return df.select(*[c for c in df.columns if c in names])


def project_by_reference(df: DataFrame, references: Iterable[int | str]) -> DataFrame:
    """Columns by position or name, in the order given; unknown ones raise."""
    return df.select(*[resolve(df, r) for r in references])


def map_rows(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """A row map: every output column is an expression over the row."""
    return df.select(*[value.alias(name) for name, value in columns.items()])


def map_columns(df: DataFrame, names: Iterable[str], f: ColumnMap) -> DataFrame:
    return df.withColumns({c: f(F.col(c), c) for c in names})


def map_categorical(df: DataFrame, roles: Roles, f: ColumnMap) -> DataFrame:
    """Map every categorical feature (not the id)."""
    return map_columns(df, roles.categorical, f)


def map_numeric(df: DataFrame, roles: Roles, f: ColumnMap, with_label: bool = False) -> DataFrame:
    """Map every numeric feature, and the label if asked."""
    return map_columns(df, roles.numeric + ((roles.label,) if with_label else ()), f)


def missing_counts(df: DataFrame, roles: Roles) -> DataFrame:
    """One row per column: rows, present cells, missing cells. One scan, one aggregate."""
    present = [F.count(c).alias(f"_{i}") for i, c in enumerate(roles.columns)]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *present)
    cells = [
        F.struct(
            F.lit(c).alias("col"),
            F.col(f"_{i}").alias("present"),
            (F.col("rows") - F.col(f"_{i}")).alias("missing"),
        )
        for i, c in enumerate(roles.columns)
    ]
    return counted.select(F.inline(F.array(*cells)))


def preview(df: DataFrame, n: int, by: str) -> DataFrame:
    """The first ``n`` rows in the order of one column."""
    return df.orderBy(by).limit(n)
