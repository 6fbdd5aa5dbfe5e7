"""Sketched cardinalities and modes against exact ones."""

import pytest
from pyspark.sql import functions as F

from clickfeat import Roles
from clickfeat.operators import sketches as sk
from clickfeat.operators import summary
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def columns(spark):
    """A steep column, a flat one, a tie, few levels, nulls only, many levels with a heavy one."""
    roles = Roles("id", "y", (), ("steep", "flat", "tie", "few", "none", "heavy"))
    i = F.col("id")
    df = spark.range(0, 30_000, 1, 5).select(
        "id", F.lit(1.0).alias("y"), F.floor(F.sqrt(i)).cast("bigint").alias("steep"), i.alias("flat"),
        F.when(i % 3 == 0, 50 - i % 2).alias("tie"), (i % 40).alias("few"),
        F.lit(None).cast("bigint").alias("none"), F.when(i % 4 == 0, -9).otherwise(i).alias("heavy"),
    )
    return df, roles


def test_modes_equal_exact_ones(columns, clicks):
    for df, roles in (columns, clicks):
        assert rows_of(sk.heavy_modes(df, roles)) == rows_of(summary.level_modes(df, roles))


@pytest.mark.parametrize("items", [64, 1024])
def test_modes_by_sketches_that_drop_levels(columns, items):
    df, roles = columns
    assert rows_of(sk.heavy_modes(df, roles, items)) == rows_of(summary.level_modes(df, roles))


def test_only_flat_columns_are_counted_in_full(columns, monkeypatch):
    df, roles = columns
    full = []
    real = sk.level_counts
    monkeypatch.setattr(sk, "level_counts", lambda d, r, columns: full.append(columns) or real(d, r, columns=columns))
    sk.heavy_modes(df, roles.keep(["flat", "few", "none", "heavy", "tie"]))
    assert full == [["flat", "none"]]


def test_estimates_hold_and_merge(columns):
    df, roles = columns
    true = {r["col"]: r["levels"] for r in summary.level_cardinality(df, roles).collect()}
    parts = [sk.level_sketches(df.filter(F.col("id") % 3 == k), roles) for k in range(3)]
    for sketches in (sk.level_sketches(df, roles), sk.merge_sketches(*parts)):
        for r in sk.estimated_levels(sketches).collect():
            assert r["low"] <= true[r["col"]] <= r["high"]
            assert abs(r["levels"] - true[r["col"]]) <= 0.03 * true[r["col"]] + 1


@pytest.mark.parametrize("bound", [1, 2, 40, 41, 174, 22_500, 30_000, 30_001])
def test_columns_below_a_bound(columns, bound):
    df, roles = columns
    true = {r["col"]: r["levels"] for r in summary.level_cardinality(df, roles).collect()}
    assert sk.columns_below(df, roles, bound) == [c for c in roles.categorical if true[c] < bound]


def test_columns_far_from_the_bound_are_not_counted(columns, monkeypatch):
    df, roles = columns
    monkeypatch.setattr(sk, "level_counts", None)
    sketches = sk.merge_sketches(*[sk.level_sketches(df.filter(F.col("id") % 2 == k), roles) for k in (0, 1)])
    assert sk.columns_below(df, roles, 1000, sketches) == ["steep", "tie", "few", "none"]
    exchange = sketches._jdf.queryExecution().executedPlan().toString()
    assert "steep" not in exchange.split("HashAggregate")[0]


def test_empty_tables(columns):
    df, roles = columns
    assert sk.columns_below(df.limit(0), roles, 1) == list(roles.categorical)
    assert sk.heavy_modes(df.limit(0), roles).filter("mode IS NOT NULL").count() == 0
    assert sk.heavy_modes(df, Roles("id", "y", ("steep",), ())).count() == 0
