"""Cardinalities and modes by sketches, exact where it matters.

Counting levels exactly shuffles one row for each level. A sketch of fixed size answers most questions
without: distinct counts with a known error, and the few levels that can be a column's mode. Whatever a sketch leaves
open is counted exactly, for the columns concerned only, so results are those of the exact operators.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.operators.levels import level_counts, level_summary
from clickfeat.operators.lookup import SKETCH_ITEMS
from clickfeat.roles import Roles
from clickfeat.workspace import small_table

LG_SIZE = 14
"""A distinct-count sketch has 2^14 slots of a byte at most."""

ERRORS = 4
"""Standard errors on both sides of an estimate within which the true count is taken to lie."""

CANDIDATES = 1000
"""Levels of a column that are counted exactly as possible modes."""


def level_sketches(df: DataFrame, roles: Roles, columns: Sequence[str] | None = None) -> DataFrame:
    """``pos, col, sketch`` per categorical column: one aggregate that shuffles one row a task."""
    names = list(columns or roles.categorical)
    row = df.agg(
        *[F.hll_sketch_agg(F.col(c).cast("bigint"), LG_SIZE).alias(f"_{i}") for i, c in enumerate(names)]
    )
    cells = [
        F.struct(F.lit(roles.position(c)).alias("pos"), F.lit(c).alias("col"), F.col(f"_{i}").alias("sketch"))
        for i, c in enumerate(names)
    ]
    return row.select(F.inline(F.array(*cells)))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketches of all tables together; their rows are not needed."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy("pos", "col").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_levels(sketches: DataFrame) -> DataFrame:
    """``pos, col, levels, low, high``: the estimate, and the bounds of the true number of present levels."""
    error = ERRORS * 1.04 / 2 ** (LG_SIZE / 2)
    levels = F.hll_sketch_estimate("sketch")
    return sketches.select(
        "pos", "col", levels.alias("levels"), F.floor(levels * (1 - error)).alias("low"),
        F.ceil(levels * (1 + error)).alias("high"),
    )


def columns_below(
    df: DataFrame, roles: Roles, bound: int, sketches: DataFrame | None = None
) -> list[str]:
    """The categorical columns of fewer than ``bound`` present levels.

    Only columns whose estimate is too near the bound are counted. ``sketches`` passes those of ``df``
    where they are known.
    """
    sketches = level_sketches(df, roles) if sketches is None else sketches
    found = {r["col"]: r for r in estimated_levels(sketches).collect()}  # a row for each column
    below = {c for c in roles.categorical if found[c]["high"] < bound}
    near = [c for c in roles.categorical if found[c]["low"] < bound <= found[c]["high"]]
    if near:
        exact = level_summary(level_counts(df, roles, columns=near)).collect()
        below |= {r["col"] for r in exact if r["levels"] < bound}
    return [c for c in roles.categorical if c in below]


def heavy_modes(df: DataFrame, roles: Roles, items: int = SKETCH_ITEMS) -> DataFrame:
    """``pos, col, mode, mode_n`` per categorical column, the smallest of equally frequent levels.

    A sketch names each column's frequent levels, a second pass counts those exactly. A level that it doesn't
    name has at most twice the sketch's error, or no more rows than the last one named; a column whose best level is
    not above that is too flat for the sketch and counted in full. What is shuffled does not depend
    on the number of levels of the others.
    """
    names = list(roles.categorical)
    if not names:
        empty = small_table(df.sparkSession, ["pos"], [pa.int32()], [])
        return empty.selectExpr("pos", "'' AS col", "0L AS mode", "0L AS mode_n")
    cells = df.select(*[F.col(c).cast("bigint").alias(c) for c in names])
    sketch = [
        F.expr(f"approx_top_k(`{c}`, {min(CANDIDATES, items)}, {items})").alias(f"_{i}") for i, c in enumerate(names)
    ]
    found = cells.agg(F.count(F.lit(1)).alias("rows"), *sketch).first()
    named = {c: found[f"_{i}"] for i, c in enumerate(names)}
    candidates = small_table(
        df.sparkSession, ["col", "value"], [pa.string(), pa.int64()],
        [(c, t["item"]) for c, top in named.items() for t in top if t["item"] is not None],
    )
    long = cells.unpivot([], names, "col", "value")
    counted = long.join(F.broadcast(candidates), ["col", "value"]).groupBy("col", "value").agg(F.count("*").alias("n"))
    best = counted.groupBy("col").agg(F.max_by(F.struct("value", "n"), F.struct("n", -F.col("value"))).alias("best"))
    modes = {r["col"]: r["best"] for r in best.collect()}

    slots = 1 << (-(-4 * items // 3) - 1).bit_length()  # of the sketch's table
    least = 2 * 3.5 / slots * found["rows"]

    def settled(c: str) -> bool:
        top = named[c]
        rest = top[-1]["count"] if len(top) == min(CANDIDATES, items) else 0
        return c in modes and modes[c]["n"] > max(least, rest)

    flat = [c for c in names if not settled(c)]
    rows = [(roles.position(c), c, modes[c]["value"], modes[c]["n"]) for c in names if c not in flat]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
    known = small_table(df.sparkSession, ["pos", "col", "mode", "mode_n"], kinds, rows)
    if not flat:
        return known
    exact = level_summary(level_counts(df, roles, columns=flat)).select("pos", "col", "mode", "mode_n")
    return known.unionByName(exact)
