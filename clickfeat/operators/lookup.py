"""Attach facts about levels to the rows that hold them.

Ids need not be unique, and a table may have dozens of categorical columns, so:

- A column's levels are broadcast while the levels broadcast so far fit a fixed budget.
- All columns beyond it share one lookup, whatever their number. First a sketch finds the levels that
  hold a large share of the rows at hand, whether the level table has them or not. They are few, so their
  facts are broadcast, and a cell of such a level, or a missing one, is settled where it is. Every other
  cell becomes a narrow row ``(row key, column, level)``; all these join the level tables in one shuffle,
  are put together again by row key, and meet their rows in one more.
- The row key is a hash of the row's unsettled levels, which alone decide what is found. It depends on
  nothing but the values, so a retried task gives the same keys. A key holds a cold level, so it can't
  be hot either. Rows without unsettled cells are not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.operators.levels import LevelTable
from clickfeat.workspace import small_table, store

BROADCAST_LEVELS = 2_000_000
"""Levels broadcast per lookup over all columns; a few tens of bytes each."""

HOT_SHARE = 1 / 1000
"""A level with at least this share of rows is hot, so a column has at most 1000 of them."""

SKETCH_ITEMS = 10_000
"""Levels a column's sketch tracks: its error stays below half of :data:`HOT_SHARE`."""

_KEYS = ("__key_1", "__key_2")


def attach(
    df: DataFrame,
    table: LevelTable,
    wanted: Mapping[str, Mapping[str, str]],
    broadcast_levels: int = BROADCAST_LEVELS,
) -> DataFrame:
    """For each column, add table columns (``{column: {new name: table column}}``) by level.

    Missing levels and levels the table does not hold get NULL. Beyond the broadcast budget, ``df`` is
    read up to four times: by the sketch, by the cells, and by rows with and without unsettled cells.
    """
    sizes = {c: table.rows.get(c, 0) for c in wanted}
    small, budget = set(), broadcast_levels
    for column in sorted(wanted, key=sizes.get):
        budget -= sizes[column]
        if budget < 0:
            break
        small.add(column)
    large = {c: facts for c, facts in wanted.items() if c not in small}
    if large:
        df = _shared_lookup(df, table, large)
    for column, facts in wanted.items():
        if column in small:
            df = _broadcast_join(df, table, column, facts)
    return df


def _side(table: LevelTable, column: str, facts: Mapping[str, str], key: str) -> DataFrame:
    levels = table.frame.filter((F.col("col") == column) & F.col("value").isNotNull())
    return levels.select(
        F.col("value").alias(key), *[F.col(source).alias(name) for name, source in facts.items()]
    )


def _broadcast_join(df, table, column, facts):
    key = f"__{column}_key"
    side = F.broadcast(_side(table, column, facts, key))
    return df.join(side, F.col(column) == F.col(key), "left").drop(key)


def hot_levels(df: DataFrame, columns: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """``col, value`` of every level with at least ``share`` of the rows; a few more may be among them.

    One pass with a sketch of fixed size for each column; at most ``1 / share`` levels of a column
    reach the driver.
    """
    most = round(1 / share)
    tops = [
        F.expr(f"approx_top_k(_{i}, {most}, {max(SKETCH_ITEMS, 4 * most)})").alias(f"_{i}")
        for i in range(len(columns))
    ]
    cells = df.select(*[F.col(c).cast("bigint").alias(f"_{i}") for i, c in enumerate(columns)])
    found = cells.agg(F.count(F.lit(1)).alias("rows"), *tops).first()
    # Counts are upper bounds.
    rows = [
        (c, top["item"])
        for i, c in enumerate(columns)
        for top in found[f"_{i}"]
        if top["item"] is not None and top["count"] >= found["rows"] * share
    ]
    return small_table(df.sparkSession, ["col", "value"], [pa.string(), pa.int64()], rows)


def _shared_lookup(df: DataFrame, table: LevelTable, wanted: Mapping[str, Mapping[str, str]]):
    names, columns = df.columns, list(wanted)
    sources = sorted({s for facts in wanted.values() for s in facts.values()})
    levels = table.frame.filter(F.col("col").isin(columns) & F.col("value").isNotNull())
    levels = levels.select("col", "value", *[F.col(s).alias(f"__{s}") for s in sources])

    # As a table holds a level once, the facts of the hot levels are as few as those.
    hot = hot_levels(df, columns)
    known = F.broadcast(levels.join(F.broadcast(hot), ["col", "value"]))
    settled = store(hot.join(known, ["col", "value"], "left").coalesce(1), "hot-levels")
    rows = df
    for c in columns:
        own = settled.filter(F.col("col") == c).select(
            F.col("value").alias("__value"),
            F.struct(*[F.col(f"__{s}") for s in sources]).alias(f"__{c}_hot"),
        )
        rows = rows.join(
            F.broadcast(own), F.col(c).cast("bigint") == F.col("__value"), "left"
        ).drop("__value")

    cold = {c: F.when(F.col(f"__{c}_hot").isNull(), F.col(c).cast("bigint")) for c in columns}
    keys = [F.xxhash64(F.lit(seed), *cold.values()).alias(k) for seed, k in enumerate(_KEYS)]
    rows = rows.withColumn("__cold", F.coalesce(*cold.values()).isNotNull())
    open_rows = rows.filter("__cold").select("*", *keys)

    cells = cold_cells(open_rows, cold).join(levels, ["col", "value"])
    found = cells.groupBy(*_KEYS).agg(
        *[
            F.max(F.when(F.col("col") == c, F.col(f"__{s}"))).alias(f"__found_{i}_{s}")
            for i, c in enumerate(columns)
            for s in sorted(set(wanted[c].values()))
        ]
    )

    def fact(i: int, c: str, source: str, with_found: bool) -> Column:
        settled_fact = F.col(f"__{c}_hot")[f"__{source}"]
        return F.coalesce(F.col(f"__found_{i}_{source}"), settled_fact) if with_found else settled_fact

    def facts(with_found: bool) -> list[Column]:
        return [
            fact(i, c, source, with_found).alias(name)
            for i, c in enumerate(columns)
            for name, source in wanted[c].items()
        ]

    looked_up = open_rows.join(found, list(_KEYS), "left").select(*names, *facts(True))
    return looked_up.unionByName(rows.filter("NOT __cold").select(*names, *facts(False)))


def cold_cells(open_rows: DataFrame, cold: Mapping[str, Column]) -> DataFrame:
    """``row key, col, value`` of every unsettled cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("col"), v.alias("value")) for c, v in cold.items()])
    each = open_rows.select(*_KEYS, F.inline(cells))
    return each.filter(F.col("value").isNotNull())
