"""Level tables: one row per (categorical column, level), and everything derived from them.

One unpivot and one partially aggregated shuffle count all columns in a single scan. The table stays
distributed; only one row per column or bucket ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from clickfeat.operators.ordering import bucket_totals, number_rows, store_in_order
from clickfeat.roles import Roles
from clickfeat.workspace import store


def level_counts(
    df: DataFrame,
    roles: Roles,
    keep_missing: bool = True,
    by_label: bool = False,
    include_id: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows per (column, level): ``pos, col, value, n`` (missing is the NULL level).

    ``by_label`` adds ``n0`` and ``n1`` (rows of label 0 and 1) and ``label_sum``; a missing
    label counts as 0.
    """
    names = list(columns or (((roles.id,) if include_id else ()) + roles.categorical))
    broken = [c for c in names if isinstance(df.schema[c].dataType, (FloatType, DoubleType))]
    if broken:
        raise TypeError(f"levels are whole numbers, but these columns are fractional: {broken}")
    label = [F.coalesce(F.col(roles.label).cast("bigint"), F.lit(0)).alias("_label")]
    cells = df.select(
        *(label if by_label else []), *[F.col(c).cast("bigint").alias(c) for c in names]
    ).unpivot(["_label"] if by_label else [], names, "col", "value")
    if not keep_missing:
        cells = cells.filter(F.col("value").isNotNull())
    counts = [F.count(F.lit(1)).alias("n")]
    if by_label:
        counts += [
            F.count_if(F.col("_label") == 0).alias("n0"),
            F.count_if(F.col("_label") == 1).alias("n1"),
            F.sum("_label").alias("label_sum"),
        ]
    grouped = cells.groupBy("col", "value").agg(*counts)
    rest = [c for c in grouped.columns if c not in ("col", "value")]
    return grouped.select(position(roles).alias("pos"), "col", "value", *rest)


def position(roles: Roles) -> Column:
    """The table position of the column named in ``col``."""
    names = F.array(*[F.lit(c) for c in roles.columns])
    return (F.array_position(names, F.col("col")) - 1).cast("int")


def level_sets(df: DataFrame, roles: Roles) -> DataFrame:
    """The distinct non-missing levels of every categorical column."""
    return level_counts(df, roles, keep_missing=False).select(*("pos", "col", "value"))


def level_summary(counts: DataFrame) -> DataFrame:
    """Mode, its count and the number of levels per column, from :func:`level_counts`.

    Counts that keep missing levels give a row (0 levels, no mode) for an all-missing column too.
    Among equally frequent levels the smallest is the mode.
    """
    # First per distinct count, then per column: only fixed-width buffers, so both aggregates hash.
    present = F.col("value").isNotNull()
    per_count = counts.groupBy("pos", "col", F.when(present, F.col("n")).alias("n")).agg(
        F.min("value").alias("smallest"), F.count("value").alias("levels")
    )
    return per_count.groupBy("pos", "col").agg(
        F.max_by("smallest", "n").alias("mode"),
        F.max("n").alias("mode_n"),
        F.sum("levels").alias("levels"),
    )


def class_totals(counts: DataFrame) -> DataFrame:
    """Label-0 and label-1 rows per column."""
    return counts.groupBy("pos", "col").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def pool_rare(counts: DataFrame, at_least: int) -> DataFrame:
    """Levels with fewer rows than ``at_least`` join the missing level, class by class."""
    kept = F.when(F.col("n0") + F.col("n1") >= at_least, F.col("value"))
    return (
        counts.select("pos", "col", kept.alias("value"), "n", "n0", "n1", "label_sum")
        .groupBy("pos", "col", "value")
        .agg(*[F.sum(c).alias(c) for c in ("n", "n0", "n1", "label_sum")])
    )


def target_rates(counts: DataFrame) -> DataFrame:
    """Rows, label sum and label mean of every non-missing level."""
    return counts.filter(F.col("value").isNotNull()).select(
        "pos", "col", "value", "n", "label_sum", (F.col("label_sum") / F.col("n")).alias("rate")
    )


@dataclass
class LevelTable:
    """A stored level table, and how many levels of each column it holds.

    Sizes are counted once, when first needed: one row per bucket and column reaches the driver.
    """

    frame: DataFrame
    origin: LevelTable | None = None
    """The table this one was filtered from."""

    @classmethod
    def keep(
        cls, counts: DataFrame, buckets: int | None = None, path: str | None = None
    ) -> LevelTable:
        """Store a level frame in (column position, value) order, one folder per column."""
        return cls(store_in_order(counts, ("pos", "value"), "levels", buckets, path, by="col"))

    @classmethod
    def load(cls, spark: SparkSession, path: str, schema: StructType) -> LevelTable:
        """A kept table. The schema is needed since a table without levels has no files."""
        return cls(spark.read.schema(schema).parquet(path))

    @cached_property
    def sizes(self) -> list[Row]:
        measures = {"levels": F.col("value").isNotNull().cast("bigint"), "n": F.col("n")}
        return bucket_totals(self.frame, measures, within=["pos", "col"])

    @cached_property
    def rows(self) -> dict[str, int]:
        """Non-missing levels per column."""
        return self._per_column("levels")

    @cached_property
    def total(self) -> int:
        """Rows of the counted table."""
        if self.origin is not None:
            return self.origin.total
        return max(self._per_column("n").values(), default=0)

    def _per_column(self, measure: str) -> dict[str, int]:
        sums: dict[str, int] = {}
        for size in self.sizes:
            sums[size["col"]] = sums.get(size["col"], 0) + size[measure]
        return sums

    def where(self, condition: Column) -> LevelTable:
        """Only the levels that meet a condition."""
        return LevelTable(self.frame.filter(condition), origin=self)

    def with_columns(self, columns: dict[str, Column]) -> LevelTable:
        """The same levels with further facts."""
        return self._same_levels(self.frame.withColumns(columns))

    def _same_levels(self, frame: DataFrame) -> LevelTable:
        table = LevelTable(frame, origin=self)
        table.sizes = self.sizes
        return table

    def modes(self) -> dict[str, int | None]:
        """The mode of every column: one row per column."""
        return {r["col"]: r["mode"] for r in level_summary(self.frame).collect()}

    def numbered(self, name: str = "idx", per_column: bool = False) -> LevelTable:
        """Number the non-missing levels from 0 by (position, value), over all columns or each.

        The numbers depend on the data alone, never on how it is partitioned. The result is stored
        too, so that a lookup reads its column's folder and nothing else.
        """
        present = self.where(F.col("value").isNotNull())
        numbered = number_rows(
            present.frame,
            ["value"],
            name,
            within=["pos", "col"],
            restart=per_column,
            totals=[Row(**{**size.asDict(), name: size["levels"]}) for size in self.sizes],
        )
        ordered = numbered.sortWithinPartitions("col", "value")
        return self._same_levels(store(ordered, "numbered", by="col"))


__all__ = [
    "LevelTable",
    "class_totals",
    "level_counts",
    "level_sets",
    "level_summary",
    "pool_rare",
    "target_rates",
]
