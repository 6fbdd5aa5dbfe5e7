"""Statistics of a table that add up: fit on parts, merge, and the parts' rows are not needed again.

The state of a table is its level counts by label class (one row for each column and level, missing included)
and a few numbers for each numeric column. Both are sums, minima and maxima, so the states of two tables
merge into the state of their union by one aggregate over level tables. Label means, class counts, modes,
dictionaries, bounds and column means all follow from it, and so do the stages that need no more than those.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.models.bayes import NaiveBayes
from clickfeat.operators.levels import LevelTable, level_counts, pool_rare, target_rates
from clickfeat.roles import Roles
from clickfeat.workspace import commit, committed, store

_LEVELS = "pos int, col string, value bigint, n bigint, n0 bigint, n1 bigint, label_sum bigint"
_NUMBERS = "col string, rows bigint, n bigint, total double, low double, high double"


@dataclass
class TableState:
    """Level counts and numeric sums of a table or of several."""

    roles: Roles
    levels: DataFrame
    numbers: DataFrame
    """``col, rows, n, total, low, high`` of the label and each numeric column."""

    @classmethod
    def of(cls, df: DataFrame, roles: Roles) -> TableState:
        """Count a table: one aggregate for the numeric columns and one level table."""
        cells = [
            F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v"))
            for c in (roles.label, *roles.numeric)
        ]
        numbers = (
            df.select(F.inline(F.array(*cells)))
            .groupBy("col")
            .agg(
                F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"), F.sum("v").alias("total"),
                F.min("v").alias("low"), F.max("v").alias("high"),
            )
        )
        levels = df.sparkSession.createDataFrame([], _LEVELS)
        if roles.categorical:
            levels = level_counts(df, roles, by_label=True)
        return cls(roles, store(levels, "state-levels"), store(numbers, "state-numbers"))

    def merge(self, *others: TableState) -> TableState:
        """The state of all rows of these states. No row that was counted is read again."""
        if any(o.roles != self.roles for o in others):
            raise ValueError("states of different columns don't merge")
        together = lambda frames: reduce(DataFrame.unionByName, frames)
        every = (self, *others)
        levels = together([s.levels for s in every]).groupBy("pos", "col", "value").agg(
            *[F.sum(c).alias(c) for c in ("n", "n0", "n1", "label_sum")]
        )
        numbers = together([s.numbers for s in every]).groupBy("col").agg(
            F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("total").alias("total"),
            F.min("low").alias("low"), F.max("high").alias("high"),
        )
        return TableState(self.roles, store(levels, "state-levels"), store(numbers, "state-numbers"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write both tables to new folders under ``path``, then the mark that names them."""
        run = uuid.uuid4().hex
        self.levels.write.parquet(f"{path}/levels-{run}")
        self.numbers.coalesce(1).write.parquet(f"{path}/numbers-{run}")
        commit(spark, path, {"run": run, "roles": vars(self.roles)})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TableState:
        """A saved state. One whose save was cut off is refused."""
        mark = committed(spark, path)
        read = lambda schema, name: spark.read.schema(schema).parquet(f"{path}/{name}-{mark['run']}")
        return cls(Roles.from_dict(mark["roles"]), read(_LEVELS, "levels"), read(_NUMBERS, "numbers"))

    @cached_property
    def _numbers(self) -> dict[str, dict]:
        """One row for each numeric column."""
        found = {r["col"]: r.asDict() for r in self.numbers.collect()}
        empty = {"rows": 0, "n": 0, "total": None, "low": None, "high": None}
        return {c: found.get(c, empty) for c in (self.roles.label, *self.roles.numeric)}

    @cached_property
    def counts(self) -> LevelTable:
        """Rows per level, missing included, with class counts."""
        return LevelTable.keep(self.levels)

    @property
    def rates(self) -> LevelTable:
        """Label mean of every level."""
        return LevelTable.keep(target_rates(self.levels))

    def bounds(self) -> dict[str, tuple]:
        """``{column: (min, max, missing cells?)}``."""
        return {c: (r["low"], r["high"], r["n"] < r["rows"]) for c, r in self._numbers.items()}

    def means(self) -> dict[str, float | None]:
        return {c: r["total"] / r["n"] if r["n"] else None for c, r in self._numbers.items()}

    def label_mean(self) -> float | None:
        """Over all rows; a missing label counts as 0."""
        label = self._numbers[self.roles.label]
        return (label["total"] or 0.0) / label["rows"] if label["rows"] else None

    def bayes(self, pool_below: int) -> NaiveBayes:
        return NaiveBayes.from_levels(self.roles, LevelTable.keep(pool_rare(self.levels, pool_below)))

