"""Naive Bayes over categorical levels, with rare levels pooled."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.numeric import sigmoid
from clickfeat.operators.levels import LevelTable, level_counts, pool_rare
from clickfeat.operators.lookup import BROADCAST_LEVELS, attach
from clickfeat.roles import Roles

# Fixed value: levels with fewer rows are pooled.
POOL_BELOW = 1000


@dataclass
class NaiveBayes:
    roles: Roles
    levels: LevelTable
    """Class counts of the kept levels; the NULL level of a column is its pool."""
    pools: dict[str, tuple[int, int]]
    """Label-0 and label-1 rows of each column's pool."""
    totals: tuple[int, int]
    """Label-0 and label-1 rows of the table."""

    @classmethod
    def fit(cls, df: DataFrame, roles: Roles, pool_below: int = POOL_BELOW) -> NaiveBayes:
        counts = level_counts(df, roles, by_label=True)
        return cls.from_levels(roles, LevelTable.keep(pool_rare(counts, pool_below)))

    @classmethod
    def from_levels(cls, roles: Roles, levels: LevelTable) -> NaiveBayes:
        sums = [F.sum(c).alias(f"all_{c}") for c in ("n0", "n1")]
        pool = [F.sum(F.when(F.col("value").isNull(), F.col(c))).alias(c) for c in ("n0", "n1")]
        columns = levels.frame.groupBy("col").agg(*sums, *pool).collect()  # one row per column
        pools = {r["col"]: (r["n0"] or 0, r["n1"] or 0) for r in columns}
        totals = (columns[0]["all_n0"], columns[0]["all_n1"]) if columns else (0, 0)
        return cls(roles, levels, pools, totals)

    def _log_odds(self, n0: Column, n1: Column) -> Column:
        """What a level with these class counts adds to the log-odds; a zero count counts as 1."""
        all0, all1 = (F.lit(float(max(t, 1))) for t in self.totals)
        return F.ln(F.greatest(n1, F.lit(1)) / all1) - F.ln(F.greatest(n0, F.lit(1)) / all0)

    def score(
        self, df: DataFrame, name: str = "p", broadcast_levels: int = BROADCAST_LEVELS
    ) -> DataFrame:
        """Add the probability of label 1.

        Log-odds are taken per level, once, and summed per row, so many columns cannot underflow. A
        level the model does not hold uses the column's pool.
        """
        columns = self.roles.categorical
        log_odds = {"log_odds": self._log_odds(F.col("n0"), F.col("n1"))}
        wanted = {c: {f"__{c}_odds": "log_odds"} for c in columns}
        found = attach(df, self.levels.with_columns(log_odds), wanted, broadcast_levels)
        all0, all1 = (F.lit(float(max(t, 1))) for t in self.totals)
        margin = F.ln(all1) - F.ln(all0)
        for c in columns:
            pool = self._log_odds(*[F.lit(n) for n in self.pools.get(c, (0, 0))])
            margin = margin + F.coalesce(F.col(f"__{c}_odds"), pool)
        return found.select(*df.columns, sigmoid(margin).alias(name))


def scores_above(scored: DataFrame, threshold: float = 0.01, name: str = "p") -> DataFrame:
    return scored.filter(F.col(name) > threshold)
