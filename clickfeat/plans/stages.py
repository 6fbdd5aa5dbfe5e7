"""Fit once, save, apply anywhere: an ordered list of feature stages.

Fitting stage by stage would scan the running table once per stage. Two facts save those scans.
A monotone numeric stage maps the column bounds to the next bounds, so later scalers are fitted on
a three-row table of corner values. A stage that only drops levels maps one level table to the
next, so the index is fitted on the filtered counts. The default stages cost one numeric aggregate
and one level table, whatever their number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import ClassVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickfeat.operators import encoding, imputing, scaling
from clickfeat.operators.levels import LevelTable, level_counts, target_rates
from clickfeat.operators.summary import bounds_of, means_of
from clickfeat.roles import Roles
from clickfeat.plans.state import TableState
from clickfeat.workspace import commit, committed, small_table


class Known:
    """What is known about the running table while stages are fitted."""

    def __init__(self, df: DataFrame, roles: Roles):
        self._df: DataFrame | None = df
        self.roles = roles
        self._corners: DataFrame | None = None
        self._counts: LevelTable | None = None
        self._state: TableState | None = None

    @classmethod
    def of_state(cls, state: TableState) -> Known:
        """What the state of a table tells; stages that need its rows can't be fitted."""
        known = cls(None, state.roles)
        known._state, known._counts = state, state.counts
        known._set_corners(state.levels.sparkSession, state.bounds())
        return known

    @property
    def df(self) -> DataFrame:
        if self._df is None:
            raise ValueError("the state of a table doesn't tell what this stage needs after the stages before")
        return self._df

    def bounds(self) -> dict[str, tuple]:
        """Bounds of the label and the numeric features."""
        names = (self.roles.label, *self.roles.numeric)
        bounds = bounds_of(self.df if self._corners is None else self._corners, names)
        if self._corners is None:
            self._set_corners(self.df.sparkSession, bounds)
        return bounds

    def _set_corners(self, spark: SparkSession, bounds: dict[str, tuple]) -> None:
        names = (self.roles.label, *self.roles.numeric)
        lows, highs, gaps = ([bounds[c][k] for c in names] for k in range(3))
        gapped = [None if gap else low for low, gap in zip(lows, gaps)]
        self._corners = small_table(spark, names, [pa.float64()] * len(names), [lows, highs, gapped])

    def means(self) -> dict[str, float | None]:
        """Means of the label and the numeric features."""
        if self._state is not None:
            return self._state.means()
        return means_of(self.df, (self.roles.label, *self.roles.numeric))

    def label_mean(self) -> float | None:
        """Over all rows; a missing label counts as 0."""
        if self._state is not None:
            return self._state.label_mean()
        label = F.coalesce(F.col(self.roles.label).cast("double"), F.lit(0.0))
        return self.df.agg(F.avg(label).alias("mean")).first()["mean"]

    def label_counts(self) -> DataFrame:
        """Counts of the present levels with label sums."""
        if self._counts is not None and "label_sum" in self._counts.frame.columns:
            return self._counts.frame.filter(F.col("value").isNotNull())
        return level_counts(self.df, self.roles, keep_missing=False, by_label=True)

    def counts(self) -> LevelTable:
        """Level counts of the categorical features, missing included."""
        if not self.roles.categorical:
            raise ValueError("no categorical features: target encoding has made them numbers")
        if self._counts is None:
            self._counts = LevelTable.keep(level_counts(self.df, self.roles))
        return self._counts

    def advance(self, fitted: Fitted) -> None:
        if self._df is not None:
            self._df = fitted.transform(self._df)
        if self._state is not None and isinstance(fitted, FittedFill) and fitted.value:
            if self._state.bounds()[self.roles.label][2]:
                # Missing labels are counted as 0, but are no longer missing.
                self._counts = LevelTable(self._counts.frame.drop("n0", "n1", "label_sum"))
        if fitted.numeric:
            self._state = None  # its means are those of the table before
        if isinstance(fitted, FittedRates):
            # Label means are numbers: later stages take these columns as numeric features.
            numeric = (*self.roles.numeric, *self.roles.categorical)
            self.roles = Roles(self.roles.id, self.roles.label, numeric, ())
            self._corners = None
        if fitted.numeric and self._corners is not None:
            self._corners = fitted.transform(self._corners) if fitted.monotone else None
        if fitted.categorical:
            self._counts = fitted.kept_levels()


@dataclass
class Fitted:
    """A fitted stage: a transform and its saved form."""

    numeric: ClassVar[bool] = False
    categorical: ClassVar[bool] = False
    monotone: ClassVar[bool] = False

    roles: Roles

    def transform(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def kept_levels(self) -> LevelTable | None:
        """Level counts of the transformed table, where the stage implies them."""
        return None

    def state(self) -> dict:
        return {}

    @property
    def levels(self) -> LevelTable | None:
        return getattr(self, "table", None)


@dataclass
class FittedFill(Fitted):
    numeric, monotone = True, True
    value: float = 0.0

    def transform(self, df):
        # New data needs no label.
        label = [c for c in (self.roles.label,) if c in df.columns]
        return scaling.fill_constant(df, (*label, *self.roles.numeric), self.value)

    def state(self):
        return {"value": self.value}


@dataclass
class FittedScale(Fitted):
    numeric, monotone = True, True
    forms: ClassVar[dict] = {
        "minmax": scaling.scale_minmax,
        "log": scaling.scale_log,
        "log_minmax": scaling.scale_log_minmax,
    }
    form: str = "minmax"
    bounds: dict[str, tuple] = field(default_factory=dict)

    def transform(self, df):
        return self.forms[self.form](df, self.bounds)

    def state(self):
        return {"form": self.form, "bounds": self.bounds}


@dataclass
class FittedImpute(Fitted):
    numeric, categorical = True, True
    values: dict[str, float | int | None] = field(default_factory=dict)

    def transform(self, df):
        return imputing.fill_values(df, self.values)

    def state(self):
        return {"values": self.values}


@dataclass
class FittedFrequent(Fitted):
    categorical = True
    table: LevelTable | None = None

    def transform(self, df):
        return encoding.drop_rare_levels(df, self.roles, self.table)

    def kept_levels(self):
        return self.table


@dataclass
class FittedIndex(Fitted):
    categorical = True
    table: LevelTable | None = None

    @property
    def size(self) -> int:
        """Number of indexed levels."""
        return sum(self.table.rows.values())

    def transform(self, df):
        return encoding.index_levels(df, self.roles, self.table)


@dataclass
class FittedRates(Fitted):
    categorical = True
    table: LevelTable | None = None
    unseen: str = "raw"
    prior: float | None = None

    def transform(self, df):
        return encoding.target_encode(df, self.roles, self.table, self.unseen, self.prior)

    def state(self):
        return {"unseen": self.unseen, "prior": self.prior}


@dataclass(frozen=True)
class FillMissing:
    """Missing numeric cells, label included, become a constant."""

    value: float = 0.0

    def fit(self, known: Known) -> Fitted:
        return FittedFill(known.roles, self.value)


@dataclass(frozen=True)
class Scale:
    """Numeric features by ``minmax``, ``log`` or ``log_minmax``."""

    form: str = "minmax"

    def fit(self, known: Known) -> Fitted:
        bounds = known.bounds()
        return FittedScale(known.roles, self.form, {c: bounds[c][:2] for c in known.roles.numeric})


@dataclass(frozen=True)
class Impute:
    """Numeric columns by mean, categorical features by mode."""

    def fit(self, known: Known) -> Fitted:
        values: dict = known.means()
        values.update(dict.fromkeys(known.roles.categorical))
        if known.roles.categorical:
            values.update(known.counts().modes())
        return FittedImpute(known.roles, values)


@dataclass(frozen=True)
class DropRareLevels:
    """Levels with at most ``more_than`` rows, and unseen ones, become missing."""

    more_than: int = 15

    def fit(self, known: Known) -> Fitted:
        return FittedFrequent(known.roles, encoding.frequent_levels(known.counts(), self.more_than))


@dataclass(frozen=True)
class IndexLevels:
    """Levels become numbers from 0, over all columns or per column; missing and unseen -1."""

    per_column: bool = False

    def fit(self, known: Known) -> Fitted:
        return FittedIndex(known.roles, known.counts().numbered(per_column=self.per_column))


@dataclass(frozen=True)
class EncodeTarget:
    """Levels become label means. Categorical columns are doubles afterwards."""

    unseen: str = "raw"

    def fit(self, known: Known) -> Fitted:
        prior = known.label_mean() if self.unseen == "prior" else None
        table = LevelTable.keep(target_rates(known.label_counts()))
        return FittedRates(known.roles, table, self.unseen, prior)


_FITTED = {
    c.__name__: c
    for c in (FittedFill, FittedScale, FittedImpute, FittedFrequent, FittedIndex, FittedRates)
}


@dataclass
class FittedStages:
    roles: Roles
    stages: list[Fitted]

    def transform(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.roles.features if c not in df.columns]
        if missing:
            raise ValueError(f"features that the stages were fitted on are missing: {missing}")
        for stage, after in zip(self.stages, [*self.stages[1:], None]):
            # The index holds the frequent levels only, so it drops the others by itself.
            if isinstance(stage, FittedFrequent) and isinstance(after, FittedIndex):
                continue
            df = stage.transform(df)
        return df

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the fitted state as parquet: one row per stage, one level table where it has one.

        Everything goes to a new folder under ``path``, which a mark names once all is written. So a save that was
        cut off is refused on load and can be repeated.
        """
        run = f"saved-{uuid.uuid4().hex}"
        rows, top, path = [], path, f"{path}/{run}"
        for i, stage in enumerate(self.stages):
            schema = None
            if stage.levels is not None:
                kept = LevelTable.keep(stage.levels.frame, path=f"{path}/levels-{i}")
                schema = kept.frame.schema.json()
            state, roles = json.dumps(stage.state()), json.dumps(vars(self.roles))
            rows.append((i, type(stage).__name__, state, schema, roles))
        types = "position int, kind string, state string, level_schema string, roles string"
        spark.createDataFrame(rows, types).coalesce(1).write.parquet(f"{path}/stages")
        commit(spark, top, {"folder": run})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedStages:
        stages, path = [], f"{path}/{committed(spark, path)['folder']}"
        for row in spark.read.parquet(f"{path}/stages").orderBy("position").collect():
            roles = Roles.from_dict(json.loads(row["roles"]))
            state = json.loads(row["state"])
            if row["level_schema"] is not None:
                schema = StructType.fromJson(json.loads(row["level_schema"]))
                state["table"] = LevelTable.load(spark, f"{path}/levels-{row['position']}", schema)
            stages.append(_FITTED[row["kind"]](roles, **state))
        return cls(stages[0].roles, stages)


@dataclass(frozen=True)
class Stages:
    """An ordered list of stages."""

    stages: Sequence

    def fit(self, df: DataFrame, roles: Roles) -> FittedStages:
        return self._fit(Known(df, roles))

    def fit_state(self, state: TableState) -> FittedStages:
        """Fit on the state of a table, or of several merged, as on the rows themselves."""
        return self._fit(Known.of_state(state))

    def _fit(self, known: Known) -> FittedStages:
        roles, fitted = known.roles, []
        for stage in self.stages:
            fitted.append(stage.fit(known))
            known.advance(fitted[-1])
        return FittedStages(roles, fitted)

    def fit_transform(self, df: DataFrame, roles: Roles) -> DataFrame:
        return self.fit(df, roles).transform(df)


def default_stages(more_than: int = 15) -> Stages:
    """Fill with 0, log, min-max, drop rare levels, index globally."""
    return Stages(
        [FillMissing(0.0), Scale("log"), Scale("minmax"), DropRareLevels(more_than), IndexLevels()]
    )
