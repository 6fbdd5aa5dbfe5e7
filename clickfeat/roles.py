"""Which column plays which part: id, label, numeric features, categorical features."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KindGuesser = Callable[[int, str], str]

NUMERIC = "numeric"
CATEGORICAL = "categorical"


def guess_kind(index: int, name: str) -> str:
    """The default typing rule: the first column and names starting with ``C`` are categorical."""
    return CATEGORICAL if index == 0 or name.startswith("C") else NUMERIC


@dataclass(frozen=True)
class Roles:
    """Column roles by name. Table order is id, label, numeric, categorical."""

    id: str
    label: str
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()

    @classmethod
    def from_header(
        cls,
        header: Sequence[str],
        guess: KindGuesser = guess_kind,
        id: str | None = None,
        label: str | None = None,
    ) -> Roles:
        """Roles from a header line; id and label default to the first two columns."""
        id = header[0] if id is None else id
        label = header[1] if label is None else label
        kinds = {name: guess(i, name) for i, name in enumerate(header)}
        rest = [name for name in header if name not in (id, label)]
        return cls(
            id=id,
            label=label,
            numeric=tuple(n for n in rest if kinds[n] == NUMERIC),
            categorical=tuple(n for n in rest if kinds[n] == CATEGORICAL),
        )

    @classmethod
    def from_dict(cls, named: dict) -> Roles:
        """Roles from their saved form."""
        return cls(named["id"], named["label"], tuple(named["numeric"]), tuple(named["categorical"]))

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.id, self.label) + self.features

    def position(self, name: str) -> int:
        return self.columns.index(name)

    def kind(self, name: str) -> str:
        return CATEGORICAL if name == self.id or name in self.categorical else NUMERIC

    def keep(self, names) -> Roles:
        """The same roles with only the named features."""
        names = set(names)
        return replace(
            self,
            numeric=tuple(c for c in self.numeric if c in names),
            categorical=tuple(c for c in self.categorical if c in names),
        )


def resolve(df: DataFrame, ref: int | str) -> str:
    """A column reference, by position or by name, as a name. Unknown references raise."""
    if isinstance(ref, int):
        if not 0 <= ref < len(df.columns):
            raise KeyError(f"no column at position {ref}; the table has {len(df.columns)}")
        return df.columns[ref]
    if ref not in df.columns:
        raise KeyError(f"no column named {ref!r} in {df.columns}")
    return ref


def adopt(df: DataFrame, roles: Roles) -> DataFrame:
    """Bring any table into the data model: numeric double, categorical long, missing is NULL."""

    def number(name):
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value).alias(name)

    return df.select(
        F.col(roles.id).cast("bigint").alias(roles.id),
        number(roles.label),
        *[number(c) for c in roles.numeric],
        *[F.col(c).cast("bigint").alias(c) for c in roles.categorical],
    )
