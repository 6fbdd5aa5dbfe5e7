"""clickfeat: click-data feature preparation and evaluation on Spark DataFrames."""

from clickfeat.models.bayes import NaiveBayes
from clickfeat.operators.levels import LevelTable
from clickfeat.plans.stages import (
    DropRareLevels,
    EncodeTarget,
    FillMissing,
    FittedStages,
    Impute,
    IndexLevels,
    Scale,
    Stages,
    default_stages,
)
from clickfeat.roles import Roles, adopt, guess_kind, resolve
from clickfeat.workspace import release

__all__ = [
    "DropRareLevels",
    "EncodeTarget",
    "FillMissing",
    "FittedStages",
    "Impute",
    "IndexLevels",
    "LevelTable",
    "NaiveBayes",
    "Roles",
    "Scale",
    "Stages",
    "adopt",
    "default_stages",
    "guess_kind",
    "release",
    "resolve",
]
