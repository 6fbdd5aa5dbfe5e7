import pytest
from pyspark.sql import functions as F

from clickfeat import (
    DropRareLevels,
    EncodeTarget,
    FillMissing,
    FittedStages,
    Impute,
    IndexLevels,
    LevelTable,
    Scale,
    Stages,
    default_stages,
)
from clickfeat.operators import encoding, scaling, summary
from clickfeat.operators.levels import level_counts
from clickfeat.workspace import new_path
from tests.conftest import rows_of


def stage_by_stage(df, roles, more_than):
    """The default stages, each fitted on the table the one before made."""
    df = scaling.fill_constant(df, (roles.label, *roles.numeric), 0.0)
    df = scaling.scale_log(df, summary.bounds_of(df, roles.numeric))
    df = scaling.scale_minmax(df, summary.bounds_of(df, roles.numeric))
    counts = LevelTable.keep(level_counts(df, roles))
    df = encoding.drop_rare_levels(df, roles, encoding.frequent_levels(counts, more_than))
    numbered = LevelTable.keep(level_counts(df, roles)).numbered()
    return encoding.index_levels(df, roles, numbered)


@pytest.mark.parametrize("more_than", [0, 1])
def test_shared_scans_change_nothing(clicks, more_than):
    df, roles = clicks
    fitted = default_stages(more_than).fit(df, roles)
    assert rows_of(fitted.transform(df)) == rows_of(stage_by_stage(df, roles, more_than))
    assert fitted.stages[-1].size == (5 if more_than == 0 else 3)


def test_fit_transform_and_save(spark, clicks):
    df, roles = clicks
    stages = Stages([Impute(), Scale("log_minmax"), DropRareLevels(1), IndexLevels(per_column=True)])
    fitted = stages.fit(df, roles)
    path = new_path(spark, "test-stages")
    fitted.save(spark, path)
    loaded = FittedStages.load(spark, path)
    expected = rows_of(stages.fit_transform(df, roles))
    assert loaded.roles == roles
    assert rows_of(fitted.transform(df)) == expected
    assert rows_of(loaded.transform(df)) == expected
    assert rows_of(loaded.transform(df.repartition(5))) == expected


def test_applied_to_new_rows(clicks):
    df, roles = clicks
    fitted = Stages([FillMissing(0), Scale("minmax"), IndexLevels()]).fit(df, roles)
    new = df.limit(1).withColumns({"c1": F.lit(1000).cast("bigint"), "n1": F.lit(8.0)})
    row = fitted.transform(new).first()
    assert row["c1"] == -1 and row["n1"] == 2.0


def test_encode_target_with_prior(spark, clicks):
    df, roles = clicks
    fitted = Stages([EncodeTarget("prior")]).fit(df, roles)
    path = new_path(spark, "test-rates")
    fitted.save(spark, path)
    new = df.limit(1).withColumn("c1", F.lit(1000).cast("bigint"))
    assert FittedStages.load(spark, path).transform(new).first()["c1"] == pytest.approx(0.4)


def test_imputed_levels_are_counted_again(clicks):
    df, roles = clicks
    fitted = Stages([Impute(), DropRareLevels(2), IndexLevels()]).fit(df, roles)
    # Filling puts c1 = 3 and c2 = 10 above two rows each.
    assert rows_of(fitted.transform(df), "c1", "c2") == [
        (-1, -1), (-1, 1), (0, -1), (0, 1), (0, 1),
    ]


def test_state_without_any_level(spark, clicks):
    df, roles = clicks
    bare = df.withColumns({c: F.lit(None).cast("bigint") for c in roles.categorical})
    fitted = Stages([EncodeTarget(), FillMissing(1)]).fit(bare, roles)
    path = new_path(spark, "test-bare")
    fitted.save(spark, path)
    loaded = FittedStages.load(spark, path).transform(df)
    assert rows_of(loaded, "id", "c1") == [(1, 7.0), (2, 7.0), (3, 3.0), (3, 3.0), (5, None)]


def test_rates_are_numbers_for_later_stages(clicks):
    from clickfeat.plans.stages import EncodeTarget, IndexLevels, Scale, Stages

    df, roles = clicks
    scaled = Stages([EncodeTarget(), Scale("minmax")]).fit_transform(df, roles)
    rates = sorted({r["c2"] for r in scaled.collect() if r["c2"] is not None})
    assert rates[0] == 0.0 and rates[-1] == 1.0
    with pytest.raises(ValueError, match="no categorical"):
        Stages([EncodeTarget(), IndexLevels()]).fit(df, roles)


def test_fitted_stages_apply_without_a_label(clicks):
    from clickfeat.plans.stages import default_stages

    df, roles = clicks
    fitted = default_stages(more_than=0).fit(df, roles)
    whole = rows_of(fitted.transform(df).drop("label"))
    assert rows_of(fitted.transform(df.drop("label"))) == whole
    with pytest.raises(ValueError, match="n1"):
        fitted.transform(df.drop("n1"))
