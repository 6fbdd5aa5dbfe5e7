"""States that merge, and saves that were cut off."""

import pytest
from pyspark.sql import functions as F

from clickfeat import NaiveBayes, default_stages
from clickfeat.operators.levels import LevelTable, level_counts, target_rates
from clickfeat.operators.summary import bounds_of, means_of
from clickfeat.plans.stages import EncodeTarget, FillMissing, FittedStages, Impute, Scale, Stages
from clickfeat.plans.state import TableState
from clickfeat.workspace import commit, new_path
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def parts(clicks):
    """A table in four parts: one of them empty, one with a missing label and levels of its own."""
    df, roles = clicks
    odd = df.limit(1).select(
        F.lit(9).cast("bigint").alias("id"), F.lit(None).cast("double").alias("label"),
        F.lit(-3.5).alias("n1"), F.lit(5.0).alias("same"), F.lit(None).cast("double").alias("empty"),
        F.lit(77).cast("bigint").alias("c1"), F.lit(10).cast("bigint").alias("c2"),
        F.lit(None).cast("bigint").alias("none"),
    )
    return [df.filter("id < 3"), df.filter("id >= 3"), df.limit(0), odd], roles


@pytest.fixture(scope="module")
def merged(spark, parts):
    frames, roles = parts
    states = []
    for frame in frames:
        path = new_path(spark, "part")
        TableState.of(frame, roles).save(spark, path)
        states.append(TableState.load(spark, path))
    whole = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    return states[0].merge(*states[1:]), whole, roles


def test_merged_states_equal_the_state_of_the_whole(merged):
    state, whole, roles = merged
    at_once = TableState.of(whole, roles)
    assert rows_of(state.levels) == rows_of(at_once.levels)
    assert rows_of(state.numbers) == rows_of(at_once.numbers)
    assert rows_of(state.levels) == rows_of(level_counts(whole, roles, by_label=True))
    names = ("label", *roles.numeric)
    assert state.bounds() == bounds_of(whole, names) and state.means() == means_of(whole, names)
    assert state.label_mean() == pytest.approx(2 / 6)
    rates = target_rates(level_counts(whole, roles, keep_missing=False, by_label=True))
    assert rows_of(state.rates.frame.select("col", "value", "rate")) == rows_of(rates.select("col", "value", "rate"))
    assert state.counts.modes() == LevelTable.keep(level_counts(whole, roles)).modes()


@pytest.mark.parametrize(
    "stages",
    [
        default_stages(1),
        Stages([Impute()]),
        Stages([EncodeTarget("prior")]),
        Stages([FillMissing(0.0), Scale("minmax"), EncodeTarget("null")]),
    ],
)
def test_stages_fitted_on_merged_states(merged, stages):
    state, whole, roles = merged
    assert rows_of(stages.fit_state(state).transform(whole)) == rows_of(stages.fit_transform(whole, roles))


def test_stages_that_need_rows_say_so(merged):
    # The table has a missing label, which is another one once it is filled.
    for stages in ([Impute(), EncodeTarget()], [FillMissing(1.0), EncodeTarget()]):
        with pytest.raises(ValueError, match="state"):
            Stages(stages).fit_state(merged[0])


def test_bayes_from_merged_states(merged):
    state, whole, roles = merged
    by_row = NaiveBayes.fit(whole, roles, 2)
    from_state = state.bayes(2)
    assert (from_state.totals, from_state.pools) == (by_row.totals, by_row.pools)
    assert rows_of(from_state.score(whole), "id", "p") == rows_of(by_row.score(whole), "id", "p")


def test_merging_reads_no_old_rows(merged):
    plan = merged[0].levels._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Relation" in plan


def test_states_of_other_columns_do_not_merge(spark, merged, clicks):
    state, _, roles = merged
    other = TableState.of(clicks[0], roles.keep(["n1", "c1"]))
    with pytest.raises(ValueError, match="merge"):
        state.merge(other)


@pytest.mark.parametrize("kind", [TableState, FittedStages])
def test_a_save_that_was_cut_off_is_refused_and_can_be_repeated(spark, clicks, tmp_path, kind, monkeypatch):
    df, roles = clicks
    made = TableState.of(df, roles) if kind is TableState else default_stages(1).fit(df, roles)
    path = str(tmp_path / "saved")

    def crash(*_):
        raise RuntimeError("lost")

    module = f"clickfeat.plans.{'state' if kind is TableState else 'stages'}.commit"
    with monkeypatch.context() as patch:
        patch.setattr(module, crash)
        with pytest.raises(RuntimeError):
            made.save(spark, path)
    with pytest.raises(ValueError, match="saved to the end"):
        kind.load(spark, path)
    made.save(spark, path)
    first = kind.load(spark, path)
    if kind is TableState:
        assert rows_of(first.levels) == rows_of(made.levels)
    else:
        assert rows_of(first.transform(df)) == rows_of(made.transform(df))
    # A mark that was cut off itself is refused too.
    commit(spark, path, {"folder": "x"})
    mark = tmp_path / "saved" / "committed.json"
    mark.write_text(mark.read_text()[:-8])
    for crc in mark.parent.glob(".committed*"):
        crc.unlink()
    with pytest.raises(ValueError, match="saved to the end"):
        kind.load(spark, path)
