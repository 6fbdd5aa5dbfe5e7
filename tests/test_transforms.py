import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickfeat import LevelTable, Roles
from clickfeat.operators import assembling, imputing, projection, scaling, splitting, summary
from clickfeat.operators.levels import level_counts
from clickfeat.sinks.text import csv_line, sparse_line, vw_line, write_lines
from tests.conftest import rows_of


def test_projection(clicks):
    df, roles = clicks
    assert projection.project_by_index(df, {0, 3, 99}).columns == ["id", "same"]
    assert projection.project_by_name(df, ["c1", "id", "zzz"]).columns == ["id", "c1"]
    kinds = projection.project_by_kind(df, roles, lambda name, kind: kind == "numeric")
    assert kinds.columns == ["label", "n1", "same", "empty"]
    missing = {r["col"]: r["missing"] for r in projection.missing_counts(df, roles).collect()}
    assert missing == {
        "id": 0, "label": 0, "n1": 1, "same": 0, "empty": 5, "c1": 1, "c2": 1, "none": 5,
    }
    labelled = projection.map_numeric(df, roles, lambda v, _: v + 1, with_label=True)
    assert rows_of(labelled, "label") == [(1.0,), (1.0,), (1.0,), (2.0,), (2.0,)]


def test_constant_and_empty_columns_scale_to_missing(clicks):
    df, roles = clicks
    bounds = summary.bounds_of(df, roles.numeric)
    for scale in (scaling.scale_minmax, scaling.scale_log_minmax):
        scaled = scale(df, bounds)
        assert rows_of(scaled, "same", "empty") == [(None, None)] * 5
    assert rows_of(scaling.scale_minmax(df, bounds), "n1") == [
        (None,), (0.0,), (0.5,), (0.5,), (1.0,),
    ]


def test_log_is_missing_where_undefined(spark):
    df = spark.createDataFrame([(9.0,), (10.0,), (12.0,), (None,)], "x double")
    logs = scaling.scale_log(df, {"x": (10.0, 12.0)})
    assert rows_of(logs)[:3] == [(None,), (None,), (0.0,)]
    assert rows_of(logs)[3] == (pytest.approx(math.log(3.0)),)
    assert rows_of(scaling.scale_log_minmax(df, {"x": (10.0, 12.0)})) == [
        (None,), (None,), (0.0,), (1.0,),
    ]


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.floats(-1e6, 1e6), min_size=2, max_size=30))
def test_scaled_values_lie_between_0_and_1(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bounds = summary.bounds_of(df, ["x"])
    for scale in (scaling.scale_minmax, lambda d, b: scaling.scale_log_minmax(d, b)):
        row = scale(df, bounds).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        if row["lo"] is not None:
            assert row["lo"] == 0.0 and row["hi"] == pytest.approx(1.0)


def test_imputing_leaves_empty_columns(clicks):
    df, roles = clicks
    table = {r["col"]: r for r in imputing.mean_mode_table(df, roles).collect()}
    assert table["n1"]["mean"] == 2.0 and table["c1"]["mode"] == 3
    assert table["empty"]["mean"] is None and table["none"]["mode"] is None
    filled = imputing.fill_values(df, {"n1": 2.0, "c1": 3, "empty": None, "absent": 1.0})
    assert filled.filter("n1 IS NULL OR c1 IS NULL").count() == 0
    assert filled.filter("empty IS NOT NULL").count() == 0


def test_vw_line(clicks):
    df, roles = clicks
    texts = sorted(r[0] for r in df.select(vw_line(roles)).collect())
    assert texts[0] == "-1.0 '2 |Num same:5.0 |Cats _7 _10"
    assert "1.0 '1 |Num n1:2.0 same:5.0 |Cats _7 _-1" in texts


def test_vw_line_of_bare_row(spark):
    df = spark.createDataFrame([(None, None, None)], "id bigint, y double, c bigint")
    assert df.select(vw_line(Roles("id", "y", (), ("c",)))).first()[0] == (
        "-1.0 'ffffffffffffffff |Num  |Cats "
    )


def test_csv_and_sparse_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.5)], "a bigint, b bigint, c double")
    assert df.select(csv_line(df.columns)).first()[0] == "1,null,2.5"
    entries = spark.sql(
        "SELECT 1D AS y, array(named_struct('slot', 7L, 'value', -1D),"
        " named_struct('slot', 0L, 'value', 0.5D)) AS e UNION ALL SELECT 0D, array()"
    )
    shown = sorted(r[0] for r in entries.select(sparse_line(F.col("y"), F.col("e"))).collect())
    assert shown == ["-1 | ", "1 | 0:0.5 7:-1.0"]
    write_lines(entries, sparse_line(F.col("y"), F.col("e")), str(tmp_path / "out"), files=1)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1


def test_hashed_entries(spark):
    roles = Roles("id", "y", ("x",), ("c1", "c2"))
    rows = [(1, 1.0, 0.0, 6, 5), (2, 0.0, None, None, -1), (3, 0.0, 1.0, 2**62, 0)]
    df = spark.createDataFrame(rows, "id bigint, y double, x double, c1 bigint, c2 bigint")

    def entries(frame):
        return {r["id"]: {e["slot"]: e["value"] for e in r["entries"]} for r in frame.collect()}

    # c1 is feature 1 and c2 feature 2, so 6 + 1 and 5 + 2 meet.
    assert entries(assembling.hash_features(df, roles)) == {
        1: {0: 0.0, 37: 2.0}, 2: {31: 1.0}, 3: {0: 1.0, 31: 1.0, 32: 1.0},
    }
    signed = entries(assembling.hash_features_signed(df, roles))
    folded = (2**62) ^ (2**62 >> 32)
    # Zero numbers go, and non-positive levels have no slot.
    assert signed == {
        1: {7: -1.0, 6: 1.0}, 2: {}, 3: {0: 1.0, 1 + (folded & 4095): -1.0 + 2 * (folded & 1)},
    }


def test_too_many_numbers_for_the_hashed_layout(spark):
    roles = Roles("id", "y", tuple(f"x{i}" for i in range(31)), ())
    with pytest.raises(ValueError, match="31"):
        assembling.hash_features(spark.range(1), roles)


def test_signed_hashes_add_up(spark):
    roles = Roles("id", "y", (), ("c1", "c2"))
    # Slot and sign come from the same low bits, so entries that meet have one sign and add up.
    df = spark.createDataFrame([(1, 1.0, 3, 3)], "id bigint, y double, c1 bigint, c2 bigint")
    assert assembling.hash_features_signed(df, roles).first()["entries"] == [(3, 2.0)]


def test_onehot_skips_large_columns_and_unseen_levels(clicks):
    df, roles = clicks
    dictionary = LevelTable.keep(level_counts(df, roles)).numbered(per_column=True)
    assert assembling.onehot_offsets(roles, dictionary.rows) == {"c1": 3, "c2": 5}
    assert assembling.onehot_offsets(roles, dictionary.rows, limit=3) == {"c1": 3}
    assert assembling.onehot_left_out(roles, dictionary.rows, 3) == ["c2"]
    assert assembling.onehot_left_out(roles, dictionary.rows, None) == []
    new = df.filter("id = 1").withColumn("c2", F.lit(77).cast("bigint"))
    entries = assembling.assemble_onehot(new, roles, dictionary).first()["entries"]
    assert [tuple(e) for e in entries] == [(0, 2.0), (1, 5.0), (4, 1.0)]


def test_hash_split_is_a_partition_and_stable(spark):
    df = spark.range(5000)
    parts = splitting.split_hash(df, "id", [0.75, 0.25], seed=3)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000 and 0.72 < sizes[0] / 5000 < 0.78
    again = splitting.split_hash(df.repartition(7), "id", [3, 1], seed=3)
    assert rows_of(again[1]) == rows_of(parts[1])
    other = splitting.split_hash(df, "id", [0.75, 0.25], seed=4)
    assert rows_of(other[1]) != rows_of(parts[1])
    row = splitting.split_counts(df, "id", [0.75, 0.25], seed=3).first()
    assert tuple(row) == (5000, *sizes)


def test_a_part_too_small_to_split_off_is_refused():
    from clickfeat.operators.splitting import part_of

    with pytest.raises(ValueError, match="split off"):
        part_of(F.lit(1), [0.99999, 0.00001])


def test_level_counts_refuse_fractions(clicks):
    from clickfeat.operators.levels import level_counts

    df, roles = clicks
    with pytest.raises(TypeError, match="c1"):
        level_counts(df.withColumn("c1", F.lit(0.5)), roles)
