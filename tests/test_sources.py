import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickfeat.functions.text import hex_to_long, long_to_hex
from clickfeat.roles import NUMERIC, Roles, adopt, guess_kind, resolve
from clickfeat.sources.csv import (
    generated_range,
    header_of,
    parse_labelled_dense,
    parse_nullable_integers,
    parse_numbers,
    parse_typed,
    read_lines,
    without_headers,
)
from tests.conftest import rows_of


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_typed_csv(spark):
    parsed, roles = parse_typed(
        lines(
            spark,
            "Id,Label,I1,C1,C2",
            "a,1, 2.5 ,891b62e7,\tff ",
            "b,0",  # ragged: absent fields are missing
            "c,,,,",  # blank fields are missing
            "Id,Label,I1,C1,C2",  # a repeated header
            "d,1,NaN,-1,7fffffffffffffff,surplus,fields",
        )
    )
    assert roles == Roles("Id", "Label", ("I1",), ("C1", "C2"))
    assert rows_of(parsed) == [
        (10, 1.0, 2.5, 0x891B62E7, 255),
        (11, 0.0, None, None, None),
        (12, None, None, None, None),
        (13, 1.0, None, -1, 2**63 - 1),
    ]


@pytest.mark.parametrize("cell", ["zz,1", "12zz,1", "1,one", "8000000000000000,1", "1-,2", "-,1"])
def test_typed_csv_raises_on_bad_text(spark, cell):
    parsed, _ = parse_typed(lines(spark, "Id,Label", cell))
    with pytest.raises(Exception, match="not a"):
        parsed.collect()


def test_bad_text_raises_without_ansi_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a"):
            parse_typed(lines(spark, "Id,Label", "1,one"))[0].collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_custom_guesser(spark):
    parsed, roles = parse_typed(
        lines(spark, "Id,Label,C1", "10,1,10"), guess=lambda i, name: NUMERIC
    )
    assert rows_of(parsed) == [(10.0, 1.0, 10.0)]
    assert roles.categorical == ()


def test_nullable_integers(spark):
    parsed, roles = parse_nullable_integers(
        lines(spark, "Id,Label,I1,C1", "10,1,,ff", "11,0,-7", "Id,again"), integer="bigint"
    )
    assert rows_of(parsed) == [(10, 1, None, 255), (11, 0, -7, None)]
    assert roles.numeric == ("I1",)


@pytest.mark.parametrize("cell", [" 1,1", "1.5,1", "3000000000,1"])
def test_nullable_integers_are_strict(spark, cell):
    parsed, _ = parse_nullable_integers(lines(spark, "Id,Label", cell))
    with pytest.raises(Exception, match="not a"):
        parsed.collect()


def test_numbers(spark):
    parsed = parse_numbers(lines(spark, "1,null,2.5", "null,-1e3,0"), ["a", "b", "c"])
    assert rows_of(parsed) == [(None, -1000.0, 0.0), (1.0, None, 2.5)]
    with pytest.raises(Exception, match="blank"):
        parse_numbers(lines(spark, "1,,2"), ["a", "b", "c"]).collect()


def test_labelled_dense(spark):
    parsed = parse_labelled_dense(lines(spark, "1,0.5,2", "0,1,1", "1"))
    assert sorted(map(tuple, parsed.collect())) == [
        (0.0, [1.0, 1.0]), (1.0, []), (1.0, [0.5, 2.0]),
    ]


def test_files_and_headers(spark, tmp_path):
    (tmp_path / "part-0").write_text("Id,Label,C1\n1,1,a\n")
    (tmp_path / "part-1").write_text("Id,Label,C1\n2,0,b\n")
    text = read_lines(spark, str(tmp_path))
    assert header_of(text) == ["Id", "Label", "C1"]
    assert rows_of(without_headers(text)) == [("1,1,a",), ("2,0,b",)]
    assert rows_of(parse_typed(text)[0]) == [(1, 1.0, 10), (2, 0.0, 11)]


def test_no_header_raises(spark):
    with pytest.raises(ValueError, match="header"):
        parse_typed(lines(spark, "1,2"))


def test_empty_input(spark):
    parsed, _ = parse_typed(lines(spark, "Id,Label,I1"))
    assert parsed.collect() == []


def test_generated_range(spark):
    assert rows_of(generated_range(spark)) == [(i,) for i in range(100)]
    assert generated_range(spark).rdd.getNumPartitions() == 10


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-(2**63) + 1, 2**63 - 1), min_size=1, max_size=40))
def test_signed_hex_round_trip(spark, values):
    texts = spark.createDataFrame([(format(v, "x"), v) for v in values], "t string, v bigint")
    assert texts.filter(~hex_to_long(F.col("t")).eqNullSafe(F.col("v"))).count() == 0


def test_long_to_hex(spark):
    shown = spark.createDataFrame([(255,), (-1,)], "v bigint").select(long_to_hex(F.col("v")))
    assert rows_of(shown) == [("ff",), ("f" * 16,)]


def test_roles_and_references(spark):
    assert [guess_kind(i, n) for i, n in enumerate(["Id", "Label", "C1"])] == [
        "categorical", "numeric", "categorical",
    ]
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert resolve(df, 1) == "b" and resolve(df, "a") == "a"
    for unknown in (2, -1, "z"):
        with pytest.raises(KeyError):
            resolve(df, unknown)


def test_adopt_turns_nan_into_missing(spark):
    df = spark.createDataFrame([(1, 1, float("nan"), 3)], "id int, y int, x double, c int")
    adopted = adopt(df, Roles("id", "y", ("x",), ("c",)))
    assert rows_of(adopted) == [(1, 1.0, None, 3)]
    assert [t for _, t in adopted.dtypes] == ["bigint", "double", "double", "bigint"]
