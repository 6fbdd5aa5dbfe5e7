"""Every registered query against its SQL on DuckDB, on whole tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
ORACLES = contract.oracle_sql()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _sorted(rows):
    key = lambda row: tuple((v is not None, str(type(v)), v or 0) for v in row)
    return sorted(rows, key=key)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, str(DATA))
    columns = sorted(result.columns)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = _sorted([tuple(row[i] for i in order) for row in expected.fetchall()])
    got = _sorted([tuple(row[c] for c in columns) for row in result.collect()])
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, str(DATA)).count() > 0


def test_random_splits_keep_every_row(spark):
    from clickfeat.queries.frames import li

    parts = contract.queries()["split_random"](spark, str(DATA))
    assert parts.count() == li(spark, str(DATA)).count()
    assert "Sort" not in parts._jdf.queryExecution().executedPlan().toString()
    counts = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert 0.75 < counts[0] / sum(counts.values()) < 0.85


def test_flagship(spark):
    flagship = contract.entry(spark)
    assert flagship.count() > 0
    assert flagship.columns == ["id", "label", "i1", "i2", "i3", "i4", "c1", "c2", "c3"]
