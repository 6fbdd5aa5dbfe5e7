import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("clickfeat-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clicks(spark):
    """A hand-made table: missing cells, an all-missing and a constant column, a tie for the mode."""
    from clickfeat import Roles

    roles = Roles("id", "label", ("n1", "same", "empty"), ("c1", "c2", "none"))
    rows = [
        (1, 1.0, 2.0, 5.0, None, 7, -1, None),
        (2, 0.0, None, 5.0, None, 7, 10, None),
        (3, 0.0, 4.0, 5.0, None, 3, 10, None),
        (3, 1.0, 0.0, 5.0, None, 3, None, None),
        (5, 0.0, 2.0, 5.0, None, None, 11, None),
    ]
    types = (
        "id bigint, label double, n1 double, same double, empty double,"
        " c1 bigint, c2 bigint, none bigint"
    )
    return spark.createDataFrame(rows, types), roles


def rows_of(df, *columns):
    """Rows as sorted tuples, missing values first."""
    picked = df.select(*columns) if columns else df
    key = lambda row: tuple((v is not None, v if v is not None else 0) for v in row)
    return sorted((tuple(r) for r in picked.collect()), key=key)
