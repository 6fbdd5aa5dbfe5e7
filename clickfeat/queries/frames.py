"""The two test frames and their SQL, and the registry of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.roles import Roles

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EV_ROLES = Roles("id", "label", ("i1", "i2", "i3"), ("c1", "c2", "c3"))
LI_ROLES = Roles("id", "label", ("i1", "i2", "i3", "i4"), ("c1", "c2", "c3"))

_EV_COLUMNS = [
    "event_id AS id",
    "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS i1",
    "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id % 13 AS DOUBLE) END AS i2",
    "CAST(hour(ts) AS DOUBLE) AS i3",
    "CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS c1",
    "CASE WHEN event_id % 3 = 0 THEN NULL"
    " ELSE CAST(length(props) * 1000 + user_id % 20 AS BIGINT) END AS c2",
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE substr(md5(props), 1, 8) END AS c3_hex",
]

_LI_COLUMNS = [
    "l_orderkey * 8 + l_linenumber AS id",
    "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label",
    "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS i1",
    "l_extendedprice AS i2",
    "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_discount END AS i3",
    "l_tax AS i4",
    "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey END AS c1",
    "l_suppkey AS c2",
    "CAST(l_linenumber AS BIGINT) AS c3",
]


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events frame; ``c3`` is hex text read as a long, ``c3_hex`` the text."""
    frame = table(spark, sf_dir, "events").selectExpr(*_EV_COLUMNS)
    return frame.withColumn("c3", F.conv("c3_hex", 16, 10).cast("bigint"))


def li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line item frame; its ``id`` is not unique."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_LI_COLUMNS)


EV = (
    "ev0 AS (SELECT " + ", ".join(_EV_COLUMNS) + " FROM events), "
    "ev AS (SELECT *, ('0x' || c3_hex)::BIGINT AS c3 FROM ev0)"
)
LI = "li AS (SELECT " + ", ".join(_LI_COLUMNS) + " FROM lineitem)"


def cells(frame: str, roles: Roles, name: str = "cell") -> str:
    """A CTE with one row per categorical cell: ``pos, col, value, label``."""
    parts = [
        f"SELECT {roles.position(c)} AS pos, '{c}' AS col, {c} AS value, label FROM {frame}"
        for c in roles.categorical
    ]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def counts(frame: str, roles: Roles, missing: bool = False, name: str = "lc") -> str:
    """CTEs down to rows per level: ``pos, col, value, n, n0, n1``."""
    where = "" if missing else " WHERE value IS NOT NULL"
    return (
        cells(frame, roles)
        + f", {name} AS (SELECT pos, col, value, count(*) AS n,"
        " CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n0,"
        " CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1"
        f" FROM cell{where} GROUP BY pos, col, value)"
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
