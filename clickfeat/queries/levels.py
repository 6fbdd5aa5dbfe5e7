"""Summaries and everything derived from level tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from clickfeat.operators import levels as lv
from clickfeat.operators import sketches, splitting, summary
from clickfeat.operators.splitting import split_counts as count_parts
from clickfeat.queries.frames import LI, LI_ROLES, counts, li, query, rounded
from clickfeat.workspace import small_table

_LEVELS = f"WITH {LI}, {counts('li', LI_ROLES)}"
_ALL_LEVELS = f"WITH {LI}, {counts('li', LI_ROLES, missing=True)}"
_NUMBERS = " UNION ALL ".join(
    f"SELECT {LI_ROLES.position(c)} AS pos, '{c}' AS col, CAST(min({c}) AS DOUBLE) AS min,"
    f" CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean,"
    f" round(CAST(sum({c}) AS DOUBLE), 2) AS sum, count({c}) AS n FROM li"
    for c in (LI_ROLES.label, *LI_ROLES.numeric)
)


@query(f"{_LEVELS} SELECT pos, col, count(*) AS levels FROM lc GROUP BY pos, col")
def level_cardinality(spark, sf_dir):
    return summary.level_cardinality(li(spark, sf_dir), LI_ROLES)


@query(
    f"""{_LEVELS} SELECT pos, col, count(*) AS levels FROM lc GROUP BY pos, col
UNION ALL SELECT 0, 'id', count(DISTINCT id) FROM li"""
)
def level_cardinality_with_id(spark, sf_dir):
    return summary.level_cardinality(li(spark, sf_dir), LI_ROLES, include_id=True)


@query(
    f"""{_LEVELS} SELECT pos, col, arg_max(value, (n, -value)) AS mode, max(n) AS mode_n
FROM lc GROUP BY pos, col"""
)
def level_modes(spark, sf_dir):
    return summary.level_modes(li(spark, sf_dir), LI_ROLES)


@query(
    f"""{_LEVELS} SELECT pos, col, arg_max(value, (n, -value)) AS mode, max(n) AS mode_n
FROM lc GROUP BY pos, col"""
)
def level_modes_sketched(spark, sf_dir):
    """Candidates by heavy hitters, then exact counts of those."""
    return sketches.heavy_modes(li(spark, sf_dir), LI_ROLES)


@query(f"{_LEVELS} SELECT col, count(*) < 100 AS below FROM lc GROUP BY col")
def columns_below_sketched(spark, sf_dir):
    """Columns of fewer than 100 levels, by sketches of two parts; one column is at the bound."""
    frame = li(spark, sf_dir)
    parts = [sketches.level_sketches(p, LI_ROLES) for p in splitting.split_hash(frame, "id", [1, 1])]
    below = sketches.columns_below(frame, LI_ROLES, 100, sketches.merge_sketches(*parts))
    rows = [(c, c in below) for c in LI_ROLES.categorical]
    return small_table(spark, ["col", "below"], [pa.string(), pa.bool_()], rows)


@query(f"WITH {LI} {_NUMBERS}")
def numeric_summary(spark, sf_dir):
    frame = summary.numeric_summary(li(spark, sf_dir), LI_ROLES)
    return rounded(rounded(frame, "mean"), "sum", digits=2)


@query(
    f"""{_LEVELS}, num AS ({_NUMBERS})
SELECT pos, col, 'numeric' AS kind, min, max, mean, sum, n, CAST(NULL AS BIGINT) AS mode,
  CAST(NULL AS BIGINT) AS levels FROM num
UNION ALL SELECT pos, col, 'categorical', NULL, NULL, NULL, NULL, NULL,
  arg_max(value, (n, -value)), count(*) FROM lc GROUP BY pos, col"""
)
def summary_table(spark, sf_dir):
    frame = summary.summarise(li(spark, sf_dir), LI_ROLES)
    return rounded(rounded(frame, "mean"), "sum", digits=2)


@query(f"{_ALL_LEVELS} SELECT pos, col, value, n FROM lc")
def level_counts(spark, sf_dir):
    return lv.level_counts(li(spark, sf_dir), LI_ROLES)


@query(f"{_LEVELS} SELECT pos, col, value FROM lc")
def level_sets(spark, sf_dir):
    return lv.level_sets(li(spark, sf_dir), LI_ROLES)


@query(f"{_LEVELS} SELECT pos, col, value, n, n1 AS label_sum, round(n1 / n, 6) AS rate FROM lc")
def target_rates(spark, sf_dir):
    counted = lv.level_counts(li(spark, sf_dir), LI_ROLES, keep_missing=False, by_label=True)
    return rounded(lv.target_rates(counted), "rate")


@query(
    f"WITH {LI} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, round(avg({c}), 6) AS mean FROM li" for c in LI_ROLES.columns
    )
)
def column_means(spark, sf_dir):
    return rounded(summary.column_means(li(spark, sf_dir), LI_ROLES.columns), "mean")


@query(f"{_ALL_LEVELS} SELECT pos, col, value, n0, n1 FROM lc")
def nb_level_counts(spark, sf_dir):
    counted = lv.level_counts(li(spark, sf_dir), LI_ROLES, by_label=True)
    return counted.select("pos", "col", "value", "n0", "n1")


@query(
    f"""{_ALL_LEVELS} SELECT pos, col, CAST(sum(n0) AS BIGINT) AS n0, CAST(sum(n1) AS BIGINT) AS n1
FROM lc GROUP BY pos, col"""
)
def nb_class_totals(spark, sf_dir):
    return lv.class_totals(lv.level_counts(li(spark, sf_dir), LI_ROLES, by_label=True))


@query(
    f"""{_ALL_LEVELS} SELECT pos, col, CASE WHEN n0 + n1 >= 30 THEN value END AS value,
  CAST(sum(n0) AS BIGINT) AS n0, CAST(sum(n1) AS BIGINT) AS n1 FROM lc GROUP BY 1, 2, 3"""
)
def nb_pooled_counts(spark, sf_dir):
    counted = lv.level_counts(li(spark, sf_dir), LI_ROLES, by_label=True)
    return lv.pool_rare(counted, 30).select("pos", "col", "value", "n0", "n1")


@query(
    f"""{_LEVELS} SELECT pos, col, value, row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS idx,
  count(*) OVER (PARTITION BY col) AS size FROM lc"""
)
def level_dictionary(spark, sf_dir):
    kept = lv.LevelTable.keep(lv.level_counts(li(spark, sf_dir), LI_ROLES, keep_missing=False))
    size = F.coalesce(*[F.when(F.col("col") == c, F.lit(n)) for c, n in kept.rows.items()])
    return kept.numbered(per_column=True).frame.select(
        "pos", "col", "value", "idx", size.cast("bigint").alias("size")
    )


_BUCKET = "('0x' || substr(md5('10:' || id), 1, 8))::BIGINT % 10000"


@query(
    f"""WITH {LI}, b AS (SELECT {_BUCKET} AS bucket FROM li)
SELECT count(*) AS total, count(*) FILTER (WHERE bucket < 8000) AS part_0,
  count(*) FILTER (WHERE bucket >= 8000) AS part_1 FROM b"""
)
def split_counts(spark, sf_dir):
    return count_parts(li(spark, sf_dir), "id", [0.8, 0.2], seed=10)
