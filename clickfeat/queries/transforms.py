"""Fitted transforms, feature vectors and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.functions.numeric import recode_label as recode
from clickfeat.operators import assembling, encoding, imputing, scaling, splitting, summary
from clickfeat.operators.levels import LevelTable
from clickfeat.operators.levels import level_counts as count_levels
from clickfeat.operators.ordering import file_positions
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
from clickfeat.queries.frames import (
    EV,
    LI,
    LI_ROLES,
    counts,
    ev,
    li,
    query,
    rounded,
    table,
)
from clickfeat.plans.state import TableState
from clickfeat.sinks.text import sparse_line
from clickfeat.workspace import new_path

_LEVELS = f"WITH {LI}, {counts('li', LI_ROLES)}"
_NUMERIC = LI_ROLES.numeric
_MODES = "mode AS (SELECT col, arg_max(value, (n, -value)) AS m FROM lc GROUP BY col)"
_MEANS = f"mean AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in _NUMERIC)} FROM li)"
_FILL_LEVELS = ", ".join(
    f"COALESCE({c}, (SELECT m FROM mode WHERE col = '{c}')) AS {c}" for c in LI_ROLES.categorical
)
_BOUNDS = (
    "b AS (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _NUMERIC)
    + " FROM li)"
)
_IX = "ix AS (SELECT pos, col, value, row_number() OVER (ORDER BY pos, value) - 1 AS idx FROM lc)"


def _looked_up(source: str, what: str, otherwise: str, frame: str = "li") -> tuple[str, str]:
    """Select items and joins that replace ``c1..c3`` by a column of a level CTE."""
    items = ", ".join(
        f"COALESCE(l_{c}.{what}, {otherwise.format(c=f'{frame}.{c}')}) AS {c}"
        for c in LI_ROLES.categorical
    )
    joins = " ".join(
        f"LEFT JOIN {source} l_{c} ON l_{c}.col = '{c}' AND l_{c}.value = {frame}.{c}"
        for c in LI_ROLES.categorical
    )
    return items, joins


def _kept(spark, sf_dir, **options):
    return LevelTable.keep(count_levels(li(spark, sf_dir), LI_ROLES, **options))


@query(
    f"WITH {LI} SELECT id, CAST(label AS DOUBLE) AS label, "
    + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _NUMERIC)
    + ", c1, c2, c3 FROM li"
)
def fill_constant(spark, sf_dir):
    return scaling.fill_constant(li(spark, sf_dir), ("label", *_NUMERIC), 0)


_IMPUTED = f"""{_LEVELS}, {_MODES}, {_MEANS}
SELECT id, CAST(li.label AS DOUBLE) AS label,
  {', '.join(f'round(COALESCE(li.{c}, mean.{c}), 6) AS {c}' for c in _NUMERIC)},
  {_FILL_LEVELS} FROM li, mean"""


@query(_IMPUTED)
def impute_mean_mode(spark, sf_dir):
    return rounded(Stages([Impute()]).fit_transform(li(spark, sf_dir), LI_ROLES), *_NUMERIC)


@query(
    f"{_LEVELS}, {_MODES} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, round(avg({c}), 6) AS mean, CAST(NULL AS BIGINT) AS mode FROM li"
        for c in ("label", *_NUMERIC)
    )
    + " UNION ALL SELECT col, NULL, m FROM mode"
)
def impute_fit(spark, sf_dir):
    return rounded(imputing.mean_mode_table(li(spark, sf_dir), LI_ROLES), "mean")


@query(_IMPUTED)
def impute_apply(spark, sf_dir):
    """Fit and save in one step, load and fill in another."""
    path = new_path(spark, "imputer")
    Stages([Impute()]).fit(li(spark, sf_dir), LI_ROLES).save(spark, path)
    return rounded(FittedStages.load(spark, path).transform(li(spark, sf_dir)), *_NUMERIC)


@query(
    f"WITH {LI}, m AS (SELECT "
    + ", ".join(f"avg({c}) AS {c}" for c in LI_ROLES.columns)
    + " FROM li) SELECT "
    + ", ".join(f"round(COALESCE(CAST(li.{c} AS DOUBLE), m.{c}), 6) AS {c}" for c in LI_ROLES.columns)
    + " FROM li, m"
)
def fill_column_mean(spark, sf_dir):
    numbers = encoding.as_doubles(li(spark, sf_dir))
    return rounded(imputing.fill_column_mean(numbers), *LI_ROLES.columns)


def _scaled_sql(item: str, columns=_NUMERIC) -> str:
    items = ", ".join(f"round({item.format(c=c)}, 6) AS {c}" for c in columns)
    return f"WITH {LI}, {_BOUNDS} SELECT id, {items} FROM li, b"


@query(_scaled_sql("({c} - lo_{c}) / NULLIF(hi_{c} - lo_{c}, 0)"))
def scale_minmax(spark, sf_dir):
    frame = li(spark, sf_dir).select("id", *_NUMERIC)
    return rounded(scaling.scale_minmax(frame, summary.bounds_of(frame, _NUMERIC)), *_NUMERIC)


@query(_scaled_sql("(COALESCE({c}, 0) - lo_{c}) / NULLIF(hi_{c} - lo_{c}, 0)", _NUMERIC[:2]))
def scale_minmax_subset(spark, sf_dir):
    columns = _NUMERIC[:2]
    frame = li(spark, sf_dir).select("id", *columns)
    scaled = scaling.scale_minmax_filled(frame, summary.bounds_of(frame, columns))
    return rounded(scaled, *columns)


@query(_scaled_sql("CASE WHEN {c} - lo_{c} + 1 > 0 THEN ln({c} - lo_{c} + 1) END"))
def scale_log(spark, sf_dir):
    frame = li(spark, sf_dir).select("id", *_NUMERIC)
    return rounded(scaling.scale_log(frame, summary.bounds_of(frame, _NUMERIC)), *_NUMERIC)


@query(
    _scaled_sql(
        "CASE WHEN COALESCE({c}, 0) - lo_{c} + 1 > 0 THEN ln(COALESCE({c}, 0) - lo_{c} + 1) END"
        " / NULLIF(ln(hi_{c} - lo_{c} + 1), 0)"
    )
)
def scale_log_minmax(spark, sf_dir):
    frame = li(spark, sf_dir).select("id", *_NUMERIC)
    return rounded(scaling.scale_log_minmax(frame, summary.bounds_of(frame, _NUMERIC)), *_NUMERIC)


@query(
    f"{_LEVELS}, keep AS (SELECT * FROM lc WHERE n > 30) SELECT id, "
    + "{}, label FROM li {}".format(*_looked_up("keep", "value", "NULL"))
)
def drop_rare_levels(spark, sf_dir):
    frequent = encoding.frequent_levels(_kept(spark, sf_dir), 30)
    frame = li(spark, sf_dir).select("id", "label", *LI_ROLES.categorical)
    return encoding.drop_rare_levels(frame, LI_ROLES, frequent)


@query(f"{_LEVELS}, {_IX} SELECT pos, col, value, idx FROM ix")
def global_index(spark, sf_dir):
    return _kept(spark, sf_dir).numbered().frame.select("pos", "col", "value", "idx")


@query(
    f"{_LEVELS}, {_IX} SELECT id, " + "{} FROM li {}".format(*_looked_up("ix", "idx", "-1"))
)
def apply_global_index(spark, sf_dir):
    frame = li(spark, sf_dir).select("id", *LI_ROLES.categorical)
    return encoding.index_levels(frame, LI_ROLES, _kept(spark, sf_dir).numbered())


@query(
    f"{_LEVELS}, {_IX} SELECT id, " + "{} FROM li {}".format(*_looked_up("ix", "idx", "-1"))
)
def apply_global_index_shuffled(spark, sf_dir):
    """No column within the broadcast budget: all share one lookup."""
    frame = li(spark, sf_dir).select("id", *LI_ROLES.categorical)
    numbered = _kept(spark, sf_dir).numbered()
    return encoding.index_levels(frame, LI_ROLES, numbered, broadcast_levels=0)


@query(
    f"""{_LEVELS}, ix AS (SELECT col, value,
  row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS idx FROM lc) SELECT id, """
    + "{} FROM li {}".format(*_looked_up("ix", "idx", "-1"))
)
def column_index(spark, sf_dir):
    frame = li(spark, sf_dir).select("id", *LI_ROLES.categorical)
    numbered = _kept(spark, sf_dir).numbered(per_column=True)
    return encoding.index_levels(frame, LI_ROLES, numbered)


_RATES = "rates AS (SELECT col, value, n1 / n AS rate FROM lc)"
_ENCODED_ITEMS, _ENCODED_JOINS = _looked_up("rates", "rate", "CAST({c} AS DOUBLE)")
_ENCODED = f"""{_LEVELS}, {_RATES}, enc AS (SELECT id, li.label, i1, i2, i3, i4, {_ENCODED_ITEMS}
  FROM li {_ENCODED_JOINS})"""


@query(
    f"{_ENCODED} SELECT id, label, i1, i2, i3, i4, "
    "round(c1, 6) AS c1, round(c2, 6) AS c2, round(c3, 6) AS c3 FROM enc"
)
def target_encode(spark, sf_dir):
    frame = li(spark, sf_dir)
    encoded = encoding.target_encode(frame, LI_ROLES, encoding.fit_target_rates(frame, LI_ROLES))
    return rounded(encoded, *LI_ROLES.categorical)


@query(
    f"{_ENCODED} SELECT id, label, i1, i2, i3, i4, "
    "round(c1, 6) AS c1, round(c2, 6) AS c2, round(c3, 6) AS c3 FROM enc"
)
def target_encode_shuffled(spark, sf_dir):
    """Whole rows through the shared lookup; levels of the fitted table only."""
    frame = li(spark, sf_dir)
    rates = encoding.fit_target_rates(frame, LI_ROLES)
    encoded = encoding.target_encode(frame, LI_ROLES, rates, broadcast_levels=0)
    return rounded(encoded, *LI_ROLES.categorical)


@query(
    f"{_ENCODED}, m AS (SELECT "
    + ", ".join(f"avg({c}) AS {c}" for c in LI_ROLES.columns)
    + " FROM enc) SELECT "
    + ", ".join(f"round(COALESCE(CAST(enc.{c} AS DOUBLE), m.{c}), 6) AS {c}" for c in LI_ROLES.columns)
    + " FROM enc, m"
)
def target_encode_filled(spark, sf_dir):
    frame = li(spark, sf_dir)
    rates = encoding.fit_target_rates(frame, LI_ROLES)
    encoded = encoding.as_doubles(encoding.target_encode(frame, LI_ROLES, rates))
    numbers = [c for c in LI_ROLES.columns if c not in LI_ROLES.categorical]
    means = {**summary.means_of(frame, numbers), **encoding.rate_means(rates)}
    return rounded(imputing.fill_values(encoded, means), *LI_ROLES.columns)


def _stages_sql(fit_on: str, more_than: int, log: bool) -> str:
    """Fill 0, optional log, min-max, drop rare, global index; fitted on ``fit_on``, applied to li."""
    value = "COALESCE({c}, 0)"
    bounds = ", ".join(
        f"min({value.format(c=c)}) AS lo_{c}, max({value.format(c=c)}) AS hi_{c}" for c in _NUMERIC
    )
    if log:
        item = (
            "CASE WHEN COALESCE({c}, 0) - lo_{c} + 1 > 0 THEN ln(COALESCE({c}, 0) - lo_{c} + 1) END"
            " / NULLIF(ln(hi_{c} - lo_{c} + 1), 0)"
        )
    else:
        item = "(COALESCE({c}, 0) - lo_{c}) / NULLIF(hi_{c} - lo_{c}, 0)"
    items = ", ".join(f"round({item.format(c=c)}, 6) AS {c}" for c in _NUMERIC)
    levels, joins = _looked_up("ix", "idx", "-1")
    return f"""WITH {LI}, fit AS ({fit_on}), {counts("fit", LI_ROLES)},
b AS (SELECT {bounds} FROM fit),
ix AS (SELECT col, value, row_number() OVER (ORDER BY pos, value) - 1 AS idx FROM lc
  WHERE n > {more_than})
SELECT id, CAST(li.label AS DOUBLE) AS label, {items}, {levels} FROM b, li {joins}"""


@query(_stages_sql("SELECT * FROM li", 30, log=True))
def default_preparation(spark, sf_dir):
    """The default stages: fill, log, min-max, drop rare levels, global index."""
    prepared = default_stages(more_than=30).fit_transform(li(spark, sf_dir), LI_ROLES)
    return rounded(prepared, *_NUMERIC)


def _merged_state(spark, sf_dir):
    """The state of the line item frame, from saved states of three parts of it."""
    frame, states = li(spark, sf_dir), []
    for part in splitting.split_hash(frame, "id", [0.5, 0.3, 0.2], seed=11):
        path = new_path(spark, "part-state")
        TableState.of(part, LI_ROLES).save(spark, path)
        states.append(TableState.load(spark, path))
    return states[0].merge(*states[1:])


@query(_stages_sql("SELECT * FROM li", 30, log=True))
def stages_from_merged_state(spark, sf_dir):
    """The default stages, fitted on merged states without reading their rows again."""
    fitted = default_stages(more_than=30).fit_state(_merged_state(spark, sf_dir))
    return rounded(fitted.transform(li(spark, sf_dir)), *_NUMERIC)


@query(
    f"{_LEVELS}, {_RATES} SELECT r.col, r.value, round(rate, 6) AS rate, n, n0, n1"
    " FROM rates r JOIN lc ON lc.col = r.col AND lc.value = r.value"
)
def target_rates_merged(spark, sf_dir):
    """Label means and class counts of every level, from merged states."""
    state = _merged_state(spark, sf_dir)
    classes = state.counts.frame.select("col", "value", "n0", "n1")
    rates = state.rates.frame.select("col", "value", "rate", "n")
    return rounded(rates.join(classes, ["col", "value"]), "rate")


@query(_stages_sql("SELECT * FROM li", 28, log=False))
def stages_fit_transform(spark, sf_dir):
    stages = Stages([FillMissing(0), Scale("minmax"), DropRareLevels(28), IndexLevels()])
    return rounded(stages.fit_transform(li(spark, sf_dir), LI_ROLES), *_NUMERIC)


_TRAIN_BUCKET = "('0x' || substr(md5('7:' || id), 1, 8))::BIGINT % 10000"


@query(_stages_sql(f"SELECT * FROM li WHERE {_TRAIN_BUCKET} < 7500", 22, log=True))
def stages_apply_new(spark, sf_dir):
    """Fit on the training part, apply to both parts: the whole table, with unseen levels."""
    frame = li(spark, sf_dir)
    train, _ = splitting.split_hash(frame, "id", [0.75, 0.25], seed=7)
    fitted = default_stages(more_than=22).fit(train, LI_ROLES)
    return rounded(fitted.transform(frame), *_NUMERIC)


def _onehot_sql(having: str) -> str:
    return f"""{_LEVELS}, dict AS (SELECT pos, col, value,
  row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS idx FROM lc),
sizes AS (SELECT pos, col, count(*) AS size FROM lc GROUP BY pos, col HAVING {having}),
offs AS (SELECT col, 4 + sum(size) OVER (ORDER BY pos) - size AS start FROM sizes),
slots AS (SELECT d.col, d.value, CAST(o.start + d.idx AS BIGINT) AS slot
  FROM dict d JOIN offs o ON o.col = d.col)
SELECT id, (CASE WHEN label > 0 THEN '1' ELSE '-1' END) || ' | ' || concat_ws(' ',
  '0:' || i1, '1:' || i2, '2:' || i3, '3:' || i4, a.slot || ':1.0', b.slot || ':1.0',
  c.slot || ':1.0') AS line FROM li
LEFT JOIN slots a ON a.col = 'c1' AND a.value = c1 LEFT JOIN slots b ON b.col = 'c2' AND b.value = c2
LEFT JOIN slots c ON c.col = 'c3' AND c.value = c3"""


@query(_onehot_sql("count(*) < 1000"))
def onehot_offsets(spark, sf_dir):
    """Columns below 1000 levels."""
    return _onehot(spark, sf_dir, 1000)


@query(_onehot_sql("TRUE"))
def onehot_all_columns(spark, sf_dir):
    return _onehot(spark, sf_dir, None)


def _onehot(spark, sf_dir, limit):
    frame = li(spark, sf_dir)
    dictionary = _kept(spark, sf_dir, keep_missing=False).numbered(per_column=True)
    assembled = assembling.assemble_onehot(frame, LI_ROLES, dictionary, limit)
    line = sparse_line(F.col("label"), F.col("entries"))
    return assembled.select("id", line.alias("line"))


def _hashed_sql(level_rows: str, keep: str = "TRUE") -> str:
    """Per row: numeric entries and level entries, equal slots summed, in slot order."""
    numbers = " UNION ALL ".join(
        f"SELECT rn, {i} AS slot, {c} AS value FROM r WHERE {c} IS NOT NULL"
        for i, c in enumerate(_NUMERIC)
    )
    return f"""WITH {LI}, r AS (SELECT row_number() OVER () AS rn, * FROM li),
e AS ({numbers} UNION ALL {level_rows}),
s AS (SELECT rn, slot, sum(value) AS value FROM e GROUP BY rn, slot),
t AS (SELECT rn, string_agg(slot || ':' || value, ' ' ORDER BY slot) AS line FROM s
  WHERE {keep} GROUP BY rn)
SELECT id, (CASE WHEN label > 0 THEN '1' ELSE '-1' END) || ' | ' || COALESCE(line, '') AS line
FROM r LEFT JOIN t ON t.rn = r.rn"""


_HASH_ROWS = " UNION ALL ".join(
    f"SELECT rn, 30 + (({c} + {LI_ROLES.features.index(c)}) & 134217727), 1.0::DOUBLE FROM r"
    f" WHERE {c} IS NOT NULL"
    for c in LI_ROLES.categorical
)


@query(_hashed_sql(_HASH_ROWS))
def hash_features(spark, sf_dir):
    hashed = assembling.hash_features(li(spark, sf_dir), LI_ROLES)
    return hashed.select("id", sparse_line(F.col("label"), F.col("entries")).alias("line"))


_SIGNED_ROWS = " UNION ALL ".join(
    f"SELECT rn, 4 + (xor({c}, {c} >> 32) & 4095),"
    f" CASE WHEN xor({c}, {c} >> 32) & 1 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END FROM r"
    f" WHERE {c} > 0"
    for c in LI_ROLES.categorical
)


@query(_hashed_sql(_SIGNED_ROWS, "value <> 0"))
def hash_features_signed(spark, sf_dir):
    hashed = assembling.hash_features_signed(li(spark, sf_dir), LI_ROLES)
    return hashed.select("id", sparse_line(F.col("label"), F.col("entries")).alias("line"))


@query(
    f"""WITH {EV} SELECT id, CASE WHEN label > 0 THEN 1 ELSE -1 END AS signed,
  CASE WHEN label = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS train,
  CASE WHEN label = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS test FROM ev"""
)
def recode_label(spark, sf_dir):
    label = F.col("label")
    return ev(spark, sf_dir).select(
        "id",
        recode(label, label > 0, 1, -1).alias("signed"),
        recode(label, label == 1, 1.0, 0.0).alias("train"),
        recode(label, label == 1, 1.0, -1.0).alias("test"),
    )


@query(
    f"""WITH {LI} SELECT id, c1,
  CASE WHEN ('0x' || substr(md5('3334:' || id), 1, 8))::BIGINT % 10000 < 7500 THEN 0 ELSE 1 END
    AS part FROM li"""
)
def split_hash(spark, sf_dir):
    part = splitting.part_of(F.col("id"), [0.75, 0.25], 3334)
    return li(spark, sf_dir).select("id", "c1", part.alias("part"))


_SPLIT_BY = ("id", "label", "c1", "c2", "c3")


@query(
    f"""WITH {LI} SELECT *, CASE WHEN ('0x' || substr(md5('1:' || concat_ws('|',
  {", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in _SPLIT_BY)})), 1, 8))::BIGINT
  % 10000 < 8000 THEN 0 ELSE 1 END AS part FROM li"""
)
def split_random(spark, sf_dir):
    """A random split .8/.2 (seed 1), every row with its part."""
    part = splitting.random_part(_SPLIT_BY, [0.8, 0.2], 1)
    return li(spark, sf_dir).withColumn("part", part)


@query("SELECT event_id, event_type, event_id AS number FROM events")
def file_row_numbers(spark, sf_dir):
    """Rows numbered in the order they are stored; the table's ids say where each one stands."""
    stored = table(spark, sf_dir, "events").select("event_id", "event_type")
    return file_positions(stored, "number").select("event_id", "event_type", "number")


@query(
    """SELECT event_id, event_type,
  CASE WHEN ('0x' || substr(md5('5:events.parquet:' || event_id), 1, 8))::BIGINT % 10000 < 8500
    THEN 0 ELSE 1 END AS part FROM events"""
)
def split_rows(spark, sf_dir):
    """A random split .85/.15 of rows, not of values: equal rows are drawn one by one."""
    stored = table(spark, sf_dir, "events").select("event_id", "event_type")
    rows = file_positions(stored).withColumn("part", splitting.row_part([0.85, 0.15], 5))
    return rows.select("event_id", "event_type", "part")


@query(
    f"{_ENCODED} SELECT id, label, "
    + ", ".join(
        f"round(CASE WHEN hi_{c} > lo_{c} THEN ({c} - lo_{c}) / (hi_{c} - lo_{c}) END, 6) AS {c}"
        for c in LI_ROLES.categorical
    )
    + " FROM enc, (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LI_ROLES.categorical)
    + " FROM enc)"
)
def stages_encode_then_scale(spark, sf_dir):
    """Label means are numeric features for the stage after."""
    frame = li(spark, sf_dir)
    scaled = Stages([EncodeTarget(), Scale("minmax")]).fit_transform(frame, LI_ROLES)
    rates = scaled.select("id", "label", *LI_ROLES.categorical)
    return rounded(rates, *LI_ROLES.categorical)
