"""Sources, sinks and column choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.functions.text import cell_text, long_to_hex
from clickfeat.operators import projection
from clickfeat.operators.assembling import assemble_sparse as assemble
from clickfeat.operators.encoding import fit_target_rates, index_levels
from clickfeat.operators.levels import LevelTable, level_counts
from clickfeat.operators.ordering import number_rows, store_in_order
from clickfeat.operators.splitting import random_part
from clickfeat.operators.summary import level_cardinality
from clickfeat.plans.jobs import split_lines as split_files
from clickfeat.plans.stages import FittedStages, Impute, IndexLevels, Stages
from clickfeat.queries.frames import (
    EV,
    EV_ROLES,
    LI,
    LI_ROLES,
    counts,
    cells,
    ev,
    li,
    query,
    table,
)
from clickfeat.roles import CATEGORICAL
from clickfeat.sinks.text import csv_line, rate_line, sparse_line, vw_line, write_lines
from clickfeat.sources.csv import (
    parse_labelled_dense,
    parse_nullable_integers,
    parse_numbers,
    parse_typed,
    read_lines,
    without_headers,
)
from clickfeat.workspace import new_path

TYPED_HEADER = "Id,Label,I1,I2,I3,C1,C2,C3"
INTEGER_HEADER = "Id,Label,I1,I2,C1,C2,C3"


def _blank(column):
    return cell_text(column, "")


def _with_headers(spark, sf_dir, lines, header):
    """The lines with one header line per region, as if each region were a part file."""
    headers = table(spark, sf_dir, "region").select(F.lit(header).alias("line"))
    return lines.unionByName(headers)


def typed_lines(spark, sf_dir):
    """The events frame as click CSV: hex id and levels, padded fields, no trailing blanks."""
    c = F.col
    line = F.concat_ws(
        ",",
        long_to_hex(c("id")),
        c("label").cast("string"),
        F.concat(F.lit(" "), _blank(c("i1"))),
        F.concat(_blank(c("i2")), F.lit(" ")),
        _blank(c("i3")),
        _blank(long_to_hex(c("c1"))),
        _blank(long_to_hex(c("c2"))),
        _blank(c("c3_hex")),
    )
    lines = ev(spark, sf_dir).select(F.rtrim(line, F.lit(",")).alias("line"))
    return _with_headers(spark, sf_dir, lines, TYPED_HEADER)


_TYPED_LINES_SQL = f"""WITH {EV}, all_lines AS (
  SELECT rtrim(concat_ws(',', lower(to_hex(id)), CAST(label AS VARCHAR),
    ' ' || COALESCE(CAST(i1 AS VARCHAR), ''), COALESCE(CAST(i2 AS VARCHAR), '') || ' ',
    COALESCE(CAST(i3 AS VARCHAR), ''), COALESCE(lower(to_hex(c1)), ''),
    COALESCE(lower(to_hex(c2)), ''), COALESCE(c3_hex, '')), ',') AS line FROM ev
  UNION ALL SELECT '{TYPED_HEADER}' FROM region),
lines AS (SELECT line FROM all_lines WHERE line NOT LIKE 'Id%')"""


_TYPED_SQL = f"""{_TYPED_LINES_SQL},
f AS (SELECT string_split(line, ',') AS f FROM lines)
SELECT ('0x' || NULLIF(trim(f[1]), ''))::BIGINT AS "Id",
  CAST(NULLIF(trim(f[2]), '') AS DOUBLE) AS "Label",
  CAST(NULLIF(trim(f[3]), '') AS DOUBLE) AS "I1", CAST(NULLIF(trim(f[4]), '') AS DOUBLE) AS "I2",
  CAST(NULLIF(trim(f[5]), '') AS DOUBLE) AS "I3",
  ('0x' || NULLIF(trim(f[6]), ''))::BIGINT AS "C1",
  ('0x' || NULLIF(trim(f[7]), ''))::BIGINT AS "C2",
  ('0x' || NULLIF(trim(f[8]), ''))::BIGINT AS "C3" FROM f"""


@query(_TYPED_SQL)
def src_typed_csv(spark, sf_dir):
    return parse_typed(typed_lines(spark, sf_dir), TYPED_HEADER.split(","))[0]


def _files(spark, lines, name):
    """The lines as a folder of text files in the shared folder."""
    path = new_path(spark, name)
    write_lines(lines, F.col("line"), path)
    return path


@query(_TYPED_SQL)
def src_typed_files(spark, sf_dir):
    """From text files, whose header line is looked for."""
    path = _files(spark, typed_lines(spark, sf_dir), "typed-files")
    return parse_typed(read_lines(spark, path))[0]


@query(f"{_TYPED_LINES_SQL} SELECT line FROM lines")
def split_text_files(spark, sf_dir):
    """Text files split into two folders: both together hold every line but the headers, once."""
    source = _files(spark, typed_lines(spark, sf_dir), "lines")
    outs = [new_path(spark, "part") for _ in range(2)]
    split_files(spark, source, *outs)
    return read_lines(spark, outs[0]).unionByName(read_lines(spark, outs[1]))


def integer_lines(spark, sf_dir):
    """The events frame as integer click CSV: decimal id, hex levels, untrimmed."""
    c = F.col
    line = F.concat_ws(
        ",",
        c("id").cast("string"),
        c("label").cast("string"),
        _blank(c("i2").cast("int")),
        _blank(c("i3").cast("int")),
        _blank(long_to_hex(c("c1"))),
        _blank(long_to_hex(c("c2"))),
        _blank(c("c3_hex")),
    )
    lines = ev(spark, sf_dir).select(line.alias("line"))
    return _with_headers(spark, sf_dir, lines, INTEGER_HEADER)


@query(
    f"""WITH {EV}, lines AS (
  SELECT concat_ws(',', CAST(id AS VARCHAR), CAST(label AS VARCHAR),
    COALESCE(CAST(CAST(i2 AS INTEGER) AS VARCHAR), ''),
    COALESCE(CAST(CAST(i3 AS INTEGER) AS VARCHAR), ''),
    COALESCE(lower(to_hex(c1)), ''), COALESCE(lower(to_hex(c2)), ''),
    COALESCE(c3_hex, '')) AS line FROM ev
  UNION ALL SELECT '{INTEGER_HEADER}' FROM region),
f AS (SELECT string_split(line, ',') AS f FROM lines WHERE line NOT LIKE 'Id%')
SELECT CAST(NULLIF(f[1], '') AS BIGINT) AS "Id", CAST(NULLIF(f[2], '') AS BIGINT) AS "Label",
  CAST(NULLIF(f[3], '') AS BIGINT) AS "I1", CAST(NULLIF(f[4], '') AS BIGINT) AS "I2",
  ('0x' || NULLIF(f[5], ''))::BIGINT AS "C1", ('0x' || NULLIF(f[6], ''))::BIGINT AS "C2",
  ('0x' || NULLIF(f[7], ''))::BIGINT AS "C3" FROM f"""
)
def src_nullable_int_csv(spark, sf_dir):
    header = INTEGER_HEADER.split(",")
    return parse_nullable_integers(integer_lines(spark, sf_dir), header, "bigint")[0]


@query(f"WITH {LI} SELECT CAST(id AS DOUBLE) AS id, i1, i2, i3, i4 FROM li")
def src_numeric_csv(spark, sf_dir):
    names = ["id", "i1", "i2", "i3", "i4"]
    lines = li(spark, sf_dir).select(csv_line(names).alias("line"))
    return parse_numbers(lines, names)


@query(
    """SELECT CAST(label AS DOUBLE) AS label,
  array_to_string([CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) FOR x IN embedding], ' ') AS millionths
FROM embeddings"""
)
def src_labeled_dense(spark, sf_dir):
    """Every feature, in millionths."""
    texts = F.transform("embedding", lambda x: x.cast("double").cast("string"))
    line = F.concat_ws(",", F.col("label").cast("double").cast("string"), texts)
    dense = parse_labelled_dense(table(spark, sf_dir, "embeddings").select(line.alias("line")))
    millionths = F.transform("features", lambda x: F.round(x * 1000000).cast("bigint").cast("string"))
    return dense.select("label", F.array_join(millionths, " ").alias("millionths"))


@query(
    """SELECT row_number() OVER (ORDER BY event_id) - 1 AS idx, CAST(user_id AS VARCHAR) AS members
FROM events"""
)
def range_indexed_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id")
    stored = store_in_order(rows, ["event_id"], "rows")
    numbered = number_rows(stored, ["event_id"], "idx")
    # An index has one row, so its list has one member.
    groups = numbered.groupBy("idx").agg(F.collect_list("user_id").alias("members"))
    members = F.transform("members", lambda m: m.cast("string"))
    return groups.select("idx", F.array_join(members, ",").alias("members"))


@query(
    f"""WITH {EV}, {counts("ev", EV_ROLES)},
mode AS (SELECT col, arg_max(value, (n, -value)) AS m FROM lc GROUP BY col),
mean AS (SELECT avg(i1) AS i1, avg(i2) AS i2, avg(i3) AS i3 FROM ev),
filled AS (SELECT id, CAST(ev.label AS DOUBLE) AS label, COALESCE(ev.i1, mean.i1) AS i1,
  COALESCE(ev.i2, mean.i2) AS i2, COALESCE(ev.i3, mean.i3) AS i3,
  COALESCE(c1, (SELECT m FROM mode WHERE col = 'c1')) AS c1,
  COALESCE(c2, (SELECT m FROM mode WHERE col = 'c2')) AS c2,
  COALESCE(c3, (SELECT m FROM mode WHERE col = 'c3')) AS c3 FROM ev, mean),
{cells("filled", EV_ROLES, "after")},
ix AS (SELECT pos, value, row_number() OVER (ORDER BY pos, value) - 1 AS idx
  FROM (SELECT DISTINCT pos, value FROM after))
SELECT f.id, f.label, round(i1, 6) AS i1, round(i2, 6) AS i2, round(i3, 6) AS i3,
  a.idx AS c1, b.idx AS c2, c.idx AS c3 FROM filled f
JOIN ix a ON a.pos = 5 AND a.value = f.c1 JOIN ix b ON b.pos = 6 AND b.value = f.c2
JOIN ix c ON c.pos = 7 AND c.value = f.c3"""
)
def state_roundtrip(spark, sf_dir):
    frame = ev(spark, sf_dir).drop("c3_hex")
    path = new_path(spark, "state")
    Stages([Impute(), IndexLevels()]).fit(frame, EV_ROLES).save(spark, path)
    filled = FittedStages.load(spark, path).transform(frame)
    return filled.withColumns({c: F.round(c, 6) for c in EV_ROLES.numeric})


_EV_TEXT = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'null')" for c in EV_ROLES.columns)


@query(f"WITH {EV} SELECT id, concat_ws(',', {_EV_TEXT}) AS line FROM ev")
def sink_csv_lines(spark, sf_dir):
    return ev(spark, sf_dir).select("id", csv_line(EV_ROLES.columns).alias("line"))


@query(
    f"""WITH {LI}, {counts("li", LI_ROLES)}
SELECT pos, value, concat_ws(',', pos, value) AS prefix, round(n1 / n, 6) AS rate FROM lc"""
)
def sink_rate_lines(spark, sf_dir):
    """Encoding table lines, split again into the exact prefix and the rate they print."""
    rates = fit_target_rates(li(spark, sf_dir), LI_ROLES).frame
    line = rate_line(F.col("pos"), F.col("value"), F.col("rate"))
    fields = rates.select("pos", "value", F.split(line, ",").alias("f"))
    return fields.select(
        "pos",
        "value",
        F.concat_ws(",", F.get("f", F.lit(0)), F.get("f", F.lit(1))).alias("prefix"),
        F.round(F.get("f", F.lit(2)).cast("double"), 6).alias("rate"),
    )


@query(
    f"""WITH {EV} SELECT id, (CASE WHEN label > 0 THEN '1.0' ELSE '-1.0' END) || ' ''' ||
  lower(to_hex(id)) || ' |Num ' || concat_ws(' ', 'i1:' || i1, 'i2:' || i2, 'i3:' || i3) ||
  ' |Cats ' || concat_ws(' ', '_' || c1, '_' || c2, '_' || c3) AS line FROM ev"""
)
def sink_vw(spark, sf_dir):
    return ev(spark, sf_dir).select("id", vw_line(EV_ROLES).alias("line"))


_INDEX = f"""{counts("li", LI_ROLES)},
ix AS (SELECT pos, col, value, row_number() OVER (ORDER BY pos, value) - 1 AS idx FROM lc)"""

_SPARSE_TEXT = f"""WITH {LI}, {_INDEX}
SELECT id, (CASE WHEN label > 0 THEN '1' ELSE '-1' END) || ' | ' || concat_ws(' ',
  '0:' || i1, '1:' || i2, '2:' || i3, '3:' || i4,
  (4 + a.idx) || CASE WHEN a.idx % 2 = 1 THEN ':1.0' ELSE ':-1.0' END,
  (4 + b.idx) || CASE WHEN b.idx % 2 = 1 THEN ':1.0' ELSE ':-1.0' END,
  (4 + c.idx) || CASE WHEN c.idx % 2 = 1 THEN ':1.0' ELSE ':-1.0' END) AS line FROM li
LEFT JOIN ix a ON a.col = 'c1' AND a.value = c1 LEFT JOIN ix b ON b.col = 'c2' AND b.value = c2
LEFT JOIN ix c ON c.col = 'c3' AND c.value = c3"""


def _assembled(spark, sf_dir):
    frame = li(spark, sf_dir)
    levels = LevelTable.keep(level_counts(frame, LI_ROLES, keep_missing=False))
    return assemble(index_levels(frame, LI_ROLES, levels.numbered()), LI_ROLES)


@query(_SPARSE_TEXT)
def sink_sparse_text(spark, sf_dir):
    line = sparse_line(F.col("label"), F.col("entries"))
    return _assembled(spark, sf_dir).select("id", line.alias("line"))


@query(
    f"""WITH {LI}, {_INDEX}
SELECT id, CAST(list_count([i1, i2, i3, i4, a.idx, b.idx, c.idx]) AS BIGINT) AS present,
  4 + a.idx AS slot_c1, 4 + b.idx AS slot_c2, 4 + c.idx AS slot_c3,
  round(COALESCE(i1, 0) + i2 + COALESCE(i3, 0) + i4 +
    CASE WHEN a.idx IS NULL THEN 0 WHEN a.idx % 2 = 1 THEN 1 ELSE -1 END +
    CASE WHEN b.idx % 2 = 1 THEN 1 ELSE -1 END +
    CASE WHEN c.idx % 2 = 1 THEN 1 ELSE -1 END, 6) AS total FROM li
LEFT JOIN ix a ON a.col = 'c1' AND a.value = c1 LEFT JOIN ix b ON b.col = 'c2' AND b.value = c2
LEFT JOIN ix c ON c.col = 'c3' AND c.value = c3"""
)
def assemble_sparse(spark, sf_dir):
    frame = _assembled(spark, sf_dir)
    slots = {f"slot_{c}": F.when(F.col(c) >= 0, F.col(c) + 4) for c in LI_ROLES.categorical}
    total = F.aggregate("entries", F.lit(0.0), lambda a, e: a + e["value"])
    return frame.select(
        "id",
        F.size("entries").cast("bigint").alias("present"),
        *[slot.alias(name) for name, slot in slots.items()],
        F.round(total, 6).alias("total"),
    )


@query(
    f"""{_TYPED_LINES_SQL} SELECT line, CASE WHEN ('0x' || substr(md5('100:' || line), 1, 8))::BIGINT
  % 10000 < 8500 THEN 1 ELSE 2 END AS part FROM lines"""
)
def split_lines(spark, sf_dir):
    """Lines without headers, split .85/.15 at random (seed 100)."""
    lines = without_headers(typed_lines(spark, sf_dir))
    return lines.withColumn("part", random_part(["line"], [0.85, 0.15], 100) + 1)


@query(f"WITH {LI} SELECT id, label, i2, i4, c2 FROM li")
def project_by_index(spark, sf_dir):
    return projection.project_by_index(li(spark, sf_dir), lambda i: i < 2 or i % 2 == 1)


@query(f"WITH {LI} SELECT id, i1, c3 FROM li")
def project_by_index_set(spark, sf_dir):
    return projection.project_by_index(li(spark, sf_dir), {0, 2, 8})


@query(f"WITH {LI} SELECT c3, id, i2 FROM li")
def project_by_reference(spark, sf_dir):
    return projection.project_by_reference(li(spark, sf_dir), ["c3", 0, "i2"])


@query(f"WITH {LI} SELECT c1, c2, c3 FROM li")
def project_by_kind(spark, sf_dir):
    return projection.project_by_kind(
        li(spark, sf_dir), LI_ROLES, lambda name, kind: kind == CATEGORICAL and name != "id"
    )


@query(f"WITH {LI} SELECT label, i3, c1 FROM li")
def project_by_name(spark, sf_dir):
    return projection.project_by_name(li(spark, sf_dir), {"c1", "label", "i3", "unknown"})


@query(f"WITH {LI} SELECT id, i1 * 2 AS twice, c2 * 10 + c3 AS mixed, label > 0 AS positive FROM li")
def row_map(spark, sf_dir):
    c = F.col
    return projection.map_rows(
        li(spark, sf_dir),
        {
            "id": c("id"),
            "twice": c("i1") * 2,
            "mixed": c("c2") * 10 + c("c3"),
            "positive": c("label") > 0,
        },
    )


@query(f"WITH {LI} SELECT id, label, i1, i2, i3, i4, c1 % 10 AS c1, c2 % 10 AS c2, c3 % 10 AS c3 FROM li")
def map_categorical(spark, sf_dir):
    return projection.map_categorical(li(spark, sf_dir), LI_ROLES, lambda v, _: v % 10)


@query(
    f"""WITH {LI} SELECT id, label, i1 / 2 AS i1, i2 / 2 AS i2, i3 / 2 AS i3, i4 / 2 AS i4,
  c1, c2, c3 FROM li"""
)
def map_numeric(spark, sf_dir):
    return projection.map_numeric(li(spark, sf_dir), LI_ROLES, lambda v, _: v / 2)


@query(
    f"""WITH {LI} SELECT id, label + 1.0::DOUBLE AS label, i1 + 1 AS i1, i2 + 1 AS i2, i3 + 1 AS i3,
  i4 + 1 AS i4, c1, c2, c3 FROM li"""
)
def map_numeric_and_label(spark, sf_dir):
    plus = lambda v, _: v + F.lit(1.0)
    return projection.map_numeric(li(spark, sf_dir), LI_ROLES, plus, with_label=True)


_PRESENT = " UNION ALL ".join(
    f"SELECT '{c}' AS col, count({c}) AS present, count(*) - count({c}) AS missing FROM li"
    for c in LI_ROLES.columns
)


@query(f"WITH {LI} {_PRESENT}")
def missing_counts(spark, sf_dir):
    return projection.missing_counts(li(spark, sf_dir), LI_ROLES)


@query(f"WITH {LI} SELECT id, label, i1, i2, i3, i4, c3 FROM li")
def project_low_cardinality(spark, sf_dir):
    """Numeric columns, and categorical columns of fewer than 8 levels."""
    frame = li(spark, sf_dir)
    levels = {r["col"]: r["levels"] for r in level_cardinality(frame, LI_ROLES).collect()}
    low = [c for c in LI_ROLES.categorical if levels.get(c, 0) < 8]
    return frame.select(*LI_ROLES.keep([*LI_ROLES.numeric, *low]).columns)


@query(f"WITH {EV} SELECT id, label, i1, i2, i3, c1, c2, c3 FROM ev ORDER BY id LIMIT 20")
def preview(spark, sf_dir):
    return projection.preview(ev(spark, sf_dir).drop("c3_hex"), 20, by="id")
