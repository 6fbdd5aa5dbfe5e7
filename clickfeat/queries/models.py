"""Models and their evaluation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from clickfeat.functions.numeric import recode_label
from clickfeat.models import batched, curves, evaluation, logistic, sharded
from clickfeat.models.bayes import NaiveBayes, scores_above
from clickfeat.operators import assembling, scaling, summary
from clickfeat.operators.levels import LevelTable, level_counts
from clickfeat.queries.frames import LI, LI_ROLES, counts, li, query, rounded, table
from clickfeat.roles import Roles

# Fixed weights for the scoring queries.
WEIGHTS = {"i2": 0.00001, "i4": -3.5, "c3": 0.05}
INTERCEPT = -1.25

_P = "1 / (1 + exp(-(-1.25 + i2 * 0.00001 + i4 * -3.5 + c3 * 0.05)))"
_SCORED = f"WITH {LI}, s AS (SELECT id, label, {_P} AS p FROM li)"


def _scored(spark, sf_dir):
    p = logistic.probability(WEIGHTS, INTERCEPT)
    return li(spark, sf_dir).select("id", "label", p.alias("p"))


@query(f"{_SCORED} SELECT id, label, round(p, 6) AS p FROM s")
def logreg_score(spark, sf_dir):
    return rounded(_scored(spark, sf_dir), "p")


@query(
    f"""{_SCORED} SELECT id, label, CASE WHEN p > 0.3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS class
FROM s"""
)
def logreg_class(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return scored.select("id", "label", logistic.hard_class(F.col("p"), 0.3).alias("class"))


def _loss_sql(eps: str) -> str:
    p = f"least(greatest(p, {eps}), 1 - {eps})"
    return f"avg(-label * ln({p}) - (1 - label) * ln(1 - {p}))"


@query(
    f"""{_SCORED}, x AS (SELECT label, CASE WHEN id % 97 = 0 THEN 0.0 WHEN id % 89 = 0 THEN 1.0
  ELSE p END AS p FROM s)
SELECT round({_loss_sql('1e-15')}, 6) AS fine, round({_loss_sql('1e-5')}, 6) AS coarse,
  count(*) AS n FROM x"""
)
def log_loss(spark, sf_dir):
    """Both clamps, with some certain (0 and 1) scores among them."""
    certain = F.when(F.col("id") % 97 == 0, 0.0).when(F.col("id") % 89 == 0, 1.0)
    scored = _scored(spark, sf_dir).withColumn("p", certain.otherwise(F.col("p")))
    losses = scored.agg(
        evaluation.log_loss().alias("fine"),
        evaluation.log_loss(eps=1e-5).alias("coarse"),
        F.count(F.lit(1)).alias("n"),
    )
    return rounded(losses, "fine", "coarse")


@query(
    f"""WITH {LI}, c AS (SELECT i2 / 200000 AS threshold, count(*) AS n, sum(label) AS hits
  FROM li GROUP BY 1),
r AS (SELECT threshold, sum(n) OVER (ORDER BY threshold DESC) AS taken,
  sum(hits) OVER (ORDER BY threshold DESC) AS found FROM c)
SELECT threshold, round(found / taken, 6) AS precision,
  round(found / (SELECT sum(label) FROM li), 6) AS recall FROM r"""
)
def precision_recall_curve(spark, sf_dir):
    """A continuous score: about as many thresholds as rows."""
    scored = li(spark, sf_dir).select("label", (F.col("i2") / 200000).alias("p"))
    return rounded(evaluation.precision_recall(scored), "precision", "recall")


@query(
    f"""WITH {LI}, s AS (SELECT i2 / 200000 AS p, label, row_number() OVER (ORDER BY i2 DESC) AS rank,
  count(*) OVER () AS n FROM li),
t AS (SELECT DISTINCT p AS threshold FROM s
  WHERE rank IN (SELECT (i * n + 49) // 50 FROM (SELECT unnest(range(1, 51)) AS i, (SELECT count(*) FROM li) AS n)))
SELECT threshold, count(*) AS taken, round(avg(label), 6) AS precision,
  round(sum(label) / (SELECT sum(label) FROM li), 6) AS recall
FROM t JOIN s ON p >= threshold GROUP BY threshold"""
)
def precision_recall_points(spark, sf_dir):
    """The same at the scores of 50 evenly spaced ranks."""
    scored = li(spark, sf_dir).select("label", (F.col("i2") / 200000).alias("p"))
    return rounded(curves.precision_recall_at(scored, 50), "precision", "recall")


@query(
    f"""{_SCORED}, c AS (SELECT CASE WHEN p > 0.3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS threshold,
  label FROM s), g AS (SELECT threshold, count(*) AS n, sum(label) AS hits FROM c GROUP BY 1),
r AS (SELECT threshold, sum(n) OVER (ORDER BY threshold DESC) AS taken,
  sum(hits) OVER (ORDER BY threshold DESC) AS found FROM g)
SELECT threshold, round(found / taken, 6) AS precision,
  round(found / (SELECT sum(label) FROM li), 6) AS recall FROM r"""
)
def precision_recall_hard(spark, sf_dir):
    """Hard 0/1 predictions: two thresholds."""
    scored = _scored(spark, sf_dir)
    hard = scored.select("label", logistic.hard_class(F.col("p"), 0.3).alias("p"))
    return rounded(evaluation.precision_recall(hard), "precision", "recall")


def _bayes_column(c: str) -> str:
    n1, n0 = (
        f"greatest(COALESCE(m_{c}.n{k}, (SELECT n{k} FROM pooled WHERE col = '{c}' AND value IS NULL),"
        " 0), 1)"
        for k in (1, 0)
    )
    return f"({n1} / t.n1) AS f1_{c}, ({n0} / t.n0) AS f0_{c}"


_BAYES = f"""WITH {LI}, {counts("li", LI_ROLES, missing=True)},
pooled AS (SELECT col, CASE WHEN n0 + n1 >= 30 THEN value END AS value, sum(n0) AS n0,
  sum(n1) AS n1 FROM lc GROUP BY 1, 2),
t AS (SELECT CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n0,
  CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS n1 FROM li),
f AS (SELECT id, t.n1 AS t1, t.n0 AS t0, {', '.join(_bayes_column(c) for c in LI_ROLES.categorical)}
  FROM t, li {' '.join(
      f"LEFT JOIN pooled m_{c} ON m_{c}.col = '{c}' AND m_{c}.value = li.{c}"
      for c in LI_ROLES.categorical)}),
g AS (SELECT id, f1_c1 * f1_c2 * f1_c3 * t1 / (t1 + t0) AS yes,
  f0_c1 * f0_c2 * f0_c3 * t0 / (t1 + t0) AS no FROM f),
scored AS (SELECT id, yes / (yes + no) AS p FROM g)"""


@query(f"{_BAYES} SELECT id, round(p, 6) AS p FROM scored")
def nb_score(spark, sf_dir):
    frame = li(spark, sf_dir)
    scored = NaiveBayes.fit(frame, LI_ROLES, pool_below=30).score(frame)
    return rounded(scored.select("id", "p"), "p")


@query(f"{_BAYES} SELECT id, round(p, 6) AS p FROM scored")
def nb_score_shuffled(spark, sf_dir):
    """No column within the broadcast budget: all share one lookup."""
    frame = li(spark, sf_dir)
    model = NaiveBayes.fit(frame, LI_ROLES, pool_below=30)
    return rounded(model.score(frame, broadcast_levels=0).select("id", "p"), "p")


@query(f"{_BAYES} SELECT id, round(p, 6) AS p FROM scored WHERE p > 0.35")
def nb_scores_above(spark, sf_dir):
    frame = li(spark, sf_dir)
    scored = NaiveBayes.fit(frame, LI_ROLES, pool_below=30).score(frame)
    return rounded(scores_above(scored.select("id", "p"), 0.35), "p")


def _dense(spark, sf_dir):
    frame = li(spark, sf_dir)
    bounds = summary.bounds_of(frame, LI_ROLES.numeric)
    scaled = scaling.scale_minmax_filled(frame, bounds)
    dense = assembling.dense_features(scaled, LI_ROLES.numeric)
    return dense.select("id", "label", logistic.dense_vector(F.col("features")).alias("features"))


EXACT = 1e-12


def _newton(features: int, x: str, steps: int = 12) -> str:
    """CTEs that train on rows ``part, y, x0, x1, ...``: ``fitted`` has the weights of each part.

    Newton's method, its equations solved by elimination, one nested query for each pivot.
    """
    n = range(features)
    weights = ", ".join(f"w{i}" for i in n)
    margin = " + ".join(f"w{i} * x{i}" for i in n)
    sums = ", ".join(
        [f"sum(p * (1 - p) * x{i} * x{j}) AS h{i}_{j}" for i in n for j in n]
        + [f"sum((y - p) * x{i}) AS g{i}" for i in n]
    )
    solved = f"""SELECT part, k, {weights}, {sums} FROM (
      SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM step JOIN x USING (part) WHERE k < {steps})
    GROUP BY part, k, {weights}"""
    for pivot in n:
        rows = [
            f"h{i}_{j} - h{i}_{pivot} * h{pivot}_{j} / h{pivot}_{pivot} AS h{i}_{j}"
            if i != pivot else f"h{i}_{j}"
            for i in n for j in n
        ]
        rows += [
            f"g{i} - h{i}_{pivot} * g{pivot} / h{pivot}_{pivot} AS g{i}" if i != pivot else f"g{i}"
            for i in n
        ]
        solved = f"SELECT part, k, {weights}, {', '.join(rows)} FROM ({solved})"
    moved = ", ".join(f"w{i} + g{i} / h{i}_{i}" for i in n)
    zeros = ", ".join(f"0.0::DOUBLE AS w{i}" for i in n)
    return f"""x AS ({x}),
step AS (SELECT DISTINCT part, 0 AS k, {zeros} FROM x
  UNION ALL SELECT part, k + 1, {moved} FROM ({solved})),
fitted AS (SELECT * FROM step WHERE k = {steps})"""


_BOUNDS = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LI_ROLES.numeric)
_SCALED = ", ".join(
    f"(COALESCE({c}, 0) - lo_{c}) / (hi_{c} - lo_{c}) AS x{i}" for i, c in enumerate(LI_ROLES.numeric)
)
_SCALED_LI = f"""scaled AS (SELECT id, label AS y, c3, {_SCALED}, 1.0::DOUBLE AS x4
  FROM li, (SELECT {_BOUNDS} FROM li))"""


@query(
    f"""WITH RECURSIVE {LI}, {_SCALED_LI},
{_newton(5, "SELECT 0 AS part, * FROM scaled")}
"""
    + " UNION ALL ".join(
        f"SELECT '{name}' AS feature, round(w{i}, 4) AS weight FROM fitted"
        for i, name in enumerate((*LI_ROLES.numeric, "(intercept)"))
    )
)
def logreg_fit(spark, sf_dir):
    """Weights on the scaled numeric features."""
    rows = _dense(spark, sf_dir)
    model = logistic.fit(rows, replace(logistic.SCALED, tolerance=EXACT))
    return rounded(logistic.coefficients(model, rows, LI_ROLES.numeric), "weight", digits=4)


def _hashed(spark, sf_dir, training, roles):
    """Weights on numeric and hashed level features of the whole layout, as a table by slot."""
    frame = li(spark, sf_dir)
    scaled = scaling.scale_minmax_filled(frame, summary.bounds_of(frame, roles.numeric))
    entries = assembling.hash_features(scaled, roles)
    width = assembling.HASH_BASE + (1 << assembling.HASH_BITS)
    return sharded.fit(entries, training, width).coefficients()


@query()
def logreg_fit_hashed(spark, sf_dir):
    """All features: many levels are rare, so that weights have no closed form and go on growing."""
    return _hashed(spark, sf_dir, logistic.HASHED, LI_ROLES).filter("feature <> '(intercept)'")


_LINES = range(1, 8)
_SLOTS = [*range(4), *(30 + (line + 4) for line in _LINES)]


@query(
    f"""WITH RECURSIVE {LI}, {_SCALED_LI},
{_newton(11, "SELECT 0 AS part, y, x0, x1, x2, x3, "
         + ", ".join(f"CAST(c3 = {line} AS DOUBLE) AS x{3 + line}" for line in _LINES)
         + " FROM scaled")}
"""
    + " UNION ALL ".join(
        f"SELECT 'slot_{slot}' AS feature, round(w{i}, 3) AS weight FROM fitted"
        for i, slot in enumerate(_SLOTS)
    )
)
def logreg_fit_sharded(spark, sf_dir):
    """Weights by slot of the whole hashed layout, on the numeric features and the levels of one column."""
    roles = Roles("id", "label", LI_ROLES.numeric, ("c3",))
    weights = _hashed(spark, sf_dir, replace(logistic.HASHED, tolerance=EXACT), roles)
    return rounded(weights, "weight", digits=3)


@query(
    """WITH RECURSIVE x AS (SELECT row_number() OVER () AS r, CAST(label > 4 AS DOUBLE) AS y,
  list_append(CAST(embedding AS DOUBLE[]), 1.0::DOUBLE) AS v FROM embeddings),
e AS (SELECT r, y, unnest(v) AS value, generate_subscripts(v, 1) AS i FROM x),
q AS (SELECT i, sum(value * value) / 4 AS q FROM e GROUP BY i),
step AS (SELECT 0 AS k, (SELECT list(0.0::DOUBLE) FROM q) AS w
  UNION ALL SELECT k, list(moved ORDER BY i) FROM (
    SELECT k + 1 AS k, i, any_value(w[i]) + sum((e.y - p) * value) / any_value(q) AS moved
    FROM (SELECT k, w, r, 1 / (1 + exp(-list_dot_product(w, v))) AS p FROM step, x WHERE k < 80)
    JOIN e USING (r) JOIN q USING (i) GROUP BY k, i) GROUP BY k),
fitted AS (SELECT unnest(w) AS weight, generate_subscripts(w, 1) AS i FROM step WHERE k = 80)
SELECT CASE WHEN i = (SELECT max(i) FROM q) THEN '(intercept)' ELSE 'x' || (i - 1) END AS feature,
  round(weight, 4) AS weight FROM fitted"""
)
def logreg_fit_dense(spark, sf_dir):
    """Weights on labelled dense vectors: the upper half of the label values against the lower."""
    labelled = table(spark, sf_dir, "embeddings").select(
        recode_label(F.col("label"), F.col("label") > 4, 1.0, 0.0).alias("label"),
        logistic.dense_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    model = logistic.fit(labelled, replace(logistic.DENSE, tolerance=EXACT))
    names = [f"x{i}" for i in range(model.numFeatures)]
    return rounded(logistic.coefficients(model, labelled, names), "weight", digits=4)


_FITTED_P = "1 / (1 + exp(-(w0 * x0 + w1 * x1 + w2 * x2 + w3 * x3 + w4 * x4)))"
_CLAMPED = f"least(greatest({_FITTED_P}, 1e-5), 1 - 1e-5)"


@query(
    f"""WITH RECURSIVE {LI}, {_SCALED_LI},
split AS (SELECT seed AS part, scaled.*,
  ('0x' || substr(md5(seed || ':' || id), 1, 8))::BIGINT % 10000 < 7500 AS train
  FROM scaled, (SELECT unnest([1, 2, 3]) AS seed)),
{_newton(5, "SELECT * FROM split WHERE train")},
losses AS (SELECT part, train, -y * ln({_CLAMPED}) - (1 - y) * ln(1 - {_CLAMPED}) AS loss
  FROM split JOIN fitted USING (part))
SELECT CAST(part AS INTEGER) AS seed, round(avg(loss) FILTER (WHERE train), 6) AS train_loss,
  round(avg(loss) FILTER (WHERE NOT train), 6) AS test_loss FROM losses GROUP BY part"""
)
def repeated_holdout(spark, sf_dir):
    """Log loss of three hold-out splits, on both parts, trained side by side."""
    training = replace(logistic.SCALED, tolerance=EXACT)
    losses = batched.repeated_holdout(_dense(spark, sf_dir), "id", training, repeats=3)
    return rounded(losses, "train_loss", "test_loss")


def _optimal(rows, training, names):
    """Whether the gradient vanishes, for every weight that is trained."""
    model = logistic.fit(rows, training)
    slopes = logistic.gradient(rows, model, names)
    if not training.intercept:
        slopes = slopes.filter("feature <> '(intercept)'")
    return slopes.select("feature", (F.abs("gradient") < 1e-5).alias("optimal"))


@query("SELECT unnest(['i1', 'i2', 'i3', 'i4', '(intercept)']) AS feature, TRUE AS optimal")
def logreg_optimal(spark, sf_dir):
    """The weights on the scaled numeric features are a minimum of the loss."""
    training = replace(logistic.SCALED, tolerance=EXACT)
    return _optimal(_dense(spark, sf_dir), training, LI_ROLES.numeric)


@query(
    f"""WITH {LI} SELECT 'c3=' || c3 AS feature,
  round(ln(sum(label) / (count(*) - sum(label))), 3) AS weight FROM li GROUP BY c3"""
)
def logreg_fit_onehot(spark, sf_dir):
    """Weights on one-hot levels without intercept: the log-odds of each level."""
    roles = Roles("id", "label", (), ("c3",))
    frame = li(spark, sf_dir).select("id", "label", "c3")
    dictionary = LevelTable.keep(level_counts(frame, roles, keep_missing=False)).numbered(
        per_column=True
    )
    entries = assembling.assemble_onehot(frame, roles, dictionary)
    width = dictionary.rows["c3"]
    rows = logistic.store_sparse(
        entries.select("label", logistic.sparse_fields(F.col("entries"), width).alias("features"))
    )
    model = logistic.fit(rows, replace(logistic.NUMBERS, tolerance=EXACT))
    names = dictionary.frame.filter("col = 'c3'").select("value", "idx").orderBy("idx").collect()
    weights = logistic.coefficients(model, rows, [f"c3={r['value']}" for r in names])
    return rounded(weights.filter("feature <> '(intercept)'"), "weight", digits=3)
