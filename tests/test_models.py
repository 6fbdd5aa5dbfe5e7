import math
import random

import pytest
from pyspark.sql import functions as F

from clickfeat import NaiveBayes, Roles
from clickfeat.functions.numeric import sigmoid
from clickfeat.models import batched, evaluation, logistic, sharded
from clickfeat.operators import assembling


@pytest.fixture(scope="module")
def labelled(spark):
    """Labels drawn from known weights over two features."""
    random.seed(11)
    rows = []
    for i in range(4000):
        a, b = random.uniform(-1, 1), random.uniform(-1, 1)
        p = 1 / (1 + math.exp(-(2.0 * a - 1.0 * b + 0.5)))
        rows.append((i, float(random.random() < p), a, b))
    df = spark.createDataFrame(rows, "id bigint, label double, a double, b double")
    dense = assembling.dense_features(df, ["a", "b"])
    return dense.withColumn("features", logistic.dense_vector(F.col("features")))


def test_training_recovers_weights_and_beats_the_base_rate(labelled):
    model = logistic.fit(labelled, logistic.SCALED)
    weights = logistic.coefficients(model, labelled, ["a", "b"]).collect()
    assert [r["feature"] for r in weights] == ["a", "b", "(intercept)"]
    assert [r["weight"] for r in weights] == pytest.approx([2.0, -1.0, 0.5], abs=0.25)
    scored = logistic.score(labelled, model)
    loss = scored.agg(evaluation.log_loss().alias("l")).first()["l"]
    base = labelled.agg(F.avg("label")).first()[0]
    assert loss < -base * math.log(base) - (1 - base) * math.log(1 - base)
    by_hand = logistic.probability(dict(zip("ab", model.coefficients)), model.intercept)
    gap = scored.agg(F.max(F.abs(F.col("p") - by_hand))).first()[0]
    assert gap < 1e-9
    assert scored.filter((F.col("p") > 0.5) != (F.col("p_class") == 1.0)).count() == 0


def test_sparse_vectors_train_like_dense_ones(labelled):
    entries = assembling.assemble_sparse(labelled, Roles("id", "label", ("a", "b"), ()))
    sparse = logistic.store_sparse(
        entries.select("label", logistic.sparse_fields(F.col("entries"), 2).alias("features"))
    )
    a, b = (logistic.fit(df, logistic.SCALED) for df in (labelled, sparse))
    assert list(a.coefficients) == pytest.approx(list(b.coefficients), abs=1e-6)


def test_weights_that_are_not_zero(labelled):
    model = logistic.fit(labelled, logistic.SCALED)
    rows = logistic.coefficients(model, labelled, lambda i: f"x{i}").collect()
    assert [r["feature"] for r in rows] == ["x0", "x1", "(intercept)"]


def test_repeated_holdout(labelled):
    losses = batched.repeated_holdout(labelled, "id", logistic.NUMBERS, repeats=2).collect()
    assert [r["seed"] for r in losses] == [1, 2]
    assert all(0.3 < r["test_loss"] < 0.69 for r in losses)


def test_log_loss_clamps(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "p double, label double")
    for eps in (1e-15, 1e-5):
        loss = df.agg(evaluation.log_loss(eps=eps)).first()[0]
        assert loss == pytest.approx((-math.log(eps) - math.log(1 - eps)) / 2)


@pytest.mark.parametrize("buckets", [None, 5])
def test_precision_recall(spark, buckets):
    rows = [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0), (0.1, 1), (None, 1)]
    df = spark.createDataFrame(rows, "p double, label int")
    curve = evaluation.precision_recall(df, buckets=buckets).orderBy("threshold").collect()
    assert [tuple(r) for r in curve] == [
        (0.1, 3 / 5, 1.0), (0.5, 2 / 3, 2 / 3), (0.9, 1 / 2, 1 / 3),
    ]


def test_precision_recall_without_positives(spark):
    df = spark.createDataFrame([(0.5, 0)], "p double, label int")
    assert [tuple(r) for r in evaluation.precision_recall(df).collect()] == [(0.5, 0.0, None)]


def test_naive_bayes_by_hand(spark):
    roles = Roles("id", "y", (), ("c1", "c2"))
    rows = [
        (1, 1.0, 5, 1), (2, 1.0, 5, 2), (3, 0.0, 5, 1), (4, 0.0, 6, None), (5, 0.0, 6, 1),
        (6, 0.0, 7, 1),
    ]
    df = spark.createDataFrame(rows, "id bigint, y double, c1 bigint, c2 bigint")
    model = NaiveBayes.fit(df, roles, pool_below=2)
    assert model.totals == (4, 2)
    assert model.pools == {"c1": (1, 0), "c2": (1, 1)}

    def product(one, zero):
        yes = math.prod(n / 2 for n in one) * 2 / 6
        no = math.prod(n / 4 for n in zero) * 4 / 6
        return yes / (yes + no)

    scores = {r["id"]: r["p"] for r in model.score(df).collect()}
    assert scores[1] == pytest.approx(product([2, 1], [1, 3]))
    assert scores[2] == pytest.approx(product([2, 1], [1, 1]))  # level 2 is pooled
    assert scores[4] == pytest.approx(product([1, 1], [2, 1]))  # 6 was never label 1: count 1
    shuffled = {r["id"]: r["p"] for r in model.score(df, broadcast_levels=0).collect()}
    assert shuffled == scores
    unseen = df.limit(1).withColumns({"c1": F.lit(99).cast("bigint"), "c2": F.lit(1).cast("bigint")})
    assert model.score(unseen).first()["p"] == pytest.approx(product([1, 1], [1, 3]))


def test_one_class_only(spark):
    roles = Roles("id", "y", (), ("c1",))
    df = spark.createDataFrame([(1, 0.0, 5), (2, 0.0, 6)], "id bigint, y double, c1 bigint")
    assert NaiveBayes.fit(df, roles).score(df).filter("p IS NULL").count() == 0


def test_sigmoid_saturates(spark):
    df = spark.createDataFrame([(-1000.0,), (0.0,), (1000.0,)], "m double")
    assert [r[0] for r in df.select(sigmoid(F.col("m"))).collect()] == [0.0, 0.5, 1.0]


ENTRIES = "array<struct<slot:bigint,value:double>>"
FAR = 30 + (1 << 27) - 1


@pytest.fixture(scope="module")
def spread(spark):
    """Rows with a numeric slot, and levels in slots at both ends of the hashed layout."""
    random.seed(3)
    rows = []
    for i in range(1500):
        x, level, rare = random.uniform(-1, 1), random.randrange(4), random.randrange(40)
        m = 1.5 * x + (level - 1.5) + 0.05 * (rare - 20)
        label = float(random.random() < 1 / (1 + math.exp(-m)))
        rows.append((label, [(0, x), (FAR - level, 1.0), (1000 + rare, 1.0)]))
    rows += [(1.0, []), (0.0, None)]
    return spark.createDataFrame(rows, f"label double, entries {ENTRIES}")


def _plain_newton(rows, slots, l2, intercept):
    """Weights by numpy on dense rows."""
    import numpy as np

    at = {s: i for i, s in enumerate(slots)}
    x = np.zeros((len(rows), len(slots)))
    for i, r in enumerate(rows):
        for e in r["entries"] or []:
            x[i, at[e["slot"]]] += e["value"]
    if intercept:
        x[:, at[sharded.INTERCEPT]] = 1
    y = np.array([r["label"] for r in rows])
    penalty = np.array([0.0 if s == sharded.INTERCEPT else l2 for s in slots])
    w = np.zeros(len(slots))
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) / len(y) + penalty * w
        curve = (x.T * (p * (1 - p))) @ x / len(y) + np.diag(penalty)
        w -= np.linalg.solve(curve, slope)
    return dict(zip(slots, w)), x @ w


@pytest.mark.parametrize("hot_share", [0.2, 2.0])  # some slots are hot, none
def test_sharded_weights_equal_newtons(spread, hot_share):
    """With a penalty and an intercept, whose weight is not penalised."""
    training = logistic.Training(intercept=True, iterations=25, l2=0.01, tolerance=1e-9)
    model = sharded.fit(spread, training, FAR + 1, hot_share=hot_share)
    rows = spread.collect()
    slots = sorted({e["slot"] for r in rows for e in r["entries"] or []} | {sharded.INTERCEPT})
    want, margins = _plain_newton(rows, slots, 0.01, True)
    got = {r["slot"]: r["weight"] for r in model.weights.collect()}
    assert got == pytest.approx(want, abs=2e-4)
    assert model.losses == sorted(model.losses, reverse=True) and model.numFeatures == FAR + 1
    scored = sharded.score(spread, model, hot_share=max(hot_share, 0.01)).collect()
    by_row = {str(r["entries"]): r["p"] for r in scored}
    for r, m in zip(rows, margins):
        assert by_row[str(r["entries"])] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-3)
    assert all((r["p"] > 0.5) == (r["p_class"] == 1.0) for r in scored)


def test_sharded_training_of_odd_tables(spark, spread):
    few = logistic.Training(intercept=False, iterations=6)
    none = sharded.fit(spread.limit(0), few, 100)
    assert none.weights.count() == 0 and none.losses == []
    assert {r["p"] for r in sharded.score(spread, none).select("p").distinct().collect()} == {0.5}
    empty = spark.createDataFrame([(1.0, []), (0.0, None)], f"label double, entries {ENTRIES}")
    assert sharded.fit(empty, few, 100).weights.count() == 0
    # Equal slots of a row add up, zeros teach nothing, and one class only drives weights up, not to infinity.
    odd = spark.createDataFrame([(1.0, [(7, 1.0), (7, 1.0), (8, 0.0)])] * 5, f"label double, entries {ENTRIES}")
    weights = {r["slot"]: r["weight"] for r in sharded.fit(odd, few, 100).weights.collect()}
    assert weights[8] == 0 and 0.5 < weights[7] < 100
    unseen = spark.createDataFrame([(1.0, [(99, 5.0)])], f"label double, entries {ENTRIES}")
    assert sharded.score(unseen, none).first()["p"] == 0.5


def test_batched_training_equals_one_by_one(labelled):
    """Subsets of any size, one of them empty; dense and sparse rows mixed; a penalty."""
    import numpy as np

    training = logistic.Training(intercept=True, iterations=100, l2=0.02, tolerance=1e-12)
    subsets = [F.col("id") % 3 == 0, F.col("id") < 2000, F.lit(False), F.lit(None).cast("boolean")]
    dense = labelled.select("label", "features", "id")
    entries = assembling.assemble_sparse(labelled, Roles("id", "label", ("a", "b"), ()))
    sparse = logistic.store_sparse(
        entries.select("label", logistic.sparse_fields(F.col("entries"), 2).alias("features"), "id")
    )
    mixed = dense.filter("id % 2 = 0").unionByName(sparse.filter("id % 2 = 1"))
    rows = batched.store_rows(mixed, subsets)
    weights = batched.fit_many(rows, training)
    for at, subset in enumerate(subsets[:2]):
        model = logistic.fit(dense.filter(subset), training)
        assert weights[at] == pytest.approx([*model.coefficients, model.intercept], abs=1e-4)
    assert not weights[2:].any()
    losses = batched.log_losses(rows, weights, True, 1e-5)
    model = logistic.fit(dense.filter(subsets[0]), training)
    for part, got in zip((subsets[0], ~subsets[0]), losses[0]):
        scored = logistic.score(dense.filter(part), model)
        assert got == pytest.approx(scored.agg(evaluation.log_loss(eps=1e-5)).first()[0], abs=1e-6)
    assert losses[2][0] is None and losses[2][1] == pytest.approx(np.log(2))
    rows.drop()


def test_scans_do_not_grow_with_the_seeds(labelled, monkeypatch):
    passes = []
    real = batched._pass
    monkeypatch.setattr(batched, "_pass", lambda *a: passes.append(1) or real(*a))
    counts = []
    for repeats in (1, 6):
        passes.clear()
        batched.repeated_holdout(labelled, "id", logistic.SCALED, repeats=repeats)
        counts.append(len(passes))
    assert counts[1] <= counts[0] + 5


def test_stored_vectors_have_the_form_that_is_read(spark):
    """Batched training and sparse storing rely on how Spark stores vectors."""
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    assert T.StructType(VectorUDT.sqlType().fields).simpleString() == batched.STORED_VECTOR


def test_holdout_of_narrow_vectors_takes_few_passes_over_few_records(labelled, monkeypatch):
    """To full precision; a pass must not hand rows to Python one by one."""
    passes, made = [], []
    real, store = batched._pass, batched.store_rows
    monkeypatch.setattr(batched, "_pass", lambda *a: passes.append(1) or real(*a))
    monkeypatch.setattr(batched, "store_rows", lambda *a: made.append(store(*a)) or made[0])
    monkeypatch.setattr(batched.Rows, "drop", lambda rows: None)
    training = logistic.Training(intercept=True, iterations=500, tolerance=1e-12)
    batched.repeated_holdout(labelled, "id", training, repeats=3)
    assert len(passes) <= 10
    assert made[0].frame.count() < labelled.count() / 100


@pytest.mark.parametrize("narrow", [0, 32])
def test_batched_training_of_odd_vectors(spark, monkeypatch, narrow):
    """A column of zeros, two equal columns, one class only; blocks of several sizes and vectors without entries."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    monkeypatch.setattr(batched, "NARROW", narrow)
    monkeypatch.setattr(batched, "BLOCK_VALUES", 50)
    random.seed(5)
    rows = []
    for i in range(300):
        a = random.uniform(-1, 1)
        y = float(random.random() < 1 / (1 + math.exp(-2 * a)))
        dense = i % 3 or i < 100
        rows.append((i, y, Vectors.dense([a, 0.0, a]) if dense else Vectors.sparse(3, {0: a, 2: a})))
    rows.append((300, 1.0, Vectors.sparse(3, {})))
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    stored = batched.store_rows(df, [F.lit(True), F.col("label") == 1.0])
    training = logistic.Training(intercept=True, iterations=60, tolerance=1e-13)
    weights = batched.fit_many(stored, training)
    assert stored.width == 3 and weights[0][1] == 0
    assert weights[0][0] == pytest.approx(weights[0][2], abs=1e-5)
    x = np.array([[r[2].toArray()[0], 1.0] for r in rows])
    gap = 1 / (1 + np.exp(-x @ [weights[0][0] + weights[0][2], weights[0][3]])) - [r[1] for r in rows]
    assert x.T @ gap / len(rows) == pytest.approx([0, 0], abs=1e-6)
    own, _ = batched.log_losses(stored, weights, True, 1e-15)[1]
    assert np.isfinite(weights).all() and own < 1e-6
    stored.drop()


def test_sharded_rows_are_packed_into_blocks(spark, spread):
    """Iterations must not move a record for each entry. Rows without a label are left out."""
    rows = spread.select("label", "entries").unionByName(spread.limit(1).selectExpr("CAST(NULL AS double) AS label", "entries"))
    rows = rows.selectExpr("label AS y", f"coalesce(entries, CAST(array() AS {ENTRIES})) AS entries").coalesce(1)
    blocks = rows.mapInArrow(sharded._blocked(sharded.np.array([0, FAR]), 400), sharded._BLOCK).collect()
    y = [v for b in blocks for v in sharded._array(bytes(b["y"]))]
    assert 4 <= len(blocks) <= 8 and len(y) == spread.count()
    found = []
    for b in blocks:
        assert b["slots"] == sorted(set(b["slots"])) and not {0, FAR} & set(b["slots"])
        found += [b["slots"][i] for i in sharded._array(bytes(b["at"]))]
    want = [e["slot"] for r in spread.collect() for e in r["entries"] or [] if e["slot"] not in (0, FAR)]
    assert sorted(found) == sorted(want)


def test_sharded_iterations_move_a_record_for_each_block_and_part(spark, spread, monkeypatch):
    """Not one for each slot of a block; weights don't depend on how rows and slots are cut, or which slots are hot."""
    training = logistic.Training(intercept=True, iterations=8, l2=0.01)
    unlabelled = spark.createDataFrame([(None, [(7, 1.0), (0, 0.5)])], f"label double, entries {ENTRIES}")
    rows = spread.unionByName(unlabelled).coalesce(2)
    want = {r["slot"]: r["weight"] for r in sharded.fit(rows, training, FAR + 1).weights.collect()}
    assert want[7] == 0

    found = {}
    linked = sharded._linked

    def seen(packed, *rest):
        made = linked(packed, *rest)
        found["pairs"] = [(r["part"], r["block"]) for r in made.links.select("part", "block").collect()]
        found["links"] = made.links.selectExpr("sum(length(at)) / 4 AS n").first()["n"]
        found["slots"] = packed.selectExpr("sum(size(slots) + size(hot_slots)) AS n").first()["n"]
        state = made.state.selectExpr("count(*) AS parts", "sum(length(slots)) / 8 AS slots").first()
        found["parts"], found["distinct"] = state["parts"], state["slots"]
        return made

    monkeypatch.setattr(sharded, "_linked", seen)
    for name, value in (("BLOCK_ROWS", 200), ("PART_LINKS", 20), ("HOT_ROWS", 3)):
        monkeypatch.setattr(sharded, name, value)
    got = {r["slot"]: r["weight"] for r in sharded.fit(rows, training, FAR + 1, hot_share=0.5).weights.collect()}
    assert got == pytest.approx(want, abs=1e-9)
    blocks = {b for _, b in found["pairs"]}
    assert 8 <= len(blocks) <= 10 and len(set(found["pairs"])) == len(found["pairs"]) < found["slots"]
    assert found["links"] == found["slots"] and found["distinct"] == len(want)
    assert found["parts"] == -(-found["slots"] // 20)
