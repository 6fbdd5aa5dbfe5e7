"""The factorisation machine against all pairs, numeric slopes and held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import CLASHING, SMALL

from clickfeat.llm import quality_classifier as qc

LABELS = "doc_id bigint, quality int, score double"


def some_rows(seed=0, n=9, slots=40):
    rng = np.random.default_rng(seed)
    vectors = []
    for _ in range(n):
        at = np.sort(rng.choice(slots, rng.integers(1, 8), replace=False))
        vectors.append((at.astype(np.int64), rng.normal(0, 1, len(at))))
    machine = qc.Machine(0.3, slots, 4)
    machine.weights = rng.normal(0, 1, slots)
    machine.factors = rng.normal(0, 1, (slots, 4))
    return vectors, machine, rng.random(n)


def all_pairs(machine, slots, values):
    total = machine.bias + sum(machine.weights[s] * x for s, x in zip(slots, values))
    for i in range(len(slots)):
        for j in range(i):
            total += machine.factors[slots[i]] @ machine.factors[slots[j]] * values[i] * values[j]
    return total


def test_identity_equals_all_pairs():
    vectors, machine, _ = some_rows()
    margins = machine.margins(qc.Rows.of(vectors))[0]
    assert margins == pytest.approx([all_pairs(machine, *v) for v in vectors])


def test_gradient_equals_numeric_slopes():
    vectors, machine, labels = some_rows(4)
    rows = qc.Rows.of(vectors)

    def loss():
        p = machine.scores(rows)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    by_bias, slots, by_weight, by_factor = machine.gradient(rows, labels)
    step = 1e-6

    def slope(array, at):
        array[at] += step
        up = loss()
        array[at] -= 2 * step
        down = loss()
        array[at] += step
        return (up - down) / (2 * step)

    for k, slot in enumerate(slots):
        assert by_weight[k] == pytest.approx(slope(machine.weights, slot), abs=1e-6)
        for f in range(4):
            assert by_factor[k, f] == pytest.approx(slope(machine.factors, (slot, f)), abs=1e-6)
    assert by_bias == pytest.approx((machine.scores(rows) - labels).mean())


def test_rows_are_taken_whole():
    vectors, _, _ = some_rows(2)
    taken = qc.Rows.of(vectors).take(np.array([3, 0, 3]))
    want = qc.Rows.of([vectors[3], vectors[0], vectors[3]])
    assert (taken.starts == want.starts).all() and (taken.values == want.values).all()


def test_machine_learns_what_no_single_word_tells():
    """Labels are the exclusive-or of two words: a linear score can't separate them."""
    texts = ["a", "b", "a b", "c"] * 60
    labels = np.array([1.0, 1.0, 0.0, 0.0] * 60)
    rows = qc.Rows.of([qc.features(t, {}) for t in texts])
    p = qc.Machine().fit(rows, labels, epochs=60).scores(rows)
    assert ((p > 0.5) == (labels > 0.5)).all()


def test_held_out_documents(spark):
    folder = SMALL.parent / "sf0.01"
    if not folder.exists():
        pytest.skip("test tables are absent")
    scored = qc.op13_quality_classifier(spark, str(folder)).filter("held_out")
    labels = spark.read.parquet(str(folder / "labels.parquet"))
    rows = scored.join(labels, "doc_id").select("score", "predicted", "quality").collect()
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([s >= qc.GOOD for s in good]) >= 0.98
    assert np.mean([s < qc.GOOD for s in bad]) >= 0.8
    assert np.mean([g > b for g in good for b in bad]) >= 0.99


def test_fit_does_not_depend_on_partitions_and_sample_is_bounded(spark, small):
    docs, labels = small("documents").select("doc_id", "text"), small("labels")
    one = qc.train(docs.coalesce(1), labels, "quality", epochs=1)
    many = qc.train(docs.repartition(6), labels.repartition(3), "quality", epochs=1)
    assert one.bias == many.bias and (one.factors == many.factors).all()
    few = qc.train(docs, labels, "quality", sample=20, epochs=1)
    assert 0 < np.count_nonzero(few.weights) < np.count_nonzero(one.weights)


def test_odd_rows(spark, documents):
    """Nulls, empty and long texts, repeated rows and ids, labels that are null, repeated or out of range."""
    rows = [
        (1, "good words here"), (1, "good words here"), (1, "other text"), (2, None), (3, ""), (None, "x"),
        (4, "# $ % & | <"), (5, "long word " * 200_000), (6, "ünï\x00cødé"),
    ]
    docs = documents(rows).withColumn("score", F.lit("taken"))
    labels = spark.createDataFrame(
        [(1, 1, 0.0), (1, 0, 0.0), (2, 0, 0.0), (3, None, 0.0), (4, -7, 0.0), (None, 1, 0.0), (6, 9, 0.0)], LABELS
    )
    machine = qc.train(docs, labels, "quality", metadata=("n_chars",))
    got = qc.score(docs, machine, metadata=("n_chars",), name="made").collect()
    assert len(got) == len(rows) and all(0 <= r["made"] <= 1 for r in got)
    assert got[0]["made"] == got[1]["made"] and got[0]["score"] == "taken"
    assert all(got[0][c] == v for c, v in CLASHING.items())
    assert got[3]["made"] is not None


def test_tables_without_labels_or_rows(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    machine = qc.train(docs, none, "quality")
    assert [r["score"] for r in qc.score(docs, machine).collect()] == pytest.approx([0.5, 0.5], abs=0.1)
    assert qc.score(documents([]), machine).count() == 0
    one = spark.createDataFrame([(1, 1, 0.0), (2, 1, 0.0)], LABELS)
    assert all(r["score"] > 0.5 for r in qc.score(docs, qc.train(docs, one, "quality")).collect())


def test_metadata_may_be_strings_and_missing():
    kinds = [None, "x", 3, -2.5, float("nan"), float("inf"), True]
    seen = {tuple(qc.features("a", {"m": k})[0]) for k in kinds}
    assert len(seen) == len(kinds)
