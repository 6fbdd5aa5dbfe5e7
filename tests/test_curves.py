"""The curve at chosen points against sorting."""

import math
import random

import numpy as np
import pytest

from clickfeat.models import curves


def test_keys_keep_the_order():
    scores = np.array([-math.inf, -1e300, -1.0, -5e-324, -0.0, 0.0, 5e-324, 0.1, 1.0, math.inf, math.nan])
    keys = curves.keys_of(scores)
    assert (np.diff(keys.astype(object)) >= 0).all() and keys[4] == keys[5]
    assert (curves.scores_of(keys)[:-1] == scores[:-1]).all() and math.isnan(curves.scores_of(keys)[-1])


def _sorted_out(rows, points):
    rows = sorted((p, bool(y and y > 0)) for p, y in rows if p is not None)[::-1]
    n, positives, out = len(rows), sum(h for _, h in rows), set()
    for i in range(1, points + 1):
        threshold = rows[-(-i * n // points) - 1][0]
        taken = [h for p, h in rows if p >= threshold]
        recall = sum(taken) / positives if positives else None
        out.add((threshold, len(taken), sum(taken) / len(taken), recall))
    return sorted(out)


@pytest.mark.parametrize("points", [1, 3, 10, 1000])
@pytest.mark.parametrize("kind", ["continuous", "ties", "wide"])
def test_points_equal_sorting(spark, points, kind):
    random.seed(7)
    draw = {
        "continuous": random.random,
        "ties": lambda: random.randrange(5) / 4,
        "wide": lambda: random.choice([-1, 1]) * 10.0 ** random.randrange(-300, 300),
    }[kind]
    rows = [(draw(), random.choice([0, 0, 1, None])) for _ in range(400)] + [(None, 1)]
    df = spark.createDataFrame(rows, "p double, label int").repartition(5)
    got = sorted(tuple(r) for r in curves.precision_recall_at(df, points).collect())
    assert got == _sorted_out(rows, points)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "p double, label int")
    assert curves.precision_recall_at(empty, 5).count() == 0
    none = spark.createDataFrame([(0.5, 0), (0.25, 0)], "p double, label int")
    assert [tuple(r) for r in curves.precision_recall_at(none, 1).collect()] == [(0.25, 2, 0.0, None)]
    with pytest.raises(ValueError):
        curves.precision_recall_at(none, 0)
