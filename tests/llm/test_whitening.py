"""Whitening against plain integers and numpy."""

import math

import numpy as np
import pytest
from tests.llm.conftest import SMALL

from clickfeat.llm import whitening as w


def brute(vectors, components=8):
    """Rows that count, and ``n, deviations, covariance`` in plain Python integers."""
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in good]
    n, d = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(d)]
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(d):
            top = sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x)
            cov[i, j] = top / n**3
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return n, x, sums, deviations, cov


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, "y", 0.5) for i, v in rows],
        "vec_id bigint, embedding array<float>, v string, deviation double",
    )


def test_planes_give_exact_products():
    rng = np.random.default_rng(3)
    for rows, bits in ((1, 3), (63, 5), (64, 1), (65, 12), (500, 30), (40, 61)):
        x = rng.integers(0, 1 << bits, (rows, 5)).astype(np.uint64)
        got = w.plane_products(w.bit_planes(x, bits), bits, 5, rows)
        exact = x.astype(object)
        assert (got.astype(object) == exact.T @ exact).all()


def test_moments_of_negative_wide_and_single_rows():
    for x in ([[-5, 7], [3, -2], [0, 0]], [[1, 1]], [[-(1 << 62), 1 << 62], [1 << 62, 5]]):
        moments = w.Moments(2)
        moments.add(np.array(x, np.int64))
        exact = np.array(x, object)
        assert (moments.products == exact.T @ exact).all()
        assert (moments.sums == exact.sum(axis=0)).all()
        limbs = moments.limbs().to_pylist()
        back = {(r["i"], r["j"]): sum(r[f"l{k}"] << (32 * k) for k in range(5)) for r in limbs}
        assert back[0, 1] == moments.products[0, 1] and back[-1, -1] == len(x)


def test_query_equals_brute_force(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in small("embeddings").collect()]
    n, x, sums, deviations, cov = brute([v for _, v in rows])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    got = w.op11_whitening(spark, str(SMALL)).collect()
    assert len(got) == 8 * n
    centred = np.array(x, float) - np.array([s / n for s in sums])
    want = centred @ vectors / np.sqrt(values)
    by = {(r["vec_id"], r["component"]): r for r in got}
    found = np.array([[by[i, c]["whitened"] for c in range(1, 9)] for i, _ in rows])
    signs = np.sign((found * want).sum(axis=0))
    assert np.abs(found - want * signs).max() < 1e-7
    for (i, _), deviation in zip(rows, deviations):
        r = by[i, 3]
        assert r["deviation"] == deviation and r["n"] == n
        assert r["explained"] == pytest.approx(values[2] / np.trace(cov), rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9


def test_result_does_not_depend_on_partitions_or_blocks(spark, small, monkeypatch):
    vectors = small("embeddings")
    whole = w.fit(vectors.coalesce(1))
    parts = w.fit(vectors.repartition(7))
    assert whole.sums == parts.sums and (whole.components == parts.components).all()
    moments, blocks = w.Moments(64), w.Moments(64)
    x = w.whole_vectors(vectors.limit(300).toArrow()["embedding"], 64)[1]
    moments.add(x)
    for at in range(0, 300, 70):
        blocks.add(x[at : at + 70])
    assert (moments.products == blocks.products).all() and (moments.sums == blocks.sums).all()


def test_odd_rows(spark):
    """Nulls, non-finite entries, repeated rows, short vectors, clashing names."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (None, [0.0, 2.0, -1.0]), (4, None),
        (5, [0.1, None, 0.2]), (6, [nan, 0.0, 0.0]), (7, [0.0, inf, 0.0]), (8, [3.0]), (9, []),
        (10, [-300.0, 0.0, 0.0]),
    ]
    df = frame(spark, rows)
    fitted = w.fit(df)
    kept = [[0.5, -0.25, 1.0]] * 2 + [[0.0, 2.0, -1.0], [3.0, 0, 0], [0.0] * 3, [-300.0, 0, 0]]
    n, x, sums, deviations, cov = brute(kept)
    assert (fitted.rows, fitted.sums) == (n, sums)
    got = w.whiten(df, fitted).collect()
    assert [r["whitening"] is None for r in got] == [i in (4, 5, 6, 7) for i, _ in rows]
    assert [int(r["whitening"]["deviation"]) for r in got if r["whitening"]] == deviations
    assert got[0]["whitening"] == got[1]["whitening"] and got[0]["v"] == "y"
    assert w.identity_error(df, fitted) < 1e-9


def test_tables_without_variance_or_rows(spark):
    one = frame(spark, [(1, [0.5, 0.25])])
    fitted = w.fit(one)
    assert fitted.rows == 1 and w.identity_error(one, fitted) is None
    row = w.whiten(one, fitted).first()["whitening"]
    assert row["whitened"] == [None, None] and row["deviation"] == 0
    for empty in (frame(spark, []), frame(spark, [(1, None)]), frame(spark, [(1, [])])):
        fitted = w.fit(empty)
        assert fitted.components.shape[1] == 0
        assert [r["whitening"] for r in w.whiten(empty, fitted).collect()] == [None] * empty.count()


def test_fewer_dimensions_than_components(spark):
    df = frame(spark, [(i, [float(i), float(i % 3)]) for i in range(20)])
    fitted = w.fit(df)
    assert fitted.components.shape == (2, 2)
    assert sum(fitted.explained) == pytest.approx(1)
    assert w.identity_error(df, fitted) < 1e-9


def test_values_beyond_the_bound(spark):
    df = frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])
    fitted = w.fit(df)
    assert fitted.rows == 3
    deviation = w.whiten(df, fitted).first()["whitening"]["deviation"]
    assert deviation == sum(
        (3 * c - s) ** 2 for c, s in zip((w.BOUND + w.OFFSET, w.OFFSET), fitted.sums)
    ) or deviation is None
