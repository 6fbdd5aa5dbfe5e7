"""An exact precision and recall curve at a chosen number of points.

The thresholds are the scores at evenly spaced ranks. They are selected exactly, by rounds of counting: scores
become whole numbers of the same order, and each round counts, for every threshold still open, the rows
in each part of the range it must lie in. The counts above a threshold are known when it is found. What
reaches the driver is bounded by the points asked for, whatever the number of distinct scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.workspace import delete, new_path, small_table

BITS = 11
"""Bits of a score that a round settles: each open range is cut into 2^11 parts."""

_SIGN = np.uint64(1 << 63)


def keys_of(scores: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the scores; both zeros are equal, and NaN is above all."""
    scores = np.where(np.isnan(scores), np.nan, scores + 0.0)
    bits = scores.view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def scores_of(keys: np.ndarray) -> np.ndarray:
    return np.where(keys & _SIGN, keys & ~_SIGN, ~keys).view(np.float64)


def _counted(prefixes: np.ndarray, shift: int, bits: int):
    """``open, bin, rows, hits``: rows by the next bits of their key, for the prefixes that are open."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(prefixes) << bits
        rows, hits = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            keys = keys_of(batch.column(0).to_numpy(zero_copy_only=False))
            hit = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            top = keys >> np.uint64(shift)
            prefix = top >> np.uint64(bits) if shift + bits < 64 else np.zeros_like(top)
            at = np.minimum(np.searchsorted(prefixes, prefix), len(prefixes) - 1)
            inside = prefixes[at] == prefix
            cell = (at[inside] << bits) + (top[inside] & np.uint64((1 << bits) - 1)).astype(np.int64)
            rows += np.bincount(cell, minlength=size)
            hits += np.bincount(cell[hit[inside]], minlength=size)
        used = np.flatnonzero(rows)
        arrays = [used >> bits, used & ((1 << bits) - 1), rows[used], hits[used]]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["open", "bin", "n", "hits"])

    return counted


def precision_recall_at(scored: DataFrame, points: int, p: str = "p", label: str = "label") -> DataFrame:
    """``threshold, taken, precision, recall`` of predicting score >= threshold, at most ``points`` rows.

    The thresholds are the scores of the rows at ranks ``ceil(i * n / points)`` from the highest score; equal
    ones are one row. Rows without a score play no part, a missing label counts as 0. Scores and labels are
    written once and read in a fixed number of rounds.
    """
    if points < 1:
        raise ValueError(f"a curve has at least one point, not {points}")
    spark = scored.sparkSession
    path = new_path(spark, "scores")
    narrow = scored.filter(F.col(p).isNotNull()).select(
        F.col(p).cast("double").alias("p"), F.coalesce(F.col(label) > 0, F.lit(False)).alias("hit")
    )
    narrow.write.parquet(path)
    stored = spark.read.schema("p double, hit boolean").parquet(path)
    total = stored.agg(F.count("*").alias("n"), F.count_if("hit").alias("hits")).first()
    ranks = sorted({-(-i * total["n"] // points) for i in range(1, points + 1)} - {0})
    # For each rank: the bits settled so far, and the rows and hits that are surely above.
    open_ = [(rank, 0, 0, 0) for rank in ranks]
    left = 64 if ranks else 0
    while left:
        bits = min(BITS, left)
        left -= bits
        prefixes = np.array(sorted({prefix for _, prefix, _, _ in open_}), np.uint64)
        parts = stored.mapInArrow(_counted(prefixes, left, bits), "open bigint, bin bigint, n bigint, hits bigint")
        found = parts.groupBy("open", "bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()
        cells: dict[int, list] = {}
        for r in sorted(found, key=lambda r: -r["bin"]):
            cells.setdefault(int(prefixes[r["open"]]), []).append((r["bin"], r["n"], r["hits"]))
        settled = []
        for rank, prefix, above, hits in open_:
            for at, n, h in cells[prefix]:
                # In the last round the rows of the score itself are taken too.
                if above + n >= rank:
                    last = (above + n, hits + h) if not left else (above, hits)
                    settled.append((rank, (prefix << bits) | at, *last))
                    break
                above, hits = above + n, hits + h
        open_ = settled
    delete(spark, path)
    rows = {prefix: (n, h) for _, prefix, n, h in open_}
    thresholds = scores_of(np.array(list(rows), np.uint64))
    positives = total["hits"]
    return small_table(
        spark,
        ["threshold", "taken", "precision", "recall"],
        [pa.float64(), pa.int64(), pa.float64(), pa.float64()],
        [
            (float(t), n, h / n, h / positives if positives else None)
            for t, (n, h) in zip(thresholds, rows.values())
        ],
    )
