"""Logistic regressions on several subsets of one table, trained side by side.

The state is a weight matrix with a row for each subset. A pass over the table gives every subset its loss
and its gradient at its own weights, so the number of scans does not depend on the number of subsets.
Subsets of narrow vectors take Newton's steps, whose matrix of second derivatives is summed in the same
pass; those of wide vectors take limited-memory BFGS steps. A step of length 1 is tried in a pass, and a
subset whose loss did not fall enough halves its step in the next pass while the others go on.

Rows are packed once into blocks, so that a pass hands whole arrays to Python and not rows. The matrix is
on the driver, and a task holds it too: vectors must be of a width that allows that
(:mod:`clickfeat.models.sharded` has no such bound). Tasks' sums are added in one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from clickfeat.models.logistic import Training
from clickfeat.models.sharded import HISTORY, direction_of
from clickfeat.operators.splitting import part_of
from clickfeat.workspace import delete, new_path

#: The stored form of a vector, in which Arrow hands it to Python: kind 1 is dense and has values only.
STORED_VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"

_LOSS, _ROWS = -1, -2
"""In place of a slot: the sums of losses, and the numbers of rows."""

ARMIJO = 1e-4
SHORTEST = 2.0**-30

NARROW = 32
"""Weights up to which a subset's second derivatives, a number for each pair of weights, are summed too."""

BLOCK_VALUES = 1 << 17
"""Values in a block of rows, unless one row has more."""

_BLOCK = "width int, y binary, marks binary, sizes binary, slots binary, values binary"


@dataclass
class Rows:
    """A stored table of blocks of labels, vectors and subset marks."""

    frame: DataFrame
    path: str
    width: int
    subsets: int

    def drop(self) -> None:
        self.frame.unpersist()
        delete(self.frame.sparkSession, self.path)


def store_rows(
    df: DataFrame, subsets: Sequence[Column], features: str = "features", label: str = "label"
) -> Rows:
    """Write label, vector and, for each subset, whether the row belongs to it."""
    spark = df.sparkSession
    path = new_path(spark, "subsets")
    marks = F.array(*[F.coalesce(s, F.lit(False)) for s in subsets])
    rows = df.select(F.col(label).cast("double").alias("y"), F.col(features).alias("x"), marks.alias("marks"))
    # Small row groups: a reader holds the whole group, and few blocks should still be read by several tasks.
    packed = rows.mapInArrow(_packed, _BLOCK)
    packed.write.option("parquet.block.size", 16 << 20).parquet(path)
    frame = spark.read.schema(_BLOCK).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if len(frame.inputFiles()) < cores:  # few files mean few rows; passes should still use every core
        frame = frame.repartition(cores)
    frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    width = frame.agg(F.max("width")).first()[0] or 0
    return Rows(frame, path, width, len(subsets))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, their arrays as bytes. Dense vectors of one size have neither sizes nor slots."""
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False)
        marks = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        kinds, widths, indices, values = batch.column(1).flatten()
        dense = kinds.to_numpy(zero_copy_only=False) == 1
        sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        widths = np.where(dense, sizes, widths.fill_null(0).to_numpy(zero_copy_only=False))
        flat = values.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        slots = np.arange(len(flat)) - np.repeat(starts, sizes)
        slots[~np.repeat(dense, sizes)] = indices.flatten().to_numpy(zero_copy_only=False)
        at = 0
        while at < len(y):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_VALUES, "right")))
            own = slice(starts[at], ends[to - 1])
            even = dense[at:to].all() and (sizes[at:to] == sizes[at]).all()
            block = [
                int(widths[at:to].max()),
                y[at:to].astype(float).tobytes(),
                marks[at:to].astype(np.uint8).tobytes(),
                b"" if even else sizes[at:to].tobytes(),
                b"" if even else slots[own].astype(np.int32).tobytes(),
                flat[own].astype(float).tobytes(),
            ]
            names = ["width", "y", "marks", "sizes", "slots", "values"]
            arrays = [pa.array([v], pa.binary() if at else pa.int32()) for at, v in enumerate(block)]
            yield pa.RecordBatch.from_arrays(arrays, names)
            at = to


def _blocks(batch: pa.RecordBatch, width: int, intercept: bool):
    """Of each block labels, marks, and the vectors as rows, slots and values; the intercept has the last slot."""
    for _, y, marks, sizes, slots, flat in zip(*(c.to_pylist() for c in batch.columns)):
        y, flat = np.frombuffer(y), np.frombuffer(flat)
        marks = np.frombuffer(marks, np.uint8).reshape(len(y), -1)
        if sizes:
            row = np.repeat(np.arange(len(y)), np.frombuffer(sizes, np.int64))
            slots = np.frombuffer(slots, np.int32).astype(np.int64)
        else:
            row, slots = (i.ravel() for i in np.indices((len(y), len(flat) // len(y))))
        if intercept:
            row = np.concatenate([row, np.arange(len(y))])
            slots = np.concatenate([slots, np.full(len(y), width)])
            flat = np.concatenate([flat, np.ones(len(y))])
        yield y, marks, row, slots, flat


def _margins(weights: np.ndarray, rows: int, row, slots, values) -> np.ndarray:
    """Rows by subsets."""
    return np.stack([np.bincount(row, w[slots] * values, rows) for w in weights], axis=1)


def _softplus_loss(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y[:, None] * z


def _summed(totals: dict[int, np.ndarray]) -> pa.RecordBatch:
    """``subset, slot, value`` of what isn't zero."""
    subset, slot, value = [], [], []
    for at, found in totals.items():
        for s, numbers in enumerate(found):
            used = np.flatnonzero(numbers)
            subset.append(np.full(len(used), s))
            slot.append(used if at == 0 else np.full(len(used), at))
            value.append(numbers[used])
    join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
    return pa.RecordBatch.from_arrays(
        [join(subset, pa.int32()), join(slot, pa.int64()), join(value, pa.float64())], ["subset", "slot", "value"]
    )


def _slopes(weights: np.ndarray, width: int, intercept: bool):
    """Sums of losses and gradients at these weights; with no weights, of squares instead of gradients.

    Where vectors are narrow, the gradient's numbers are followed by those of its derivatives.
    """
    slots_of_all = width + intercept
    curved = weights is not None and slots_of_all <= NARROW

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for y, marks, row, slots, values in (b for batch in batches for b in _blocks(batch, width, intercept)):
            if totals is None:
                n = marks.shape[1]
                length = slots_of_all + curved * slots_of_all**2
                totals = {0: np.zeros((n, length)), _LOSS: np.zeros((n, 1)), _ROWS: np.zeros((n, 1))}
            totals[_ROWS][:, 0] += marks.sum(axis=0)
            if weights is None:
                each, values = marks.astype(float), values * values
            elif curved:
                x = np.bincount(row * slots_of_all + slots, values, len(y) * slots_of_all).reshape(len(y), -1)
                z = x @ weights.T
            else:
                z = _margins(weights, len(y), row, slots, values)
            if weights is not None:
                totals[_LOSS][:, 0] += (_softplus_loss(z, y) * marks).sum(axis=0)
                p = 0.5 + 0.5 * np.tanh(z / 2)
                each = (p - y[:, None]) * marks
            if curved:
                totals[0][:, :slots_of_all] += each.T @ x
                for s, bend in enumerate((p * (1 - p) * marks).T):
                    totals[0][s, slots_of_all:] += (x.T @ (x * bend[:, None])).ravel()
                continue
            for s, own in enumerate(each.T):
                totals[0][s] += np.bincount(slots, own[row] * values, slots_of_all)
        if totals is not None:
            yield _summed(totals)

    return summed


def _pass(rows: Rows, task, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrix of sums by subset and slot, and sums of losses and rows by subset."""
    parts = rows.frame.mapInArrow(task, "subset int, slot bigint, value double")
    found = parts.groupBy("subset", "slot").agg(F.sum("value").alias("value")).toArrow()
    subset, slot, value = (found[c].to_numpy() for c in ("subset", "slot", "value"))
    matrix = np.zeros((rows.subsets, length))
    losses, counts = np.zeros(rows.subsets), np.zeros(rows.subsets)
    own = slot >= 0
    matrix[subset[own], slot[own]] = value[own]
    losses[subset[slot == _LOSS]] = value[slot == _LOSS]
    counts[subset[slot == _ROWS]] = value[slot == _ROWS]
    return matrix, losses, counts


@dataclass
class _Fit:
    """One subset's way down."""

    weights: np.ndarray
    scale: np.ndarray
    l2: np.ndarray
    rows: float
    loss: float = np.inf
    slope: np.ndarray | None = None
    steps: list[np.ndarray] = field(default_factory=list)
    changes: list[np.ndarray] = field(default_factory=list)
    direction: np.ndarray | None = None
    length: float = 0.0
    done: bool = False

    def tried(self) -> np.ndarray:
        if self.direction is None:
            return self.weights
        return self.weights + self.length * self.direction * self.scale

    def see(self, loss: float, sums: np.ndarray, tolerance: float) -> None:
        """Take the sums at the tried weights: accept them, or try a shorter step."""
        at = self.tried()
        slope, curve = sums[: len(at)], sums[len(at) :]
        loss = loss / self.rows + (self.l2 * at * at).sum() / 2
        slope = (slope / self.rows + self.l2 * at) * self.scale
        if self.direction is not None:
            if not loss <= self.loss + ARMIJO * self.length * float(self.slope @ self.direction):
                self.length /= 2
                self.done = self.length < SHORTEST
                return
            step, change = self.length * self.direction, slope - self.slope
            if step @ change > 0:
                self.steps = [*self.steps, step][-HISTORY:]
                self.changes = [*self.changes, change][-HISTORY:]
            self.done = self.loss - loss <= tolerance * np.log(2.0)  # the loss at the start
        self.weights, self.loss, self.slope = at, loss, slope
        self.length = 1.0
        if len(curve) and np.isfinite(sums).all():
            curve = (curve.reshape(len(at), -1) / self.rows + np.diag(self.l2)) * np.outer(self.scale, self.scale)
            self.direction = -np.linalg.lstsq(curve, slope, rcond=1e-12)[0]
            # Half of this product is what the step gains. Less than the tolerance drowns in rounding.
            self.done |= not -self.slope @ self.direction > 2 * tolerance * np.log(2.0)
            return
        basis = np.array([*self.steps, *self.changes, slope])
        self.direction = direction_of(basis @ basis.T, len(self.steps)) @ basis
        if not self.slope @ self.direction < 0:
            self.done = True


def fit_many(rows: Rows, training: Training) -> np.ndarray:
    """Weights by subset, the intercept's last. A subset without rows keeps weights of zero."""
    slots = rows.width + training.intercept
    squares, _, counts = _pass(rows, _slopes(None, rows.width, training.intercept), slots)
    l2 = np.full(squares.shape[1], training.l2)
    if training.intercept:
        l2[-1] = 0.0
    fits = []
    for q, n in zip(squares, counts):
        most = q / (4 * max(n, 1)) + l2
        scale = np.where(most > 0, 1 / np.sqrt(np.where(most > 0, most, 1)), 0.0)
        fits.append(_Fit(np.zeros(len(q)), scale, l2, max(n, 1), done=n == 0))
    for _ in range(2 * training.iterations):
        if all(f.done for f in fits):
            break
        tried = np.array([f.weights if f.done else f.tried() for f in fits])
        length = slots + (slots <= NARROW) * slots**2
        slopes, losses, _ = _pass(rows, _slopes(tried, rows.width, training.intercept), length)
        for f, slope, loss in zip(fits, slopes, losses):
            if not f.done:
                f.see(loss, slope, training.tolerance)
    return np.array([f.weights for f in fits])


def log_losses(rows: Rows, weights: np.ndarray, intercept: bool, eps: float) -> list[tuple]:
    """Mean clamped log loss of each subset's model, on the subset and on all other rows, in one pass.

    None where there are no rows.
    """
    width = rows.width

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((4, len(weights)))
        for y, marks, row, slots, values in (b for batch in batches for b in _blocks(batch, width, intercept)):
            p = 0.5 + 0.5 * np.tanh(_margins(weights, len(y), row, slots, values) / 2)
            p = np.clip(p, eps, 1 - eps)
            loss = -y[:, None] * np.log(p) - (1 - y[:, None]) * np.log(1 - p)
            marks = marks.astype(bool)
            totals += [(loss * marks).sum(0), marks.sum(0), (loss * ~marks).sum(0), (~marks).sum(0)]
        kind, subset = np.indices(totals.shape)
        arrays = [pa.array(subset.ravel(), pa.int32()), pa.array(kind.ravel(), pa.int64()), pa.array(totals.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["subset", "kind", "value"])

    parts = rows.frame.mapInArrow(summed, "subset int, kind bigint, value double")
    found = {(r["subset"], r["kind"]): r["v"] for r in parts.groupBy("subset", "kind").agg(F.sum("value").alias("v")).collect()}
    mean = lambda s, k: found[s, k] / found[s, k + 1] if found.get((s, k + 1)) else None
    return [(mean(s, 0), mean(s, 2)) for s in range(rows.subsets)]


def repeated_holdout(
    df: DataFrame,
    key: str,
    training: Training,
    features: str = "features",
    label: str = "label",
    repeats: int = 3,
    train_share: float = 0.75,
    eps: float = 1e-5,
) -> DataFrame:
    """Train on one part, take the log loss on the other, for seeds 1 to ``repeats``, all at once.

    ``seed, train_loss, test_loss``; both parts are reported. The part goes by a hash of the key.
    """
    seeds = range(1, repeats + 1)
    parts = [part_of(F.col(key), [train_share, 1 - train_share], seed) == 0 for seed in seeds]
    rows = store_rows(df, parts, features, label)
    losses = log_losses(rows, fit_many(rows, training), training.intercept, eps)
    rows.drop()
    return df.sparkSession.createDataFrame(
        [(seed, *pair) for seed, pair in zip(seeds, losses)], "seed int, train_loss double, test_loss double"
    )
