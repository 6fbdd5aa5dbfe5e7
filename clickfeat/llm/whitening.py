"""Embedding whitening by a bit-sliced scatter matrix.

Entries become whole numbers. A task takes blocks of rows, shifts each dimension so that its smallest
value in the block is zero, and packs every bit plane of every dimension across the rows into 64-bit
words. The ones that two planes share, counted by AND and popcount and weighted by the planes' place
values, add up to the exact cross-products; the shift is undone in whole numbers. One shuffle sums the
tasks' products, cut into 32-bit limbs so that no sum can overflow. The driver gets a row per pair of
dimensions, centres as integers (``n * XX - S * S``) and takes the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import free_name, query, table

#: An entry ``c`` becomes ``floor(SCALE * c) + OFFSET``.
SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
#: Rows whose planes are packed together: a block's planes should fit a core's cache.
BLOCK_ROWS = 16_384
#: Scaled entries beyond this bound count as the bound, so that they fit 64 bits.
BOUND = 1 << 62

_LIMBS = 5
_SUMS = -1
"""In place of the first dimension: the sums of single dimensions; with itself, the row count."""


def whole_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors count, and those as rows of whole numbers.

    Null vectors, vectors with null or non-finite entries and vectors longer than ``width`` don't count.
    Shorter vectors are filled with entries of zero.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts = column.offsets.to_numpy().astype(np.int64)
    entries = column.values
    good = np.ones(len(entries), bool)
    if entries.null_count:
        good = entries.is_valid().to_numpy(zero_copy_only=False)
        entries = entries.fill_null(0.0)
    values = entries.to_numpy(zero_copy_only=False).astype(np.float64)
    good &= np.isfinite(values)
    sizes = np.diff(starts)
    bad = np.concatenate([[0], np.cumsum(~good)])
    use = (bad[starts[1:]] == bad[starts[:-1]]) & (sizes <= width)
    if column.null_count:
        use &= column.is_valid().to_numpy(zero_copy_only=False)
    kept, lengths = starts[:-1][use], sizes[use]
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(np.where(good, values, 0.0) * SCALE), -BOUND, BOUND)
    scaled = scaled.astype(np.int64) + OFFSET
    if width and len(kept) and (lengths == width).all() and (np.diff(kept) == width).all():
        return use, scaled[kept[0] : kept[0] + len(kept) * width].reshape(-1, width)
    out = np.full((len(kept), width), OFFSET, np.int64)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(kept)), lengths), at] = scaled[np.repeat(kept, lengths) + at]
    return use, out


def bit_planes(shifted: np.ndarray, bits: int) -> np.ndarray:
    """Planes of unsigned rows as 64-bit words across rows: row ``bit * width + dimension``."""
    rows, width = shifted.shape
    words = -(-rows // 64)
    packed = np.zeros((bits * width, words * 8), np.uint8)
    for bit in range(bits):
        plane = ((shifted >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        packed[bit * width : (bit + 1) * width, : -(-rows // 8)] = np.packbits(plane.T, axis=1)
    return packed.view(np.uint64)


def plane_products(planes: np.ndarray, bits: int, width: int, rows: int) -> np.ndarray:
    """Exact cross-products of the packed rows, as a symmetric matrix of whole numbers."""
    exact = np.int64 if 2 * bits + rows.bit_length() + 1 <= 62 else object
    once = np.zeros((width, width), exact)
    twice = np.zeros((width, width), exact)
    for bit in range(bits):
        for i in range(width):
            first = bit * width + i
            ones = np.bitwise_count(planes[first] & planes[first:]).sum(axis=1, dtype=np.int64)
            own = ones[: width - i].astype(exact)
            once[i, i:] += own * (1 << (2 * bit))
            for other in range(bit + 1, bits):
                at = (other - bit) * width - i
                twice[i] += ones[at : at + width].astype(exact) * (1 << (bit + other))
    upper = np.triu(once)
    return upper + np.triu(once, 1).T + twice + twice.T


@dataclass
class Moments:
    """Row count, sums and cross-products of whole-number rows, exact."""

    width: int
    rows: int = 0

    def __post_init__(self):
        self.sums = np.zeros(self.width, object)
        self.products = np.zeros((self.width, self.width), object)

    def add(self, block: np.ndarray) -> None:
        rows = len(block)
        if not rows or not self.width:
            self.rows += rows
            return
        low = block.min(axis=0)
        shifted = block.view(np.uint64) - low.view(np.uint64)  # the wrapped difference is the true one
        bits = int(shifted.max()).bit_length()
        planes = bit_planes(shifted, bits)
        products = plane_products(planes, bits, self.width, rows).astype(object)
        ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64).reshape(bits, self.width)
        above = sum(((1 << b) * ones[b].astype(object) for b in range(bits)), np.zeros(self.width, object))
        low = low.astype(object)
        self.rows += rows
        self.sums = self.sums + above + rows * low
        self.products = self.products + (
            products + np.outer(low, above) + np.outer(above, low) + rows * np.outer(low, low)
        )

    def limbs(self) -> pa.RecordBatch:
        """``i, j`` and the limbs of each number, pairs of dimensions once."""
        i, j = np.triu_indices(self.width)
        first = np.concatenate([[_SUMS], np.full(self.width, _SUMS), i])
        second = np.concatenate([[_SUMS], np.arange(self.width), j])
        numbers = [self.rows, *self.sums.tolist(), *self.products[i, j].tolist()]
        low = [[(v >> (32 * k)) & 0xFFFFFFFF for v in numbers] for k in range(_LIMBS - 1)]
        top = [v >> (32 * (_LIMBS - 1)) for v in numbers]
        arrays = [pa.array(first, pa.int32()), pa.array(second, pa.int32())]
        arrays += [pa.array(x, pa.int64()) for x in (*low, top)]
        return pa.RecordBatch.from_arrays(arrays, ["i", "j", *(f"l{k}" for k in range(_LIMBS))])


def _scatter(width: int):
    def scattered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments, waiting, rows = Moments(width), [], 0
        for batch in batches:
            waiting.append(whole_vectors(batch.column(0), width)[1])
            rows += len(waiting[-1])
            if rows >= BLOCK_ROWS:
                joined = np.concatenate(waiting)
                whole = rows - rows % BLOCK_ROWS
                for at in range(0, whole, BLOCK_ROWS):
                    moments.add(joined[at : at + BLOCK_ROWS])
                waiting, rows = [joined[whole:]], rows - whole
        if rows:
            moments.add(np.concatenate(waiting))
        if moments.rows:
            yield moments.limbs()

    return scattered


@dataclass
class Whitening:
    """What was fitted: ``components`` are columns, by falling variance."""

    rows: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    @property
    def scales(self) -> np.ndarray:
        """Factors of projections; none for a component without variance."""
        with np.errstate(divide="ignore"):
            return np.where(self.variances > 0, 1 / np.sqrt(self.variances), np.nan)


def covariance(rows: int, sums: list[int], products: np.ndarray) -> np.ndarray:
    """Products centred as integers, then divided: each entry is the nearest double."""
    s = np.array(sums, object)
    centred = rows * products - np.outer(s, s)
    return np.array([[v / (rows * rows) for v in line] for line in centred.tolist()], float)


def components_of(cov: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit eigenvectors, variances and shares of the trace, by falling variance.

    The largest entry of a vector is positive. Variances within rounding of zero are zero.
    """
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], vectors[:, order]
    noise = len(cov) * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    values = np.where(values > noise, values, 0.0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    trace = float(np.trace(cov))
    return vectors * signs, values, values / trace if trace > 0 else np.zeros(len(order))


def _vectors(df: DataFrame, vector_col: str) -> DataFrame:
    return df.select(F.col(vector_col).cast("array<double>").alias("v"))


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on every vector that counts (see :func:`whole_vectors`), in two scans.

    The driver and each task hold a number for each pair of dimensions, whatever the number of rows.
    Without vectors, or with empty ones only, there are no components.
    """
    vectors = _vectors(df, vector_col)
    counts = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    width = vectors.filter(counts).agg(F.max(F.size("v"))).first()[0] or 0  # NaN is above infinity
    limbs = [f"l{k}" for k in range(_LIMBS)]
    schema = "i int, j int, " + ", ".join(f"{x} bigint" for x in limbs)
    parts = vectors.mapInArrow(_scatter(width), schema)
    found = parts.groupBy("i", "j").agg(*[F.sum(x).alias(x) for x in limbs]).collect()
    number = {
        (r["i"], r["j"]): sum(r[x] << (32 * k) for k, x in enumerate(limbs)) for r in found
    }
    rows = number.get((_SUMS, _SUMS), 0)
    if not rows or not width:
        return Whitening(rows, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    sums = [number[_SUMS, i] for i in range(width)]
    products = np.array(
        [[number[min(i, j), max(i, j)] for j in range(width)] for i in range(width)], object
    )
    vectors, values, explained = components_of(covariance(rows, sums, products), components)
    return Whitening(rows, sums, vectors, values, explained)


def _projector(fitted: Whitening):
    """Centred projections of whole-number rows, and the exact squared deviations."""
    means = [divmod(s, fitted.rows) for s in fitted.sums]
    base = np.array([q for q, _ in means], np.int64)
    rest = np.array([r for _, r in means], np.int64)
    turn = fitted.components * fitted.scales

    def projected(x: np.ndarray) -> np.ndarray:
        return ((x - base) - rest / fitted.rows) @ turn

    def deviations(x: np.ndarray) -> list[int]:
        # n * x - S is n * z - r with small z: two short sums of 64 bits and whole numbers of any size.
        z = x - base
        largest = int(np.abs(z).max(initial=0))
        if len(base) * largest * max(largest, fitted.rows) >= 1 << 62:
            z = z.astype(object)
        squares, mixed = (z * z).sum(axis=1).tolist(), (z * rest).sum(axis=1).tolist()
        n, own = fitted.rows, sum(r * r for _, r in means)
        return [n * n * a - 2 * n * b + own for a, b in zip(squares, mixed)]

    return projected, deviations


def _whitened(fitted: Whitening, components: int):
    projected, deviations = _projector(fitted)
    width = len(fitted.sums)

    def whitened(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in vectors:
            use, x = whole_vectors(column, width)
            exact = [Decimal(v) if v < 10**38 else None for v in deviations(x)]
            flat = projected(x).ravel()
            sizes = np.concatenate([[0], np.cumsum(use * components)]).astype(np.int32)
            numbers = pa.array(flat, pa.float64(), mask=np.isnan(flat))
            at = np.cumsum(use) - 1
            yield pa.StructArray.from_arrays(
                [
                    pa.array(exact, pa.decimal128(38, 0)).take(pa.array(at, mask=~use)),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), numbers),
                ],
                ["deviation", "whitened"],
                mask=pa.array(~use),
            )

    return whitened


def whiten(
    df: DataFrame, fitted: Whitening, vector_col: str = "embedding", name: str = "whitening"
) -> DataFrame:
    """``df`` with the struct ``name``: ``deviation`` and the array ``whitened``, one entry a component.

    ``deviation`` is the sum of ``(n * x - S)^2`` over the dimensions, exact, null from 10^38. Vectors that
    don't count get a null struct; a component without variance gives null entries. Vectors shorter
    than the fitted ones are filled with zeros. Rows are taken one by one: ties and repeated rows agree,
    all other columns pass unchanged, nulls among them, and an empty table stays empty.
    """
    components = fitted.components.shape[1]
    schema = "deviation decimal(38,0), whitened array<double>"
    if not components:
        return df.withColumn(name, F.lit(None).cast(f"struct<{schema}>"))
    apply = F.arrow_udf(_whitened(fitted, components), schema).asNondeterministic()
    return df.withColumn(name, apply(F.col(vector_col).cast("array<double>")))


def _second_moments(fitted: Whitening, live: np.ndarray):
    projected, _ = _projector(fitted)
    width = len(fitted.sums)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live) + 1, len(live)))
        for batch in batches:
            w = projected(whole_vectors(batch.column(0), width)[1])[:, live]
            total[0] += w.sum(axis=0)
            total[1:] += w.T @ w
        i, j = np.indices(total.shape)
        arrays = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "v"])

    return summed


def identity_error(df: DataFrame, fitted: Whitening, vector_col: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened rows' covariance less the identity, over all rows.

    Measured on the projections of every row, for the components with variance; None without any.
    """
    live = np.flatnonzero(fitted.variances > 0)
    if not len(live):
        return None
    parts = _vectors(df, vector_col).mapInArrow(_second_moments(fitted, live), "i int, j int, v double")
    total = np.zeros((len(live) + 1, len(live)))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[row["i"], row["j"]] = row["v"]
    mean = total[0] / fitted.rows
    found = total[1:] / fitted.rows - np.outer(mean, mean)
    return float(np.abs(found - np.eye(len(live))).max())


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector that counts and component. ``deviation`` is null beyond the range of a long."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = fit(vectors)
    error = identity_error(vectors, fitted)
    name = free_name(vectors, "_white")
    shares = F.array(*[F.lit(float(x)) for x in fitted.explained]).cast("array<double>")
    rows = whiten(vectors, fitted, name=name).filter(F.col(name).isNotNull())
    each = rows.select("vec_id", F.col(name)["deviation"].alias("d"), F.posexplode(F.col(name)["whitened"]))
    return each.select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        F.lit(fitted.rows).cast("bigint").alias("n"),
        F.expr("try_cast(d AS bigint)").alias("deviation"),
        F.col("col").alias("whitened"),
        F.get(shares, F.col("pos")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
