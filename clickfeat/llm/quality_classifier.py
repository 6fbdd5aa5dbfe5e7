"""Quality scores by a factorisation machine.

A text becomes a sparse vector: hashed words with damped counts, structure statistics in steps, and
metadata columns. The machine adds to a linear score the interaction of every pair of features, with
the inner product of two short factor vectors as the pair's weight. By the sum-of-squares identity, the sum
over all pairs is ``1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``, so a score costs time linear in
the features.

Vectors of a bounded sample of labelled rows go to the driver, which fits by AdaGrad on small batches. The
model has a fixed size. Scoring is a scan.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import query, table
from clickfeat.llm.language_id import held_out
from clickfeat.llm.source_divergence import terms_of

#: Slots of hashed words, and behind them those of statistics and metadata.
WORD_SLOTS = 1 << 15
OTHER_SLOTS = 1 << 12
FACTORS = 8
#: Labelled rows that the machine is fitted on, about: a sample by hash where there are more.
SAMPLE = 16_000
EPOCHS = 8
BATCH = 64
RATE = 0.15
L2 = 1e-4
#: Scores from here are predicted good.
GOOD = 0.7
#: Length of the vector of hashed words, and value of every other feature.
WORD_WEIGHT = 0.25
OTHER_WEIGHT = 0.5

SYMBOLS = b"#*$%&|<>{}[]\\^~=+_@/"
ENDS = b".!?:;"
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def _only(raw: bytes, wanted: bytes) -> int:
    return len(raw) - len(raw.translate(None, wanted))


def statistics(text: str, raw: bytes, words: Counter) -> dict[str, float]:
    """Structure of a text: sizes, and shares between 0 and 1."""
    n = sum(words.values())
    runs = len(raw.split())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    ended = sum(line.rstrip()[-1:] in ENDS for line in lines)
    upper, lower = _only(raw, _UPPER), _only(raw, _LOWER)
    size = max(len(raw), 1)
    return {
        "words": float(runs),
        "lines": float(len(lines)),
        "words a line": runs / max(len(lines), 1),
        "word length": len(text) / max(runs, 1),
        "symbols": _only(raw, SYMBOLS) / size,
        "shouts": _only(raw, b"!?") / size,
        "digits": _only(raw, _DIGITS) / size,
        "upper": upper / max(upper + lower, 1),
        "beyond ascii": (len(raw) - len(text)) / size,
        "repeated lines": 1 - len(set(lines)) / max(len(lines), 1),
        "ended lines": ended / max(len(lines), 1),
        "distinct words": len(words) / max(n, 1),
        "commonest word": max(words.values(), default=0) / max(n, 1),
    }


def steps_of(name: str, value: float) -> list[str]:
    """A feature for each power of two that a size, or a share in thousandths, has reached.

    Steps add up, so that what few rows teach about a large value holds for larger ones too.
    """
    scaled = value if name in ("words", "lines", "words a line", "word length") else 1000 * value
    return [f"{name}>={k}" for k in range(int(np.log2(1 + scaled)) + 1)]


def _other_slot(feature: str) -> int:
    return WORD_SLOTS + crc32(feature.encode("utf-8", "surrogatepass")) % OTHER_SLOTS


def features(text: str | None, metadata: dict) -> tuple[np.ndarray, np.ndarray]:
    """Slots, ascending, and their values; never empty, also for a null or empty text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words: Counter[bytes] = Counter()
    for part in terms_of(raw):
        words.update(part)
    others = [step for item in statistics(text, raw, words).items() for step in steps_of(*item)]
    for name, value in metadata.items():
        number = isinstance(value, (int, float)) and not isinstance(value, bool) and value == value
        small = number and abs(value) < 1e300
        shown = f"{value < 0}{int(np.log2(1 + abs(value)))}" if small else value
        others.append(f"{name}={shown}")
    found: Counter[int] = Counter()
    for word, n in words.items():
        found[crc32(word) % WORD_SLOTS] += n
    values = np.log1p(np.fromiter(found.values(), np.float64, len(found)))
    length = np.sqrt((values * values).sum())
    extra = sorted(set(map(_other_slot, others)))
    slots = np.concatenate([np.fromiter(found, np.int64, len(found)), np.array(extra, np.int64)])
    values = np.concatenate([values * (WORD_WEIGHT / (length or 1.0)), np.full(len(extra), OTHER_WEIGHT)])
    order = np.argsort(slots, kind="stable")
    return slots[order], values[order]


@dataclass
class Rows:
    """Sparse vectors one after another; each has an entry at least."""

    starts: np.ndarray
    slots: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, vectors: Sequence[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = [len(s) for s, _ in vectors]
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        empty = np.zeros(0)
        slots = np.concatenate([empty.astype(np.int64), *[s for s, _ in vectors]])
        return cls(starts, slots, np.concatenate([empty, *[v for _, v in vectors]]))

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Rows(starts, self.slots[at], self.values[at])


class Machine:
    """A bias, a weight for each slot and a factor vector for each slot."""

    def __init__(self, bias: float = 0.0, slots: int = WORD_SLOTS + OTHER_SLOTS, factors: int = FACTORS):
        self.bias = bias
        self.weights = np.zeros(slots)
        self.factors = np.random.default_rng(1).normal(0, 0.05, (slots, factors))

    def margins(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the sigmoid; and the factor sums and products that training reuses."""
        starts, x = rows.starts[:-1], rows.values[:, None]
        products = self.factors[rows.slots] * x
        sums = np.add.reduceat(products, starts, axis=0)
        squares = np.add.reduceat(products * products, starts, axis=0)
        linear = np.add.reduceat(self.weights[rows.slots] * rows.values, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, products

    def scores(self, rows: Rows) -> np.ndarray:
        if len(rows.starts) < 2:
            return np.zeros(0)
        return 0.5 * (1 + np.tanh(0.5 * self.margins(rows)[0]))

    def gradient(self, rows: Rows, labels: np.ndarray):
        """Of the mean log loss: by bias, and for the slots that occur by weight and factors."""
        margins, sums, products = self.margins(rows)
        gaps = (0.5 * (1 + np.tanh(0.5 * margins)) - labels) / len(labels)
        sizes = np.diff(rows.starts)
        each = np.repeat(gaps, sizes) * rows.values
        by_factor = each[:, None] * (np.repeat(sums, sizes, axis=0) - products)
        order = np.argsort(rows.slots, kind="stable")
        slots = rows.slots[order]
        first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        return (
            gaps.sum(),
            slots[first],
            np.add.reduceat(each[order], first),
            np.add.reduceat(by_factor[order], first, axis=0),
        )

    def fit(self, rows: Rows, labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> Machine:
        """AdaGrad over batches in a fixed random order, from a bias at the smoothed label mean."""
        n = len(labels)
        if not n:
            return self
        mean = (labels.sum() + 0.5) / (n + 1)
        self.bias = float(np.log(mean / (1 - mean)))
        seen_bias, seen = 1e-8, np.full(len(self.weights), 1e-8)
        seen_factors = np.full(self.factors.shape, 1e-8)
        shuffled = np.random.default_rng(2)
        for _ in range(epochs):
            order = shuffled.permutation(n)
            for at in range(0, n, BATCH):
                batch = order[at : at + BATCH]
                by_bias, slots, by_weight, by_factor = self.gradient(rows.take(batch), labels[batch])
                by_weight = by_weight + L2 * self.weights[slots]
                by_factor = by_factor + L2 * self.factors[slots]
                seen_bias += by_bias**2
                seen[slots] += by_weight**2
                seen_factors[slots] += by_factor**2
                self.bias -= rate * by_bias / np.sqrt(seen_bias)
                self.weights[slots] -= rate * by_weight / np.sqrt(seen[slots])
                self.factors[slots] -= rate * by_factor / np.sqrt(seen_factors[slots])
        return self


def _vectors_of(columns: Sequence[pa.Array], metadata: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    texts, *rest = [c.to_pylist() for c in columns]
    named = zip(*rest) if rest else ((),) * len(texts)
    return [features(text, dict(zip(metadata, values))) for text, values in zip(texts, named)]


def _vectorised(metadata: Sequence[str]):
    def vectorised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Rows.of(_vectors_of(batch.columns[2:], metadata))
            starts = pa.array(rows.starts, pa.int32())
            lists = [
                pa.ListArray.from_arrays(starts, pa.array(rows.slots, pa.int32())),
                pa.ListArray.from_arrays(starts, pa.array(rows.values, pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], ["key", "label", "slots", "values"])

    return vectorised


def _inputs(text_col: str, metadata: Sequence[str]) -> list[Column]:
    return [F.col(text_col).cast("string"), *[F.col(c) for c in metadata]]


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata: Sequence[str] = (),
    sample: int = SAMPLE,
    epochs: int = EPOCHS,
) -> Machine:
    """Fit on the documents that ``labels`` holds, on about ``sample`` of them where there are more.

    Labels are numbers from 0 to 1 by ``id_col``; several of one id count as their mean, null ones not at all.
    ``metadata`` columns of ``docs`` are numbers or strings. The sample goes by a hash of id and text and is
    taken before labels are joined, so texts outside it are never shuffled and it depends on no order; equal
    rows count once. Null ids have no label. Without labelled rows every text scores 0.5.
    """
    label = F.least(F.greatest(F.col(label_col).cast("double"), F.lit(0.0)), F.lit(1.0))
    means = labels.groupBy(F.col(id_col).alias("id")).agg(F.avg(label).alias("label"))
    means = means.filter(F.col("label").isNotNull())
    named = [c.alias(f"c{i}") for i, c in enumerate(_inputs(text_col, metadata))]
    rows = docs.select(F.col(id_col).alias("id"), *named)
    total = rows.select("id").join(means, "id").count()
    key = F.xxhash64("id", *[f"c{i}" for i in range(len(named))])
    rows = rows.select("id", key.alias("key"), *[f"c{i}" for i in range(len(named))])
    if total > sample:
        rows = rows.filter(F.pmod("key", F.lit(1 << 40)) < int(sample / total * (1 << 40)))
    vectors = rows.join(means, "id").select("key", "label", *[f"c{i}" for i in range(len(named))])
    vectors = vectors.dropDuplicates(["key"]).mapInArrow(
        _vectorised(metadata), "key bigint, label double, slots array<int>, values array<double>"
    )
    found = vectors.toArrow().combine_chunks().sort_by("key")
    if not len(found):
        return Machine()
    slots, values = (found[c].combine_chunks() for c in ("slots", "values"))
    starts = np.concatenate([[0], np.cumsum(slots.value_lengths().to_numpy())]).astype(np.int64)
    flat = Rows(starts, slots.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy())
    return Machine().fit(flat, found["label"].to_numpy(), epochs)


def _scorer(machine: Machine, metadata: Sequence[str]):
    def scored(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield pa.array(machine.scores(Rows.of(_vectors_of(columns, metadata))), pa.float64())

    return scored


def score(
    docs: DataFrame, machine: Machine, text_col: str = "text", metadata: Sequence[str] = (), name: str = "score"
) -> DataFrame:
    """``docs`` with ``name``: the probability, 0 to 1, that a row has label 1.

    Only the text and the ``metadata`` columns the machine was trained with are read; nulls in them are
    features too, and null text counts as empty. Whole texts are read, however long. Rows are scored one by one, so equal
    rows score equal; other columns pass unchanged and an empty table stays empty.
    """
    if not metadata:
        # A function of a single column gets no tuple.
        return docs.withColumn(name, F.arrow_udf(_single(machine), "double").asNondeterministic()(F.col(text_col)))
    made = F.arrow_udf(_several(machine, tuple(metadata)), "double").asNondeterministic()
    return docs.withColumn(name, made(*_inputs(text_col, metadata)))


def _single(machine: Machine):
    scored = _scorer(machine, ())

    def single(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return scored((batch,) for batch in batches)

    return single


def _several(machine: Machine, metadata: Sequence[str]):
    scored = _scorer(machine, metadata)

    def several(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return scored(batches)

    return several


METADATA = ("n_chars",)


@query()
def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", *METADATA)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out())
    machine = train(docs, labels, "quality", metadata=METADATA)
    scored = score(docs, machine, metadata=METADATA)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"),
    )
