"""Language identification by mixture inference.

Training counts letter n-grams by language over all labelled documents: tasks add up arrays of
hashed counts, and one shuffle sums them. The model has ``BUCKETS`` log-probabilities a language,
whatever the size of the corpus.

A document is a bag of words, each with a likelihood under every language from its n-grams and a weight
that grows with the logarithm of its count.
Expectation-maximisation estimates the languages' proportions in the document; the set of languages
is the one with the best likelihood less a penalty for each language. The largest proportion names
the document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import query, table
from clickfeat.llm.tokens import in_chunks

#: Hashed n-gram slots, and the lengths of n-grams.
BUCKETS = 1 << 16
LENGTHS = (1, 2, 3, 4)
#: Added to every count.
SMOOTHING = 0.1
#: Steps of expectation-maximisation, and the change of proportions that ends it.
STEPS = 30
SETTLED = 1e-4
#: A language's price in log-likelihood, times the logarithm of the number of words.
PENALTY = 4.0
UNKNOWN = "und"
#: Distinct words in a task's table before it starts anew.
TABLE_WORDS = 300_000

_SEED = np.uint32(0x9E3779B1)


_RUNS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case, whole text."""
    runs = _RUNS.findall((text or "").lower())
    if all(map(str.isalpha, runs)):
        return runs
    # Numbers that are no digits, such as fractions, still stand between letters.
    spaced = ("".join([c if c.isalpha() else " " for c in run]) for run in runs)
    return " ".join(spaced).split()


def word_grams(words: list[str], lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of the words (edges marked), and the word each belongs to."""
    joined = " " + " ".join(words) + " "
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    owner = np.cumsum(codes == 32) - 1
    slots, owners = [], []
    for n in lengths:
        here = len(codes) - n + 1
        if here <= 0:
            continue
        value = np.full(here, n, np.uint32)
        for i in range(n):
            value = (value ^ codes[i : i + here]) * _SEED
            value ^= value >> np.uint32(15)
        # An n-gram belongs to the word of its first character and must not run beyond its end mark.
        blanks = np.concatenate([[0], np.cumsum(codes == 32)])
        inner = blanks[n - 1 : n - 1 + here] - blanks[1 : 1 + here] if n > 1 else np.zeros(here, int)
        good = (inner == 0) & (codes[:here] != 32) if n == 1 else inner == 0
        slots.append((value & np.uint32(BUCKETS - 1))[good].astype(np.int64))
        owners.append(owner[:here][good])
    slots, owners = np.concatenate(slots), np.concatenate(owners)
    within = (owners >= 0) & (owners < len(words))
    return slots[within], owners[within]


def _counter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, texts in batch.groupby("_lang", sort=False)["_text"]:
            into = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            texts = texts.tolist()
            for start, stop in in_chunks(texts):
                found = Counter(chain.from_iterable(map(words_of, texts[start:stop])))
                if found:
                    slots, owners = word_grams(list(found))
                    weights = np.fromiter(found.values(), np.float64, len(found))[owners]
                    into += np.bincount(slots, weights, BUCKETS).astype(np.int64)
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "slot": used, "n": counts[used]})


def count_grams(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, slot, n`` over all rows with a language; at most ``BUCKETS`` rows for each of them."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    counts = rows.mapInPandas(_counter, "lang string, slot bigint, n bigint")
    return counts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities of n-gram slots by language, languages in code point order."""

    def __init__(self, counts: pd.DataFrame):
        self.languages = sorted(counts["lang"].unique())
        self.logs = np.zeros((BUCKETS, len(self.languages)), np.float32)
        for i, lang in enumerate(self.languages):
            own = counts[counts["lang"] == lang]
            dense = np.full(BUCKETS, SMOOTHING)
            dense[own["slot"].to_numpy()] += own["n"].to_numpy()
            self.logs[:, i] = np.log(dense / dense.sum())

    def word_likelihoods(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word under each language; a word counts once however long."""
        slots, owners = word_grams(words)
        out = np.zeros((len(words), len(self.languages)))
        sizes = np.bincount(owners, minlength=len(words))
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(owners, self.logs[slots, i], len(words))
        # Overlapping n-grams are no independent evidence: their mean stands for the word's letters.
        return out * (4.0 / np.maximum(sizes, 1))[:, None]


def damped(counts: np.ndarray) -> np.ndarray:
    """Weights of words by how often they occur: a line repeated a hundred times is little evidence."""
    return 1.0 + np.log(counts)


def infer(likelihoods: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Proportions of the languages in a document; zero for those not in the chosen set.

    ``likelihoods`` are log-likelihoods of its distinct words, ``counts`` their weights. Languages
    leave the set one at a time, smallest first, while that improves the penalised likelihood.
    """
    total = counts.sum()
    active = np.arange(likelihoods.shape[1])
    top = likelihoods.max(axis=1, keepdims=True)
    scaled = np.exp(likelihoods - top)
    best: tuple[float, np.ndarray] | None = None
    shares = np.full(len(active), 1.0 / len(active))
    while True:
        own = scaled[:, active]
        for _ in range(STEPS if len(active) > 1 else 0):
            joint = own * shares
            sums = np.maximum(joint.sum(axis=1), 1e-300)
            new = (counts / sums) @ joint / total
            change = np.abs(new - shares).max()
            shares = new / new.sum()
            if change < SETTLED:
                break
        fit = counts @ np.log(np.maximum(own @ shares, 1e-300))
        score = fit - PENALTY * len(active) * np.log(total + 1.0)
        if best is None or score > best[0]:
            full = np.zeros(likelihoods.shape[1])
            full[active] = shares
            best = (score, full)
        if len(active) == 1:
            return best[1]
        stay = np.delete(np.arange(len(active)), shares.argmin())
        active = active[stay]
        kept = shares[stay]
        shares = kept / kept.sum() if kept.sum() > 0 else np.full(len(active), 1.0 / len(active))


def _predictor(model: Model):
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        numbers: dict[str, int] = {}
        known = np.zeros((0, len(model.languages)))
        for texts in batches:
            langs, scores, mixtures = [], [], []
            for text in texts:
                words = words_of(text)
                if not words or not model.languages:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    mixtures.append([])
                    continue
                new = [w for w in dict.fromkeys(words) if w not in numbers]
                if new:
                    if len(numbers) > TABLE_WORDS:
                        numbers, known, new = {}, known[:0], list(dict.fromkeys(words))
                    numbers.update(zip(new, count(len(numbers))))
                    if len(known) < len(numbers):
                        grown = np.zeros((max(len(numbers), 2 * len(known)), known.shape[1]))
                        grown[: len(numbers) - len(new)] = known[: len(numbers) - len(new)]
                        known = grown
                    known[len(numbers) - len(new) : len(numbers)] = model.word_likelihoods(new)
                at = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                distinct, counts = np.unique(at, return_counts=True)
                shares = infer(known[distinct], damped(counts))
                first = int(shares.argmax())
                langs.append(model.languages[first])
                scores.append(min(1.0, float(shares[first])))
                mixtures.append([float(x) for x in shares])
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "shares": mixtures})

    return predicted


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on all rows that have a language. The driver gets a row per language and slot."""
    return Model(count_grams(labelled, text_col, lang_col).toPandas())


def identify(docs: DataFrame, model: Model, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with the struct ``name``: ``lang_pred``, its ``score`` (share) and the ``shares`` of all.

    Shares are in the order of ``model.languages``. Null texts, texts without letters and a model without
    languages give :data:`UNKNOWN` with score 0 and no shares. Only the text column is read; others pass
    unchanged. Rows are judged one by one.
    """
    schema = "lang_pred string, score double, shares array<double>"
    predicted = F.pandas_udf(_predictor(model), schema).asNondeterministic()
    return docs.withColumn(name, predicted(F.col(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score"
    )
