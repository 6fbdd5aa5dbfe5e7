"""Source divergence audit: how the word use of each source differs from its language's other sources.

Counting is one shuffle: tasks add up terms by language and source before it. Terms that enough documents
of a language hold are kept, and each group (language, source) gives every kept term a smoothed rate in
whole numbers. All pairs of a language's groups are then compared by Gustavson's row accumulation:

- Terms are dealt to blocks. A block has the postings of its terms, and the totals of all groups.
- A block sorts its postings by term: the term-major index. Group by group, it walks the group's terms
  through the index and adds what each peer's posting changes to a dense accumulator with a slot for each
  peer. No pair of postings is ever a row; a block gives one number for each pair of groups.
- The rates of terms that a group does not hold are not zero but its base rate. The accumulators hold
  corrections to a start where both groups have base rates only: first for a term of one group against
  the peer's base rate (prefix sums over the group's sorted rates answer that for all peers), then for
  terms that both hold.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import keep, query, table

#: A term is kept if at least so many documents of its language hold it.
LEAST_DOCS = 30
#: Added to every count, and the whole-number scale of rates.
SMOOTHING = 5
SCALE = 1_000_000_000
#: Terms reported for a group.
TOP_TERMS = 50
#: Distinct terms in a task before it hands on its counts, and bytes of a text cut into terms at a time.
TASK_TERMS = 400_000
SLICE = 1 << 20
#: Postings in a block, about: more where there are more pairs of groups, as a block gives a row for each
#: pair, up to a bound that fits a task. And peers' postings looked at in one step.
BLOCK_POSTINGS = 25_000
MOST_POSTINGS = 4_000_000
STEP = 1 << 20

#: Terms are runs of ASCII letters and all other characters beyond ASCII; UTF-8 keeps those bytes apart.
_FOLD = bytes(
    c + 32 if chr(c) in string.ascii_uppercase else c if c >= 128 or chr(c) in string.ascii_letters else 32
    for c in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """All terms of a text in UTF-8, A-Z lower-cased, a slice of the text at a time."""
    folded = text.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def given() -> pa.RecordBatch:
        langs, sources, terms, counts, docs = [], [], [], [], []
        for (lang, source), (n, d) in held.items():
            terms += [b"", *n]
            counts += [0, *n.values()]
            docs += [0, *map(d.__getitem__, n)]
            langs += [lang] * (len(n) + 1)
            sources += [source] * (len(n) + 1)
        arrays = [pa.array(langs, pa.string()), pa.array(sources, pa.string())]
        arrays += [pa.array(terms, pa.binary()).cast(pa.string())]
        arrays += [pa.array(x, pa.int64()) for x in (counts, docs)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            n, d = held.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(n), set()
            for words in terms_of(text.as_py()):
                n.update(words)
                own.update(words)
            d.update(own)
            size += len(n) - before
            if size > TASK_TERMS:
                yield given()
                held, size = {}, 0
    yield given()


def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents. Each group has a row with an empty term."""
    names = {"lang": lang_col, "source": source_col, "text": text_col}
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in names.items()])
    read = read.withColumn("text", F.col("text").cast("binary"))
    counts = read.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def rates(counts: np.ndarray, total: int, kept: int, smoothing: int, scale: int) -> np.ndarray:
    """``1 + floor(scale * (count + smoothing) / (total + smoothing * kept))``, exact."""
    if not kept:
        return np.zeros(len(counts), np.int64)
    if len(counts) and (int(counts.max()) + smoothing) * scale >= 1 << 63:
        counts = counts.astype(object)
    return (1 + scale * (counts + smoothing) // (total + smoothing * kept)).astype(np.int64)


def against_bases(own: np.ndarray, own_base: int, bases: np.ndarray) -> np.ndarray:
    """For each peer's base rate ``b``: the sum of ``|rate - b| - |own_base - b|`` over ``own`` rates."""
    ordered = np.sort(own)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    below = np.searchsorted(ordered, bases)
    above = len(own) - below
    far = bases * below - sums[below] + (sums[-1] - sums[below]) - bases * above
    return far - len(own) * np.abs(own_base - bases)


def accumulate(
    source: np.ndarray, term: np.ndarray, rate: np.ndarray, bases: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """For each group its dense accumulator over peers.

    Postings of a block are ``(source, term, rate)`` as numbers. The accumulators of ``a`` at ``b`` and of
    ``b`` at ``a`` add up to what the block changes in the sum of absolute differences of the two.
    """
    order = np.lexsort((source, term))
    source, term, rate = source[order], term[order], rate[order]
    ends = np.searchsorted(term, term, side="right")
    rows = np.argsort(source, kind="stable")
    starts = np.searchsorted(source[rows], np.arange(len(bases) + 1))
    for a, base in enumerate(bases):
        own = rows[starts[a] : starts[a + 1]]  # where in the index this group's postings are
        total = against_bases(rate[own], base, bases)
        after = ends[own] - own - 1  # postings of the same term by later groups
        steps = np.searchsorted(np.cumsum(after), np.arange(STEP, after.sum() + STEP, STEP))
        for part in np.split(np.arange(len(own)), steps):
            lengths = after[part]
            if not lengths.sum():
                continue
            shift = np.repeat(own[part] + 1 - np.cumsum(lengths) + lengths, lengths)
            peers = shift + np.arange(len(shift))
            mine, b, theirs = np.repeat(rate[own[part]], lengths), source[peers], rate[peers]
            both = np.abs(mine - theirs) - np.abs(mine - bases[b]) - np.abs(base - theirs)
            np.add.at(total, b, both + np.abs(base - bases[b]))
        yield a, total


def _audited(smoothing: int, scale: int, top: int):
    empty = pd.DataFrame({c: [] for c in ("lang", "source", "part", "item")}, dtype=object)
    empty["value"] = np.zeros(0, np.int64)

    def pairs_of(lang: str, block: int, names, bases, kept, source, term, rate) -> Iterator[pd.DataFrame]:
        for a, total in accumulate(source, term, rate, bases):
            if block == 0:  # the start of every pair, once
                total[a + 1 :] += kept * np.abs(bases[a] - bases[a + 1 :])
            others = np.arange(len(names)) != a
            yield pd.DataFrame(
                {"lang": lang, "source": names[a], "part": "pair", "item": names[others], "value": total[others]}
            )

    def terms_of_groups(lang, names, source, terms, term, rate, whole) -> pd.DataFrame:
        more = np.flatnonzero(rate > whole)
        value = (rate - whole)[more]
        order = more[np.lexsort((term[more], -value, source[more]))]
        place = np.arange(len(order)) - np.searchsorted(source[order], source[order])
        order = order[place < top]
        return pd.DataFrame(
            {
                "lang": lang, "source": names[source[order]], "part": "term",
                "item": terms[term[order]], "value": (rate - whole)[order],
            }
        )

    def audited(key, postings: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([empty, *parts_of(int(key[0]), postings, groups)])

    def parts_of(block: int, postings: pd.DataFrame, groups: pd.DataFrame) -> Iterator[pd.DataFrame]:
        by_lang = dict(list(postings.groupby("lang", sort=False)))
        for lang, own in groups.groupby("lang", sort=False):
            own = own.sort_values("source")
            names = own["source"].to_numpy(object)
            kept, lang_total = int(own["kept"].iloc[0]), int(own["lang_total"].iloc[0])
            totals = own["total"].to_numpy(np.int64)
            zero = np.zeros(1, np.int64)
            bases = np.array([rates(zero, int(t), kept, smoothing, scale)[0] for t in totals], np.int64)
            held = by_lang.get(lang, postings.iloc[:0])
            source = pd.Index(names).get_indexer(held["source"])
            term, terms = pd.factorize(held["term"].to_numpy(object), sort=True)
            n = held["n"].to_numpy(np.int64)
            rate = np.zeros(len(n), np.int64)
            for a in np.unique(source):
                at = source == a
                rate[at] = rates(n[at], int(totals[a]), kept, smoothing, scale)
            whole = rates(held["lang_n"].to_numpy(np.int64), lang_total, kept, smoothing, scale)
            yield from pairs_of(lang, block, names, bases, kept, source, term, rate)
            yield terms_of_groups(lang, names, source, terms, term, rate, whole)

    return audited


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    smoothing: int = SMOOTHING,
    scale: int = SCALE,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of sources, and each source's typical terms.

    Part ``pair`` has every other source of the language, with the sum over all kept terms of the absolute
    difference of rates. Part ``term`` has the ``top`` terms that the source uses more than its language, with
    that difference. Ranks run from 1 by falling value, then by the item in UTF-8 order. All arithmetic is in
    whole numbers.

    Null text, language and source are read as empty. Groups without terms are compared too; without kept
    terms all differences are 0. Repeated rows are documents of their own, other columns are not read, and
    an empty table gives no rows. A task holds its block, a row for each group and a number for each pair of a
    language's groups, of which the result has a row each.
    """
    counts = keep(count_terms(docs, text_col, lang_col, source_col), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    postings = (
        counts.filter(F.col("term") != "")
        .withColumns({
            "lang_docs": F.sum("docs").over(of_term),
            "lang_n": F.sum("n").over(of_term),
            "head": F.col("source") == F.min("source").over(of_term),
        })
        .filter(F.col("lang_docs") >= least_docs)
        .select("lang", "source", "term", "n", "lang_n", "head")
    )
    postings = keep(postings, "postings")

    sums = postings.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if("head").alias("kept"), F.count(F.lit(1)).alias("size")
    )
    groups = counts.filter(F.col("term") == "").select("lang", "source").join(sums, ["lang", "source"], "left")
    groups = groups.fillna(0, ["total", "kept", "size"])
    whole = groups.groupBy("lang").agg(F.sum("kept").alias("kept"), F.sum("total").alias("lang_total"))
    groups = keep(groups.drop("kept").join(whole, "lang"), "groups")

    per_lang = groups.groupBy("lang").agg(F.sum("size").alias("size"), F.pow(F.count("*"), 2).alias("pairs"))
    size, pairs = (int(v or 0) for v in per_lang.agg(F.sum("size"), F.sum("pairs")).first())
    blocks = max(1, -(-size // min(MOST_POSTINGS, max(BLOCK_POSTINGS, pairs))))
    block = F.pmod(F.xxhash64("lang", "term"), F.lit(blocks)).cast("int").alias("block")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    found = (
        postings.select(block, "lang", "source", "term", "n", "lang_n").groupBy("block")
        .cogroup(groups.select(each, "lang", "source", "total", "kept", "lang_total").groupBy("block"))
        .applyInPandas(
            _audited(smoothing, scale, top), "lang string, source string, part string, item string, value bigint"
        )
    )
    found = keep(found, "audited")

    sides = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )
    pairs = (
        found.filter(F.col("part") == "pair")
        .groupBy("lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b"))
        .agg(F.sum("value").alias("value"))
        .select("lang", F.lit("pair").alias("part"), "value", F.inline(sides))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = found.filter(F.col("part") == "term").withColumn("rank", F.row_number().over(order))
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms.filter(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
w AS (SELECT rn, lang, source, translate(t, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS term
  FROM (SELECT rn, lang, source,
          unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d)),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rn) >= {LEAST_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN k USING (lang)
  GROUP BY g.lang),
t AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total
  FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(n, 0) AS n,
    1 + {SCALE}::HUGEINT * (coalesce(n, 0) + {SMOOTHING}) // (total + {SMOOTHING} * v) AS p
  FROM t JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + {SCALE}::HUGEINT * (sum(n) + {SMOOTHING})
      // ((SELECT sum(total) FROM t WHERE t.lang = c.lang) + {SMOOTHING} * any_value(v)) AS q
  FROM c JOIN v USING (lang) GROUP BY lang, term),
f AS (SELECT lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


@query(_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))
