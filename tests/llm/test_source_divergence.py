"""The divergence audit against plain Python on whole tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickfeat.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """Rows ``(text, lang, source)``; every rate of every group is computed."""
    count, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(FOLD) for t in TERM.findall(text or "")]
        for t in terms:
            count[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= least:
            kept[lang].append(t)
    rate = {}
    for lang, source in [*groups, *{(g[0], None) for g in groups}]:
        own = {
            t: sum(count[lang, s, t] for g, s in groups if g == lang and source in (None, s))
            for t in kept[lang]
        }
        total, v = sum(own.values()), len(own)
        rate[lang, source] = {t: 1 + 10**9 * (n + 5) // (total + 5 * v) for t, n in own.items()}
    out = []
    for lang, source in groups:
        mine, whole = rate[lang, source], rate[lang, None]
        pairs = [
            (-sum(abs(mine[t] - rate[lang, s][t]) for t in mine), s)
            for g, s in groups
            if g == lang and s != source
        ]
        terms = [
            (whole[t] - p, t) for t, p in mine.items() if count[lang, source, t] and p > whole[t]
        ]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, -f, i + 1) for i, (f, item) in enumerate(ranked)]
    return sorted(out)


def rows_of(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def test_whole_table_equals_brute_force(spark, small):
    docs = small("documents")
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert rows_of(sd.audit(docs, least_docs=5, top=7)) == brute(rows, 5, 7)


def test_many_blocks_and_task_flushes_change_nothing(spark, small, monkeypatch):
    docs = small("documents")
    whole = rows_of(sd.audit(docs, least_docs=4))
    monkeypatch.setattr(sd, "MOST_POSTINGS", 100)
    assert rows_of(sd.audit(docs.repartition(5), least_docs=4)) == whole


def test_odd_rows(spark, documents):
    """Nulls, empty texts, repeated rows, groups without terms, a language of one source."""
    rows = [
        (1, "Über über ÜBER a-b C3c", "de", "x"),
        (1, "Über über ÜBER a-b C3c", "de", "x"),
        (2, None, "de", "y"),
        (3, "", "de", None),
        (None, "über\x00und ḱ b b b", None, "z"),
        (4, "b", None, "y"),
        (5, "12 34 !!", "xx", "alone"),
        (6, "b a", "de", "y"),
        (7, "one " * 3000, "de", "y"),
    ]
    got = rows_of(sd.audit(documents(rows), least_docs=2))
    assert got == brute([r[1:] for r in rows], 2, 50)
    assert ("xx", "alone") not in {r[:2] for r in got}
    assert rows_of(sd.audit(documents(rows), least_docs=99)) == brute([r[1:] for r in rows], 99, 50)


def test_ties_are_ranked_by_item(spark, documents):
    rows = [(i, "é z Z a", "en", s) for i, s in enumerate(["s1", "s2", "s2", "é", "s10"])]
    got = sd.audit(documents(rows), least_docs=1)
    assert rows_of(got) == brute([r[1:] for r in rows], 1, 50)


def test_empty_table(spark, documents):
    assert sd.audit(documents([])).count() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(sd, "SLICE", 7)
    text = "alpha Beta-gamma éÉ 1 deltaepsilonzeta" * 3
    cut = [w.decode() for part in sd.terms_of(text.encode()) for w in part]
    assert cut == [t.translate(FOLD) for t in TERM.findall(text)]


def test_accumulators_equal_dense_differences(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(sd, "STEP", 13)
    for _ in range(20):
        s, t = rng.integers(1, 7), rng.integers(1, 30)
        bases = rng.integers(1, 50, s)
        held = rng.random((s, t)) < 0.5
        rate = np.where(held, rng.integers(1, 200, (s, t)), bases[:, None])
        source, term = np.nonzero(held)
        start = t * np.abs(bases[:, None] - bases)
        change = np.zeros((s, s), np.int64)
        for a, total in sd.accumulate(source, term, rate[held], bases):
            change[a] = total
        dense = np.abs(rate[:, None] - rate[None]).sum(axis=2)
        off = ~np.eye(s, dtype=bool)
        assert ((start + change + change.T)[off] == dense[off]).all()


def test_rates_are_exact_beyond_64_bits():
    counts = np.array([0, 10**13, 3 * 10**15])
    want = [1 + 10**9 * (int(c) + 5) // (10**16 + 35) for c in counts]
    assert sd.rates(counts, 10**16, 7, 5, 10**9).tolist() == want
    assert sd.rates(np.zeros(1, np.int64), 0, 0, 5, 10**9).tolist() == [0]


@pytest.mark.parametrize("column", ["text", "lang", "source"])
def test_a_column_of_nulls(spark, documents, column):
    df = documents([(i, "a b", "en", "s" + str(i)) for i in range(4)])
    df = df.withColumn(column, df[column].substr(0, 0)).replace("", None, [column])
    rows = [(r["text"], r["lang"], r["source"]) for r in df.collect()]
    assert rows_of(sd.audit(df, least_docs=1)) == brute(rows, 1, 50)
