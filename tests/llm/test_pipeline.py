"""The pipeline against plain Python, stage by stage on each stage's own input."""

from collections import Counter

import pytest

import corpus_pipeline
from clickfeat.llm import quality_rules as q
from clickfeat.llm.mixing import mix
from tests.llm.conftest import SMALL
from tests.llm.test_near_dedup import brute

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = small("documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(SMALL)).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append(docs)
    return found


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_quality(stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    want = {}
    for doc, r in before.items():
        n, _, _, _, repeats, lost, clean = q.judge(r["text"])
        if n >= 50 and 100 * repeats <= 50 * n and 100 * lost <= 50 * n:
            want[doc] = clean
    assert {d: r["text"] for d, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_exact_copies(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    first = {}
    for doc in sorted(before):
        first.setdefault(before[doc]["text"].translate(UPPER), doc)
    assert after == {d: before[d] for d in first.values()}


def test_near_copies(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    labels = brute([(d, r["text"]) for d, r in before.items()], 5, 80)
    assert after == {d: before[d] for d, (_, label) in labels.items() if label == d}


def test_mixing(stages):
    before = by_id(stages[3])
    copies = {r["doc_id"]: r["copies"] for r in mix(stages[3]).collect()}
    rows = stages[4].collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({d: n for d, n in copies.items() if n})
    assert all(r == before[r["doc_id"]] for r in rows)


def test_packing(stages):
    copies = Counter(r["doc_id"] for r in stages[4].collect())
    pieces = stages[5].collect()
    tokens = Counter()
    for r in pieces:
        tokens[r["doc_id"]] += r["length"]
    size = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert tokens == Counter({d: n * size[d] for d, n in copies.items()})


def test_run_applies_all_stages(spark, stages):
    result = corpus_pipeline.run(spark, str(SMALL))
    assert result.columns == stages[-1].columns and result.count() == stages[-1].count()
