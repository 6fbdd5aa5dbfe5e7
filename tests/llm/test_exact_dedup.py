import hashlib

import pytest

from clickfeat.llm.exact_dedup import drop_copies, exact_dedup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, largest):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(UPPER), []).append(doc)
    best = max if largest else min
    out = []
    for doc, text in rows:
        norm = (text or "").translate(UPPER)
        ids = [i for i in groups[norm] if i is not None]
        out.append((doc, best(ids) if ids else None, len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


EDGES = [
    (1, None), (2, ""), (3, "A b"), (4, "a B"), (5, "É"), (6, "é"), (7, "a  b"), (8, "x" * 100_000),
    (9, "X" * 100_000), (None, "a b"), (10, "a b\n"), (11, "a b\n"), (11, "a b\n"), (12, "İ"), (None, "solo"),
]


@pytest.mark.parametrize("largest", [True, False])
def test_edges(documents, largest):
    got = exact_dedup(documents(EDGES), largest=largest).collect()
    assert sorted([(r[0], r[1], r[2], r[4]) for r in got], key=repr) == expected(EDGES, largest)
    # One row of each group stays, also among rows that are equal in all.
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert sorted(kept) == sorted({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_a_hot_text_is_dealt_to_several_ranges(documents):
    rows = [(i, "The Same") for i in range(3000)] + [(i, f"other {i % 2000}") for i in range(3000, 6000)]
    got = exact_dedup(documents(rows), largest=True).collect()
    assert sorted([(r[0], r[1], r[2], r[4]) for r in got], key=repr) == expected(rows, True)
    assert sum(r["kept"] for r in got) == 1 + 2000


def test_no_rows(documents):
    assert exact_dedup(documents([])).collect() == []
    assert drop_copies(documents([])).collect() == []


def test_columns_pass_unchanged(documents):
    docs = documents(EDGES)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}


def test_texts_are_not_gathered(documents):
    plan = exact_dedup(documents(EDGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan
