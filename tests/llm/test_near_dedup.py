import random
from itertools import combinations

import numpy as np
import pytest

from clickfeat.llm import near_dedup as nd


def brute(rows, words, percent):
    """Smallest id reachable by links, by comparing all pairs of plain Python sets."""
    sets = {}
    for doc, text in rows:
        found = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        found = found.encode().split()
        size = min(words, len(found))
        sets[doc] = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()
    label = {d: d for d in sets}
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = {d: low if v == high else v for d, v in label.items()}
    return {d: (len(sets[d]), label[d]) for d in sets}


def check(documents, rows, words=3, percent=85):
    got = {r["doc_id"]: r for r in nd.near_duplicates(documents(rows), words=words, percent=percent).collect()}
    want = brute(rows, words, percent)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def near_copies(count, size=200, edits=3, seed=1):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(size)] = f"v{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return [" ".join(base), *out]


def test_edges(documents):
    rows = [
        (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "ONE"), (10, "one two"), (11, "One Two"), (12, "one two three"),
        (13, "É b c d"), (14, "é b c d"), (15, "b c d É"), (1, "x y z " * 5000), (2, "X Y Z " * 4000), (3, "one"),
    ]
    check(documents, rows)
    check(documents, rows, words=5, percent=80)


def test_pairs_at_the_threshold(documents):
    # Sets of n and n - k shingles that share n - k: similarity (n - k) / n.
    rows, doc = [], 0
    for n in (20, 40, 100, 200):
        for cut in range(1, n // 4):
            words = [f"p{n}_{cut}_{i}" for i in range(n + 2)]
            rows += [(doc, " ".join(words)), (doc + 1, " ".join(words[: n + 2 - cut]))]
            doc += 2
    check(documents, rows)


def test_a_chain_and_unrelated_documents(documents):
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[10 * i : 10 * i + 200])) for i in range(20)]
    rows += [(100 + i, " ".join(f"u{i}_{k}" for k in range(50))) for i in range(200)]
    check(documents, rows)


def test_a_large_group_of_near_copies(documents, monkeypatch):
    rows = list(enumerate(near_copies(300, edits=12) + near_copies(40, seed=2)))
    check(documents, rows)


@pytest.mark.parametrize("pieces", [20, 60])
def test_groups_beyond_a_block_lose_no_link(documents, monkeypatch, pieces):
    monkeypatch.setattr(nd, "BLOCK_DOCS", pieces)
    rows = list(enumerate(near_copies(150, edits=14) + near_copies(70, edits=10, seed=3)))
    check(documents, rows)


def test_rows_without_ids_and_repeated_rows(documents):
    rows = [(None, "a b c d"), (None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (3, "a b c d"), (4, "other text of it")]
    got = sorted(map(tuple, nd.near_duplicates(documents(rows), words=3, percent=85).collect()), key=repr)
    assert got == sorted(
        [(None, 2, None, True), (None, 2, None, True), (4, 2, 3, False), (4, 2, 3, False), (3, 2, 3, True), (4, 2, 4, True)],
        key=repr,
    )


def test_no_rows(documents):
    assert nd.near_duplicates(documents([])).collect() == []


def test_dropping_keeps_columns(documents):
    docs = documents(list(enumerate(near_copies(5))) + [(50, None)])
    kept = nd.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 50]


def test_nodes_larger_than_the_store_stay_connected(monkeypatch):
    monkeypatch.setattr(nd, "RUN_ROWS", 100)
    import pandas as pd

    n = 450
    way = np.zeros((n, nd.DEPTH), ">u4")
    small = np.zeros((n, nd.COORDINATES), np.uint8)
    batch = pd.DataFrame(
        {"_tree": 0, "_path": [w.tobytes() for w in way], "_class": range(n), "_small": [s.tobytes() for s in small]}
    )
    edges = pd.concat(nd._node_reader(nd.DEPTH, nd.COORDINATES, 40)(iter([batch])))
    label = list(range(n))
    for a, b in edges[["_a", "_b"]].to_numpy().tolist():
        low, high = sorted((label[a], label[b]))
        label = [low if v == high else v for v in label]
    assert set(label) == {0}


def test_large_leaves_are_compared_in_all_pairs(monkeypatch):
    import pandas as pd

    draw = np.random.default_rng(3)
    n, least = 600, 44
    small = draw.integers(0, 256, (n, nd.COORDINATES), dtype=np.uint8)
    pairs = [(5 + i, n - 5 - 7 * i) for i in range(20)]
    for a, b in pairs:
        small[b] = small[a]
        small[b, :12] += 1
    small[300:340] = small[300]  # a group, and a chain that hangs on it
    small[400:405] = small[300]
    for k in range(5):
        small[400 + k, : 15 * (k + 1)] += 1
    want = {frozenset(p) for p in pairs} | {frozenset([*range(300, 340), *range(400, 405)])}

    def groups(edges):
        label = list(range(n))
        for a, b in edges:
            low, high = sorted((label[a], label[b]))
            label = [low if v == high else v for v in label]
        return {frozenset(i for i in range(n) if label[i] == v) for v in set(label) if label.count(v) > 1}

    assert groups(nd.node_edges(np.zeros((n, nd.DEPTH), np.int64), small, least)) == want
    monkeypatch.setattr(nd, "RUN_ROWS", 100)  # leaves stay whole in a store that is smaller
    way = np.zeros((n, nd.DEPTH), ">u4").tobytes()[: 4 * nd.DEPTH]
    batch = pd.DataFrame({"_tree": 0, "_path": [way] * n, "_class": range(n), "_small": [s.tobytes() for s in small]})
    found = pd.concat(nd._node_reader(nd.DEPTH, nd.COORDINATES, least)(iter([batch])))
    assert groups(found[["_a", "_b"]].to_numpy().tolist()) == want


def test_components(spark):
    draw = random.Random(4)
    edges = [(a, a + 1) for a in range(60)] + [(100, b) for b in range(101, 400)]
    edges += [tuple(sorted(draw.sample(range(1000, 1100), 2))) for _ in range(60)]
    label = {v: v for e in edges for v in e}
    for a, b in edges:
        low, high = sorted((label[a], label[b]))
        label = {v: low if x == high else x for v, x in label.items()}
    got = nd.components(spark.createDataFrame(edges, "_a bigint, _b bigint"))
    assert {r["_class"]: r["_label"] for r in got.collect()} == label
