import re
from collections import Counter

import pytest

from clickfeat.llm.mixing import mix, mixed, source_targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(1, 2, 3)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, left, total = {}, set(order), sum(sizes.values())
    while left:
        rest, share = total - sum(fixed.values()), sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / share > 3 * sizes[s]]
        if not over:
            fixed.update({s: rest * weight[s] / share for s in left})
            break
        fixed.update({s: 3 * sizes[s] for s in over})
        left -= set(over)
    return fixed


def table_of(documents, sources):
    rows, n = [], 0
    for source, sizes in sources.items():
        for size in sizes:
            rows.append((n, " ".join(["w"] * size) if size is not None else None, "en", source))
            n += 1
    return documents(rows)


CASES = [
    {"a": [5, 7, 9] * 40, "b": [3] * 100, "c": [50, 1], "d": [10] * 30},
    {"a": [100] * 50, None: [2, 3], "": [1]},
    {"a": [None, 0, 0], "b": [10, 20, 30]},
    {"a": [None, 0]},
    {"x": [1] * 500 + [3000], "y": [2] * 500, "z": [700, 800, 5]},
]


@pytest.mark.parametrize("sources", CASES)
def test_mix_against_brute_force(documents, sources):
    docs = table_of(documents, sources)
    got = mix(docs).collect()
    named = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = {s: sum(x or 0 for x in each) for s, each in sources.items()}
    targets = brute_targets(sizes)
    taken = Counter()
    for r in got:
        source = named[r["doc_id"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source], abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[source] += r["taken"]
    assert len(got) == len(named)
    for source, each in sources.items():
        # Off by less than the shortest document that could still be added or left out.
        assert abs(taken[source] - targets[source]) <= max([x or 0 for x in each] + [1])


def test_reruns_agree(documents):
    docs = table_of(documents, CASES[0])
    once, again = (sorted(map(repr, mix(d).collect())) for d in (docs, docs.repartition(7)))
    assert once == again


def test_rates_are_exponential_in_size(documents):
    got = mix(table_of(documents, {"a": [10, 20, 30, 40] * 50, "b": [10] * 20})).collect()
    rates = {r["size"]: r["rate"] for r in got if r["source_size"] > 1000}
    steps = [rates[b] / rates[a] for a, b in ((10, 20), (20, 30), (30, 40))]
    assert steps[0] == pytest.approx(steps[1], rel=1e-5) and steps[1] == pytest.approx(steps[2], rel=1e-5)


def test_targets_use_all_words(spark):
    sizes = spark.createDataFrame([(f"s{i:03}", 10 + i * i) for i in range(40)], "_source string, _size bigint")
    got = source_targets(sizes).collect()
    assert sum(r["target"] for r in got) == pytest.approx(sum(r["_size"] for r in got))


def test_the_mix_repeats_rows_and_keeps_columns(documents):
    docs = table_of(documents, CASES[0])
    copies = {r["doc_id"]: r["copies"] for r in mix(docs).collect()}
    out = mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: v for k, v in copies.items() if v})
    assert mixed(documents([])).collect() == [] and mix(documents([])).collect() == []


def test_null_ids_and_repeated_rows(documents):
    docs = documents([(None, "a b c", "en", "s"), (1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, "c", None, "t")])
    got = mix(docs).collect()
    assert len(got) == 4 and sum(r["size"] for r in got) == 8


def test_halving_alone_settles_every_source(documents, monkeypatch):
    """The guard of the solver: where Newton's steps never help, halving reaches the same mix."""
    from clickfeat.llm import mixing

    docs = table_of(documents, CASES[4])
    newton = sorted((r["doc_id"], r["taken"]) for r in mix(docs).collect())
    monkeypatch.setattr(mixing, "HALVING_FROM", 1)
    assert sorted((r["doc_id"], r["taken"]) for r in mix(docs).collect()) == newton
