from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from clickfeat.llm import packing
from clickfeat.llm.token_counts import by_limit, length_at, length_histogram
from clickfeat.llm.tokens import WordEncoder, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

ODD = [
    "", None, "I'm don't WE'LL it’s", "a\x1cb c", "x<|endoftext|>y", "Ünï é éé ﬁ ẞ İstanbul 漢字 ١٢٣ 4a5",
    "!!??.. a|b --- __x__ $%^&", "​hi﻿ 　wide", "ñandú🙂🙂 ok", "' 's 'S --'s", "</w> a</w>", "Ⅷ ½ x²",
    "a\nb\tc\r\nd\x0be", "word " * 30_000,
]


@pytest.fixture(scope="module")
def whole():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers(whole):
    encoder = WordEncoder(vocabulary_path())
    for texts in (ODD, ODD[::-1]):
        ids, lengths = encoder.encode(texts)
        parts = np.split(ids, np.cumsum(lengths)[:-1])
        assert [p.tolist() for p in parts] == [ids_of(whole, t) for t in texts]
    assert encoder.encode([])[0].tolist() == []


def test_hilbert_neighbours_touch():
    side = 3
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = packing.hilbert_key(grid, side)
    assert sorted(keys) == list(range(512))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("length", [8, 4096])
def test_pieces_make_up_every_document(documents, whole, length):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id")]
    got = packing.pack(documents(rows), length=length).collect()
    sequences, found = defaultdict(list), Counter()
    for r in got:
        sequences[r["sequence_id"]].append(r)
        assert crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for number, pieces in sequences.items():
        pieces.sort(key=lambda r: r["offset"])
        ends = [r["offset"] + r["length"] for r in pieces]
        assert [r["offset"] for r in pieces] == [0, *ends[:-1]]
        assert ends[-1] == length or number == max(sequences)
    stream = [(r["doc_id"], i) for n in sorted(sequences) for r in sequences[n] for i in r["ids"]]
    for doc, text in rows:
        found[(doc, *ids_of(whole, text), packing.END_ID)] += 1
    # Documents follow each other in the stream, each ending with the end id of its own.
    docs, current = Counter(), []
    by_start = [r for n in sorted(sequences) for r in sequences[n]]
    for r in by_start:
        assert r["start"] == len(current)
        current += r["ids"]
        if len(current) == r["doc_tokens"]:
            docs[(r["doc_id"], *current)] += 1
            current = []
    assert not current and docs == found and len(stream) == sum(len(k) - 1 for k in found.elements())


def test_no_rows(documents):
    assert packing.pack(documents([])).collect() == []
    assert by_limit(length_histogram(documents([]))).collect() == []


def test_limits_against_brute_force(small, whole):
    docs = small("documents")
    lengths = [len(ids_of(whole, r["text"])) for r in docs.collect()]
    limits = by_limit(length_histogram(docs))
    got = limits.collect()
    assert sorted(r["tokens"] for r in got) == sorted(set(lengths))
    for r in got:
        limit = r["tokens"]
        assert r["n_docs"] == lengths.count(limit)
        assert r["n_longer"] == sum(n > limit for n in lengths)
        assert r["tokens_longer"] == sum(n for n in lengths if n > limit)
        assert r["tokens_within"] == sum(n for n in lengths if n <= limit)
        assert r["truncated_tokens"] == sum(min(n, limit) for n in lengths)
        assert r["total_tokens"] == sum(lengths) and r["total_docs"] == len(lengths)
    assert length_at(limits, 0.5).first()[0] == sorted(lengths)[(len(lengths) - 1) // 2]


def test_null_text_has_length_nothing(documents):
    got = {r["tokens"]: r["n_docs"] for r in length_histogram(documents([(1, None), (2, ""), (3, "a b")])).collect()}
    assert got == {0: 2, 2: 1}
